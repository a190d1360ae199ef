"""candlewick: market-data analytics on Spark.

Scans exchange files (delimited, fixed-width, zipped, nested JSON), cleans them
with column expressions, merges them idempotently into instrument, daily,
intraday and historical tables, and answers analytical questions for every
ticker at once (latest values, histories, OHLC candles, SMA/EMA/RSI, market
movers, coverage, tradable universe).  Everything is expressed with the public
DataFrame / SQL / Structured Streaming APIs.
"""

__all__ = ["session", "schemas"]
