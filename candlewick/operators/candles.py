"""OHLC candles.

Intraday candles are one hash aggregate on (ticker, epoch-aligned bucket):
open/close are ``min_by``/``max_by`` on the quote time, which Spark combines
map-side, so a ticker holding a large share of the points never lands in one
task as raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Intraday candle widths in seconds.
INTRADAY_INTERVALS = {"5m": 300, "15m": 900, "1h": 3600}
DAILY_INTERVAL = "1d"


def intraday_candles(points: DataFrame, interval: str, *, ts: str = "quoted_at",
                     price: str = "close_price", key: str = "ticker") -> DataFrame:
    """A1: candles of every ticker; null prices skipped; oldest first per ticker."""
    if interval not in INTRADAY_INTERVALS:
        raise ValueError(f"Not an intraday interval: {interval}")
    step = INTRADAY_INTERVALS[interval]
    bucket = F.window(F.col(ts), f"{step} seconds")
    return (
        points.where(F.col(price).isNotNull())
        .groupBy(F.col(key), bucket.alias("bucket"))
        .agg(
            F.min_by(price, ts).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, ts).alias("close"),
            F.count(F.lit(1)).alias("point_count"),
        )
        .select(
            F.col(key).alias("ticker"),
            F.lit(interval).alias("interval"),
            F.col("bucket.start").alias("start_time"),
            F.col("bucket.end").alias("end_time"),
            "open", "high", "low", "close",
            F.lit(None).cast("double").alias("volume"),
            "point_count",
        )
    )


def daily_candles(quotes: DataFrame) -> DataFrame:
    """A2: one candle per daily quote row; open = close = last price."""
    start = F.col("trade_date").cast("timestamp_ntz")
    close = F.col("last_price")
    return quotes.select(
        "ticker",
        F.lit(DAILY_INTERVAL).alias("interval"),
        start.alias("start_time"),
        (start + F.expr("INTERVAL 1 DAY")).alias("end_time"),
        close.alias("open"),
        F.coalesce("max_price", close).alias("high"),
        F.coalesce("min_price", close).alias("low"),
        close.alias("close"),
        F.col("financial_volume").cast("double").alias("volume"),
        F.lit(None).cast("bigint").alias("point_count"),
    )


def last_candles(candles: DataFrame, limit: int, *, key: str = "ticker", ts: str = "start_time") -> DataFrame:
    """Keep the newest ``limit`` candles of each ticker (still chronological
    when ordered by ``start_time``).  ``row_number <= limit`` is planned as a
    partial ``WindowGroupLimit`` before the shuffle."""
    rn = F.row_number().over(Window.partitionBy(key).orderBy(F.col(ts).desc()))
    return candles.withColumn("_rn", rn).where(F.col("_rn") <= limit).drop("_rn")
