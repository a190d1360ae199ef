"""Latest values, histories and point lookups.

"Latest per ticker" is an aggregate (``max_by`` of the whole row as a struct),
not a self-join: Spark combines it map-side, so a ticker holding a large share
of the rows is reduced before the shuffle.  Top-N histories use
``row_number() <= N``, which Spark plans as a partial ``WindowGroupLimit``
ahead of the exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def parse_ticker_list(tickers: str | None) -> list[str] | None:
    """Comma separated, trimmed, upper, empties dropped; None if empty."""
    if tickers is None:
        return None
    out = [t.strip().upper() for t in tickers.split(",") if t.strip()]
    return out or None


def restrict_tickers(df: DataFrame, tickers: list[str] | DataFrame | None, key: str = "ticker") -> DataFrame:
    """Keep rows of the given tickers: an ``isin`` literal list (pushed to the
    scan) or a semi join against a ticker DataFrame for long lists."""
    if tickers is None:
        return df
    if isinstance(tickers, DataFrame):
        return df.join(tickers.select(F.col(key)).distinct(), key, "left_semi")
    return df.where(F.col(key).isin([t.upper() for t in tickers]))


def latest_per_key(df: DataFrame, order: str, key: str = "ticker") -> DataFrame:
    """The row with the greatest ``order`` value for every ``key``.

    (key, order) is unique in the market tables, so this equals the
    reference's max-then-join formulation."""
    others = [c for c in df.columns if c != key]
    return (
        df.groupBy(key)
        .agg(F.max_by(F.struct(*[F.col(c) for c in others]), F.col(order)).alias("_r"))
        .select(key, *[F.col(f"_r.{c}").alias(c) for c in others])
    )


def history_top_n(df: DataFrame, n: int, order: str, *, key: str = "ticker", newest_first: bool = True) -> DataFrame:
    """The ``n`` newest rows of every key, with their rank (1 = newest)."""
    o = F.col(order).desc() if newest_first else F.col(order).asc()
    rn = F.row_number().over(Window.partitionBy(key).orderBy(o))
    return df.withColumn("rank", rn).where(F.col("rank") <= n)


def history_chronological(df: DataFrame, n: int, order: str, *, key: str = "ticker") -> DataFrame:
    """T10 oldest-first variant: the newest ``n`` rows, numbered oldest first."""
    newest = history_top_n(df, n, order, key=key).drop("rank")
    return newest.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).asc())))


def in_range(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """F8: inclusive range filter; pushed into the parquet scan and, on a
    date-partitioned table, pruned to the partitions in range."""
    cond: Column = F.lit(True)
    if start is not None:
        cond = cond & (F.col(column) >= F.lit(start))
    if end is not None:
        cond = cond & (F.col(column) <= F.lit(end))
    if start is not None and end is not None and str(end) < str(start):
        raise ValueError("end must not be before start")
    return df.where(cond)


def trades_filtered(trades: DataFrame, *, trade_date=None, ticker: str | None = None,
                    start=None, end=None) -> DataFrame:
    """exact date AND ticker AND range, each optional."""
    out = trades
    if trade_date is not None:
        out = out.where(F.col("trade_date") == F.lit(trade_date).cast("date"))
    if ticker is not None:
        out = out.where(F.col("ticker") == ticker.strip().upper())
    return in_range(out, "trade_date", start, end)


def day_points(points: DataFrame, ticker: str, trade_date) -> DataFrame:
    """All points of a ticker on one day, in time order."""
    return (
        points.where((F.col("trade_date") == F.lit(trade_date).cast("date")) & (F.col("ticker") == ticker.upper()))
        .orderBy("quoted_at")
    )


def date_bounds(df: DataFrame, column: str, prefix: str, key: str = "ticker", as_date: bool = False) -> DataFrame:
    """A4: min / max of a date or timestamp column per key."""
    c = F.col(column).cast("date") if as_date else F.col(column)
    return df.groupBy(key).agg(F.min(c).alias(f"{prefix}_min"), F.max(c).alias(f"{prefix}_max"))
