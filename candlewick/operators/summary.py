"""Coverage and overview kept up to date from load to load.

``operators.coverage`` answers from whole tables.  Here every load adds what
it brings to one row per ticker: date bounds, and the latest row of each
source with its time and the load it came from.  Such rows merge: bounds by
``min`` / ``max``, latest rows by (time, load), so loads may come in any order
and a load may be merged twice.  A load of a day costs its own rows and the
shards of the summary that its tickers fall into, whatever the tables hold.

The tables only grow or replace rows of a key, so bounds never shrink.  Of two
rows of one time, the later load wins for daily rows, which are upserted, and
the earlier one for intraday points, where the first write stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators import coverage as CV
from candlewick.sinks import merge as MG

#: Folders that the summary is dealt into by ticker; a load rewrites those it touches.
SHARDS = 64
_FIELDS = {"asset": ["asset_name", "isin", "segment"], "quote": CV.QUOTE_FIELDS, "trade": CV.TRADE_FIELDS, "intraday": CV.POINT_FIELDS}
_AT = {"asset": None, "quote": "trade_date", "trade": "trade_date", "intraday": "quoted_at", "hist": "trade_date"}
_DATED = ("quote", "trade", "intraday", "hist")


def _latest(section: str, value: Column) -> Column:
    return F.max_by(value, F.struct(value["at"], value["load"])).alias(section)


def _merged() -> list[Column]:
    latest = [_latest(s, F.col(s)) for s in _FIELDS]
    return latest + [fn(f"{s}_{b}").alias(f"{s}_{b}") for s in _DATED for b, fn in (("min", F.min), ("max", F.max))]


def parts_of_load(load: int, sources: dict[str, DataFrame], *, shards: int = SHARDS) -> DataFrame:
    """What one load brings, one row per ticker: ``sources`` holds its rows, one
    per key, under ``asset``, ``quote``, ``trade``, ``intraday`` or ``hist``.
    All of them are reduced by one aggregate, combined map-side."""
    parts = None
    for name, df in sources.items():
        at = F.lit(None).cast("timestamp_ntz") if _AT[name] is None else F.col(_AT[name]).cast("timestamp_ntz")
        cols = [F.col("ticker")]
        for s, fields in _FIELDS.items():
            kind = f"struct<at:timestamp_ntz,load:bigint,row:{CV.struct_type(s)}>"
            order = F.lit(-load if s == "intraday" else load).cast("bigint")
            mine = F.struct(at.alias("at"), order.alias("load"), F.struct(*fields).cast(CV.struct_type(s)).alias("row")) if s == name else F.lit(None)
            cols.append(mine.cast(kind).alias(s))
        for s in _DATED:
            day = at.cast("date") if s == name else F.lit(None).cast("date")
            cols += [day.alias(f"{s}_min"), day.alias(f"{s}_max")]
        rows = df.select(*cols)
        parts = rows if parts is None else parts.unionByName(rows)
    if parts is None:
        raise ValueError("a load without sources")
    return parts.groupBy("ticker").agg(*_merged()).withColumn("shard", F.pmod(F.xxhash64("ticker"), F.lit(shards)).cast("int"))


def merge_load(spark: SparkSession, path: str, load: int, sources: dict[str, DataFrame], *, shards: int = SHARDS) -> None:
    """Merge one load into the summary at ``path``.  ``load`` numbers grow with
    time; a load that comes again leaves alone what it wrote before."""
    MG.combine_partitions(spark, parts_of_load(load, sources, shards=shards), path, partition_col="shard", batch_id=load,
                          combine=lambda rows: rows.groupBy("ticker", "shard").agg(*_merged()))


def coverage_of(summary: DataFrame) -> DataFrame:
    """J5 from the summary: the columns of ``asset_coverage``."""
    return summary.select("ticker", F.col("asset").isNotNull().alias("has_asset_master"), *[f"{s}_{b}" for s in _DATED for b in ("min", "max")])


def overview_of(summary: DataFrame) -> DataFrame:
    """J6 from the summary: the columns of ``asset_overview``."""
    return CV.overview_columns(summary.select(
        "ticker", F.col("asset.row").alias("asset"), F.col("quote.row").alias("q"), F.col("trade.row").alias("t"), F.col("intraday.row").alias("f"),
        F.col("quote_min").alias("quotes_min"), F.col("quote_max").alias("quotes_max"), F.col("trade_min").alias("trades_min"), F.col("trade_max").alias("trades_max"),
        "hist_min", "hist_max"))
