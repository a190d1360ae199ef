"""Structured Streaming versions of the intraday operators.

* R1 ``ingest_points``   - file stream -> parsed points -> ``foreachBatch``
  insert-ignore into the intraday table (first write wins, idempotent for any
  lateness and for replayed batches); ``first_points`` drops replays in the
  state store before that.
* R2 ``candle_stream``   - each micro-batch is inserted as in R1; what is new
  becomes partial candles, which merge with the stored ones by (ticker,
  start_time); no point is too late and no stored point is read again.
  ``open_candles`` keeps the open buckets in the state store instead and emits
  changed ones, for streams that are late by a bounded time.
* R3 ``session_gate``    - stateless filter on the exchange clock.
* R4 ``universe_gate``   - stream-static left-semi join with the strict list.
* R5 ``latest_stream``   - newest point per ticker kept in the state store;
  each micro-batch writes the tickers that changed.

Checkpoints and tables live under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators import candles as C
from candlewick.operators.latest import latest_per_key
from candlewick.operators.universe import within_session
from candlewick.session import scratch_path
from candlewick.sinks import merge as MG


def file_stream(spark: SparkSession, directory: str, schema, *, fmt: str = "parquet", path_glob: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(directory)


def session_gate(points: DataFrame, **kw) -> DataFrame:
    """R3."""
    return points.where(within_session("quoted_at", **kw))


def universe_gate(points: DataFrame, strict: DataFrame) -> DataFrame:
    """Keep points of eligible tickers (static side: one row per ticker)."""
    return points.join(strict.select("ticker").distinct(), "ticker", "left_semi")


def _run(query_builder, checkpoint: str, trigger_once: bool = True):
    writer = query_builder.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger_once else writer.trigger(processingTime="30 seconds")
    return writer.start()


def ingest_points(points: DataFrame, table: str, *, checkpoint: str, order: list[str] | None = None,
                  trigger_once: bool = True):
    """Each micro-batch is inserted with ``insert_ignore_table``."""
    keys = ["ticker", "quoted_at"]

    def write(batch: DataFrame, epoch_id: int) -> None:
        MG.insert_ignore_table(batch.sparkSession, batch, table, keys, partition_col="trade_date", order=order)

    return _run(points.writeStream.foreachBatch(write), checkpoint, trigger_once)


def _event_time(points: DataFrame) -> DataFrame:
    """Add the quote time as an instant, which watermarks need; the clock is read as UTC in any session."""
    return points.withColumn("event_time", F.expr("timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01', quoted_at))"))


def _clock(instant: str) -> Column:
    return F.expr(f"timestampadd(MICROSECOND, unix_micros({instant}), TIMESTAMP_NTZ'1970-01-01')")


def first_points(points: DataFrame, delay: str) -> DataFrame:
    """R1 with bounded state: the first arrival of every (ticker, quoted_at)
    among points that are at most ``delay`` behind the newest one.

    Keys are kept in the state store for ``delay``; Spark drops rows beyond it
    (``numRowsDroppedByWatermark`` of the query's progress), so a lossless
    ingest of any lateness uses ``ingest_points`` alone.
    """
    return _event_time(points).withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["ticker", "quoted_at"]).drop("event_time")


def partial_candles(points: DataFrame, interval: str, ts: str = "quoted_at") -> DataFrame:
    """Candles of some of the points, with the times of their first and last price."""
    step = C.INTRADAY_INTERVALS[interval]
    return (
        points.where(F.col("close_price").isNotNull())
        .groupBy("ticker", F.window(ts, f"{step} seconds").alias("w"))
        .agg(
            F.min(F.struct("quoted_at", "close_price")).alias("first"), F.max(F.struct("quoted_at", "close_price")).alias("last"),
            F.max("close_price").alias("high"), F.min("close_price").alias("low"), F.count(F.lit(1)).alias("point_count"),
        )
        .select("ticker", F.col("w.start").alias("start_time"), F.col("w.end").alias("end_time"), "first", "last", "high", "low", "point_count")
    )


def merge_candles(parts: DataFrame) -> DataFrame:
    """One candle a (ticker, start_time) from partial ones, whatever points each was made of."""
    return parts.groupBy("candle_date", "ticker", "start_time", "end_time").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.max("high").alias("high"), F.min("low").alias("low"), F.sum("point_count").alias("point_count"))


def as_candles(parts: DataFrame, interval: str) -> DataFrame:
    """A1's columns of merged partial candles."""
    return parts.select(
        "ticker", F.lit(interval).alias("interval"), "start_time", "end_time", F.col("first.close_price").alias("open"), "high", "low",
        F.col("last.close_price").alias("close"), F.lit(None).cast("double").alias("volume"), "point_count")


def candle_stream(points: DataFrame, interval: str, table: str, *, points_table: str, checkpoint: str,
                  order: list[str] | None = None, trigger_once: bool = True):
    """R2: candles merged by (ticker, start_time) as points arrive, late ones included.

    Each micro-batch first goes into the points table (R1).  The points that
    were new there become partial candles, which are merged with the stored
    candles of the days they touch; ``candles`` reads the table.  Every stored
    candle carries the micro-batch that wrote its day, so a repeated
    micro-batch changes nothing.
    """
    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        new = MG.insert_ignore_rows(spark, batch, points_table, ["ticker", "quoted_at"], partition_col="trade_date", order=order, batch_id=epoch_id)
        parts = partial_candles(new, interval).withColumn("candle_date", F.to_date("start_time"))
        MG.combine_partitions(spark, parts, table, partition_col="candle_date", batch_id=epoch_id, combine=merge_candles)

    return _run(points.writeStream.foreachBatch(write), checkpoint, trigger_once)


def candles(spark: SparkSession, table: str, interval: str) -> DataFrame:
    """The candles that ``candle_stream`` or ``open_candles`` keeps in ``table``."""
    return as_candles(spark.read.parquet(table), interval)


def open_candles(points: DataFrame, interval: str, table: str, *, delay: str, checkpoint: str, trigger_once: bool = True):
    """R2 with bounded state: open buckets live in the state store.

    Points are at most ``delay`` late; Spark drops later ones and counts them
    in the query's progress.  Update mode: a micro-batch emits the buckets it
    changed, whole, and only the days of those are merged into the table.
    Points must be unique by (ticker, quoted_at): a stream of R1's table.
    """
    parts = partial_candles(_event_time(points).withWatermark("event_time", delay), interval, "event_time")
    parts = parts.withColumns({"start_time": _clock("start_time"), "end_time": _clock("end_time")})

    def write(batch: DataFrame, epoch_id: int) -> None:
        days = batch.withColumn("candle_date", F.to_date("start_time"))
        MG.upsert_partitions(batch.sparkSession, days, table, ["ticker", "start_time"], partition_col="candle_date",
                             update=["end_time", "first", "last", "high", "low", "point_count"])

    return _run(parts.writeStream.outputMode("update").foreachBatch(write), checkpoint, trigger_once)


def latest_stream(points: DataFrame, table: str, *, checkpoint: str, trigger_once: bool = True):
    """Newest point per ticker.

    The state store holds one point a ticker; in update mode a micro-batch
    emits the tickers it changed, which become one version folder of the
    table.  An idle ticker is not written again.  ``latest_points`` reads the
    newest version of each ticker.
    """
    cols = ["quoted_at", "trade_date", "close_price", "price_fluctuation_pct"]
    newest = points.groupBy("ticker").agg(F.max_by(F.struct(*cols), "quoted_at").alias("p")).select("ticker", "p.*")

    def write(batch: DataFrame, epoch_id: int) -> None:
        MG.write_version(batch, table, epoch_id)

    return _run(newest.writeStream.outputMode("update").foreachBatch(write), checkpoint, trigger_once)


def latest_points(spark: SparkSession, table: str) -> DataFrame:
    """One row per ticker from the versions that ``latest_stream`` wrote."""
    return latest_per_key(spark.read.parquet(table).drop("version"), "quoted_at")


def run_to_table(spark: SparkSession, start, name: str) -> str:
    """Run a stream built by ``start(table, checkpoint)`` to completion
    (``availableNow``) and return its table path."""
    table = scratch_path(spark, f"{name}-table")
    ckpt = scratch_path(spark, f"{name}-ckpt")
    q = start(table, ckpt)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return table
