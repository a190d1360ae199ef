"""Run ledgers.

Append-only parquet of run *events*: a RUNNING event when a load starts and a
SUCCESS / FAILED event when it ends, each written in its own job, so a crash
leaves the RUNNING event behind.  The current state of a run is the event
with the greatest ``event_seq`` (an aggregate per run).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("kind", T.StringType(), False),
    T.StructField("pipeline_name", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("event_seq", T.IntegerType(), False),
    T.StructField("event_at", T.TimestampNTZType(), False),
    T.StructField("source_file", T.StringType(), True),
    T.StructField("source_date", T.DateType(), True),
    T.StructField("rows_inserted", T.LongType(), True),
    T.StructField("rows_failed", T.LongType(), True),
    T.StructField("retry_count", T.IntegerType(), True),
    T.StructField("message", T.StringType(), True),
])


def _append(spark: SparkSession, path: str, row: tuple) -> None:
    spark.createDataFrame([row], EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def start_run(spark: SparkSession, path: str, pipeline_name: str, *, kind: str = "etl", source_file: str | None = None,
              source_date: dt.date | None = None, now: dt.datetime | None = None) -> str:
    run_id = uuid.uuid4().hex
    source_date = dt.date.fromisoformat(source_date) if isinstance(source_date, str) else source_date
    at = (now or dt.datetime.now(dt.timezone.utc)).replace(tzinfo=None)
    _append(spark, path, (run_id, kind, pipeline_name, "RUNNING", 0, at, source_file, source_date, None, None, 0, None))
    return run_id


def finish_run(spark: SparkSession, path: str, run_id: str, pipeline_name: str, *, status: str, rows_inserted: int = 0,
               rows_failed: int = 0, message: str | None = None, kind: str = "etl", retry_count: int = 0,
               now: dt.datetime | None = None) -> None:
    at = (now or dt.datetime.now(dt.timezone.utc)).replace(tzinfo=None)
    _append(spark, path, (run_id, kind, pipeline_name, status.upper(), 1, at, None, None, rows_inserted, rows_failed,
                          retry_count, message if status.upper() != "SUCCESS" else None))


def record_files(verdicts: DataFrame, path: str, run_id: str, pipeline_name: str) -> None:
    """The verdict of every file of a load: (file_name, status, message,
    rows_loaded), appended under the run that gave it.  What has status
    ``error`` is in quarantine: nothing of it was loaded."""
    verdicts.select(F.lit(run_id).alias("run_id"), F.lit(pipeline_name).alias("pipeline_name"), "file_name", "status", "message",
                    F.col("rows_loaded").cast("bigint").alias("rows_loaded")).write.mode("append").parquet(path)


def current_runs(events: DataFrame) -> DataFrame:
    """One row per run: latest status, start/finish time, counts, duration."""
    last = F.max_by(F.struct("status", "rows_inserted", "rows_failed", "retry_count", "message", "event_at"), "event_seq")
    g = events.groupBy("run_id").agg(
        F.first("kind", ignorenulls=True).alias("kind"),
        F.first("pipeline_name", ignorenulls=True).alias("pipeline_name"),
        F.min_by("event_at", "event_seq").alias("started_at"),
        F.max_by("source_file", F.when(F.col("source_file").isNotNull(), F.col("event_seq"))).alias("source_file"),
        F.max_by("source_date", F.when(F.col("source_date").isNotNull(), F.col("event_seq"))).alias("source_date"),
        last.alias("l"),
    )
    finished = F.when(F.col("l.status") != "RUNNING", F.col("l.event_at"))
    return g.select(
        "run_id", "kind", "pipeline_name", F.col("l.status").alias("status"), "started_at",
        finished.alias("finished_at"), "source_file", "source_date",
        F.col("l.rows_inserted").alias("rows_inserted"), F.col("l.rows_failed").alias("rows_failed"),
        F.col("l.retry_count").alias("retry_count"), F.col("l.message").alias("message"),
        (F.unix_micros(finished.cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))).alias("_us"),
    ).withColumn("duration_seconds", F.col("_us") / F.lit(1e6)).drop("_us")


def landing_runs(events: DataFrame) -> DataFrame:
    """The landing runs, with retries and the duration in whole milliseconds."""
    runs = current_runs(events).where(F.col("kind") == "landing")
    ms = F.round(F.col("duration_seconds") * 1000).cast("bigint")
    return runs.select("run_id", "pipeline_name", "status", "started_at", "finished_at", F.coalesce("retry_count", F.lit(0)).alias("retry_count"), ms.alias("duration_ms"), "message")
