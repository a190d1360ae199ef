"""Helpers shared by the operators of this package."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.session import ensure_checkpoint_dir

#: Rows per Arrow batch: texts may be long, so a batch stays a few MB.
BATCH_ROWS = 500


def arrow_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the Arrow batches that reach Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` (long) and ``text`` (null becomes empty); other columns go."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def cut(df: DataFrame) -> DataFrame:
    """Materialise once in ``spark.checkpoint.dir`` and cut the lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Like ``cut`` for large tables: a compressed table in the shared folder."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished rounds now.

    A shuffle is found free one collection after the plan that held it.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, ...]]:
    """Column lists of each Arrow batch."""
    for b in batches:
        if b.num_rows:
            yield tuple(b.column(i).to_pylist() for i in range(b.num_columns))


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)
