"""Deep pages (T5-T8, A5): any page of a table of any size reads one range.

``ORDER BY .. LIMIT n OFFSET o`` keeps o + n rows in every task, so page ten
million costs as much as a sort of the table.  ``write_index`` sorts once, at
load time: rows go into ranges of the order, one file each, and carry their
place ``_row`` in the range.  Files grow before they become many: beyond
``SHORT_RANGES`` of them ranges get longer, up to ``ROWS_PER_RANGE`` rows, and
Parquet's pages inside a file have the ``rows_per_range`` asked for.  A directory of two levels counts them: groups of
``FAN_OUT`` ranges (each with its start in the table), and the ranges of a
group (each with its start in the group).  ``indexed_page`` looks the offset
up in the groups, then in one group's ranges, and reads the one or two ranges
that the page touches, with ``_row`` pushed down to their row groups and, by
the column index, to the Parquet pages that hold those rows.

The order must tell all rows apart, as that of ``pages.page`` must.  Rows that
are equal in it have some order that is fixed when the index is written.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from candlewick.session import ensure_checkpoint_dir, scratch_path

#: Rows of a range, about one file; ranges of a group of the directory; ranges
#: that may be shorter than ROWS_PER_RANGE.
ROWS_PER_RANGE = 500_000
FAN_OUT = 1_024
SHORT_RANGES = 64
_ROW_BITS = (1 << 33) - 1


def write_index(df: DataFrame, order: list[Column], path: str, *, rows_per_range: int = ROWS_PER_RANGE, fan_out: int = FAN_OUT) -> None:
    """Write ``df`` in ``order`` with its directory under ``path``, which must
    not exist; a failed attempt leaves no directory, so it is never read."""
    ensure_checkpoint_dir(df.sparkSession)
    spark = df.sparkSession
    # The rows are kept once: counting reads footers, sampling and sorting columns.
    kept = scratch_path(spark, "index-rows")
    df.write.parquet(kept)
    df = spark.read.schema(df.schema).parquet(kept)
    n = df.count()
    ranges = max(1, min(-(-n // rows_per_range), max(SHORT_RANGES, -(-n // ROWS_PER_RANGE))))
    place = F.spark_partition_id()
    dealt = df.repartitionByRange(ranges, *order).withColumn("_group", F.floor(place / F.lit(fan_out)).cast("int")).withColumn("_range", place)
    # In one stage after the sort, the low bits of the id are the row's place in its range.
    rows = dealt.sortWithinPartitions("_group", "_range", *order).withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)))
    rows.write.option("parquet.page.row.count.limit", rows_per_range).partitionBy("_group", "_range").parquet(os.path.join(path, "rows"))
    df.limit(0).write.parquet(os.path.join(path, "schema"))
    stored = spark.read.schema("_row long, _group int, _range int").parquet(os.path.join(path, "rows"))
    counts = stored.groupBy("_group", "_range").agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
    before = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)   # fan_out rows at most
    counts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).write.partitionBy("_group").parquet(os.path.join(path, "ranges"))
    groups = counts.groupBy("_group").agg(F.sum("n").alias("n"))
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)   # one row for fan_out ranges
    groups.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).coalesce(1).write.parquet(os.path.join(path, "groups"))


def _overlapping(lo: int, hi: int) -> Column:
    return (F.col("start") < hi) & (F.col("start") + F.col("n") > lo)


def indexed_page(spark: SparkSession, path: str, limit: int, offset: int = 0, *, total: bool = True) -> DataFrame:
    """The rows of ``[offset, offset + limit)`` in the index's order, with the
    table's ``total`` of rows.

    What reaches the driver are the directory's entries that the page
    overlaps: two at most for a page shorter than a range.
    """
    if limit < 0 or offset < 0:
        raise ValueError("limit and offset must be >= 0")
    lo, hi = offset, offset + limit
    groups = spark.read.schema("_group int, n bigint, start bigint").parquet(os.path.join(path, "groups"))
    schema = spark.read.parquet(os.path.join(path, "schema")).schema
    out = spark.createDataFrame([], schema).withColumn("_at", F.lit(0).cast("long"))
    rows_schema = StructType([*schema.fields, StructField("_row", LongType())])
    for g in groups.where(_overlapping(lo, hi)).collect() if limit else []:
        ranges = spark.read.schema("_range int, n bigint, start bigint").parquet(os.path.join(path, "ranges", f"_group={g._group}"))
        for r in ranges.where(_overlapping(lo - g.start, hi - g.start)).collect():
            first = g.start + r.start
            rows = spark.read.schema(rows_schema).parquet(os.path.join(path, "rows", f"_group={g._group}", f"_range={r._range}"))
            rows = rows.where((F.col("_row") >= max(0, lo - first)) & (F.col("_row") < hi - first))
            out = out.unionByName(rows.withColumn("_at", F.col("_row") + F.lit(first)).drop("_row"))
    out = out.orderBy("_at").drop("_at")
    return out.withColumn("total", groups.select(F.coalesce(F.sum("n"), F.lit(0))).scalar()) if total else out
