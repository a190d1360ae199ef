"""Idempotent table maintenance.

Plain parquet has no MERGE, so an upsert is expressed as DataFrames:

* ``merge_upsert``  - full outer join on the key; batch values win for the
  updated columns (a null in the batch overwrites), preserved columns keep
  the target value (or a default for new keys).
* ``insert_ignore`` - first row per key inside the batch, then a left-anti
  join against the target: existing keys are never touched.

The writers apply them to parquet tables partitioned by date: the touched
partition values are listed as literals, so only their folders are read, and
only they are replaced (``partitionOverwriteMode=dynamic``).  Batch and merged
rows are staged in the shared folder first, so a load that fails while it
writes is repaired by running it again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.plans.transforms import keep_first
from candlewick.session import ensure_checkpoint_dir

_IN = "_in_batch"


def merge_upsert(target: DataFrame, batch: DataFrame, keys: list[str], *, update: list[str],
                 preserve: dict[str, Column] | None = None) -> DataFrame:
    """K1/K2/K3/K5 as a pure DataFrame function.

    ``update``: columns taken from the batch for every batch key.
    ``preserve``: column -> default for new keys; the target value is kept.
    Columns of the target not named are carried from the target."""
    preserve = preserve or {}
    b = batch.select(*keys, *update, F.lit(True).alias(_IN))
    t_cols = [c for c in target.columns if c not in keys]
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in t_cols])
    j = t.join(b, keys, "full_outer")
    in_batch = F.col(_IN).isNotNull()
    out = [F.col(k) for k in keys]
    for c in update:
        tc = F.col(f"_t_{c}") if c in t_cols else F.lit(None)
        out.append(F.when(in_batch, F.col(c)).otherwise(tc).alias(c))
    for c, default in preserve.items():
        out.append(F.coalesce(F.col(f"_t_{c}"), default).alias(c))
    for c in t_cols:
        if c not in update and c not in preserve:
            out.append(F.col(f"_t_{c}").alias(c))
    return j.select(*out)


def insert_ignore(target: DataFrame, batch: DataFrame, keys: list[str], *, order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """K4: returns (new_rows, merged).  ``new_rows`` are the batch rows whose
    key is not in the target (first per key in ``order``); their count is the
    number of rows really inserted."""
    if order:
        first = keep_first(batch, keys, order).drop(*order)
    else:
        first = batch.dropDuplicates(keys)
    new_rows = first.join(target.select(*keys), keys, "left_anti")
    return new_rows, target.unionByName(new_rows.select(*target.columns))


# --------------------------------------------------------------------------- parquet tables

def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system, as readers name it."""
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toString()


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    fs, p = _fs(spark, old)
    if not fs.rename(p, _fs(spark, new)[1]):
        raise OSError(f"cannot rename {old} to {new}")


def _stage(df: DataFrame) -> DataFrame:
    """Evaluate a batch once, into the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Partition values that a batch may touch and still prune by a literal list.
MAX_TOUCHED = 10_000
#: Rows that one task writes into a date partition.
ROWS_PER_FILE = 2_000_000


def _touched(current: DataFrame, batch: DataFrame, partition_col: str) -> DataFrame:
    """The target's partitions that the batch has rows for.

    Partition values (days or years) are listed as literals, so the scan reads
    those folders only; a batch with more of them than ``MAX_TOUCHED`` is
    joined instead.
    """
    values = [r[0] for r in batch.select(partition_col).distinct().limit(MAX_TOUCHED + 1).collect()]
    if len(values) > MAX_TOUCHED:
        return current.join(batch.select(partition_col).distinct(), partition_col, "left_semi")
    return current.where(F.col(partition_col).isin(values))


def _spread(df: DataFrame, partition_col: str, keys: list[str]) -> DataFrame:
    """Deal staged rows by partition value, and a value of more than
    ``ROWS_PER_FILE`` rows by a salt of the key as well: about one file for
    every ``ROWS_PER_FILE`` rows of a value, so neither a hot date in one task
    nor many small files.  The driver holds the hot values only."""
    hot = df.groupBy(partition_col).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > ROWS_PER_FILE).collect()
    salts = F.lit(1)
    for files, values in _by_files(hot).items():
        salts = F.when(F.col(partition_col).isin(values), F.lit(files)).otherwise(salts)
    return df.repartition(F.col(partition_col), F.pmod(F.xxhash64(*keys), salts))


def _by_files(hot: list) -> dict[int, list]:
    """Hot partition values by their number of files, a power of two."""
    out: dict[int, list] = {}
    for value, n in hot:
        if value is not None:  # null has a folder of its own and is rare
            out.setdefault(1 << (-(-n // ROWS_PER_FILE) - 1).bit_length(), []).append(value)
    return out


def upsert_partitions(spark: SparkSession, batch: DataFrame, path: str, keys: list[str], *, partition_col: str,
                      update: list[str], preserve: dict[str, Column] | None = None, staged: bool = False) -> int:
    """K2/K3/K5 on a partitioned parquet table: only partitions present in
    the batch are read, merged and replaced.  The batch, one row per key, is
    evaluated once, by the caller if ``staged``.  Returns the number of batch
    rows (K7)."""
    batch = batch if staged else _stage(batch)
    n = batch.count()
    if n == 0:
        return 0
    if partition_col not in keys and partition_col not in update:
        update = [*update, partition_col]  # derived from the key: the same for old and new rows
    if _exists(spark, path):
        current = spark.read.parquet(path)
        merged = merge_upsert(_touched(current, batch, partition_col), batch, keys, update=update, preserve=preserve)
        # Staged: the target is read to the end before any of it is replaced.
        merged = _stage(merged.select(*current.columns))
    else:
        merged = merge_upsert(batch.limit(0), batch, keys, update=update, preserve=preserve)
    (_spread(merged, partition_col, keys).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path))
    return n


def insert_ignore_table(spark: SparkSession, batch: DataFrame, path: str, keys: list[str], *, partition_col: str,
                        order: list[str] | None = None, staged: bool = False) -> int:
    """K4 on a partitioned parquet table: append only unseen keys; returns
    the number of rows really inserted.  Batch (unless ``staged``) and new rows
    are evaluated once each, so the count and the append agree even if
    executors are lost in between."""
    batch = batch if staged else _stage(batch)
    if _exists(spark, path):
        target = _touched(spark.read.parquet(path), batch, partition_col)
    else:
        target = batch.drop(*(order or [])).limit(0)
    new_rows = _stage(insert_ignore(target, batch, keys, order=order)[0])
    n = new_rows.count()
    if n:
        _spread(new_rows, partition_col, keys).write.mode("append").partitionBy(partition_col).parquet(path)
    return n


def first_attempt(spark: SparkSession, path: str, batch_id: int) -> bool:
    """Whether a micro-batch comes to this table for the first time; notes that it came."""
    fs, p = _fs(spark, f"{path.rstrip('/')}.batches/{batch_id}")
    return fs.createNewFile(p)


def insert_ignore_rows(spark: SparkSession, batch: DataFrame, path: str, keys: list[str], *, partition_col: str, batch_id: int,
                       order: list[str] | None = None) -> DataFrame:
    """K4 for micro-batches: the rows that this batch inserted, also when it is repeated.

    Rows carry ``batch_id``.  A repeated batch takes its own rows out of what
    it compares with and returns them; only rows not yet stored are appended.
    """
    again = not first_attempt(spark, path, batch_id)
    batch = _stage(batch)
    empty = batch.drop(*(order or [])).limit(0)
    target = _touched(spark.read.parquet(path), batch, partition_col) if _exists(spark, path) else empty.withColumn("batch_id", F.lit(batch_id).cast("long"))
    mine = target.where(F.col("batch_id") == batch_id).drop("batch_id") if again else empty
    new_rows = _stage(insert_ignore(target.drop("batch_id"), batch, keys, order=order)[0])
    n = new_rows.count()
    if n:
        _spread(new_rows.withColumn("batch_id", F.lit(batch_id).cast("long")), partition_col, keys).write.mode("append").partitionBy(partition_col).parquet(path)
    return mine.select(*new_rows.columns).unionByName(new_rows) if again else new_rows


def combine_partitions(spark: SparkSession, parts: DataFrame, path: str, *, partition_col: str, batch_id: int, combine) -> None:
    """Merge partial aggregates into a partitioned table.

    ``combine`` reduces stored and new partial rows to one row a key and keeps
    the partition column.  Every partition carries the batch that wrote it
    last; a repeated batch leaves alone what it has written before.
    """
    again = not first_attempt(spark, path, batch_id)
    if _exists(spark, path):
        stored = _touched(spark.read.parquet(path), parts, partition_col)
        if again:
            done = stored.where(F.col("batch_id") >= batch_id).select(partition_col).distinct()
            parts, stored = (x.join(done, partition_col, "left_anti") for x in (parts, stored))
        parts = stored.select(*parts.columns).unionByName(parts)
    whole = _stage(combine(parts).withColumn("batch_id", F.lit(batch_id).cast("long")))
    if not whole.isEmpty():
        (_spread(whole, partition_col, ["ticker"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(partition_col).parquet(path))


def write_version(df: DataFrame, path: str, version: int) -> None:
    """Rows of one micro-batch as a folder of their own; a repeated batch replaces its folder."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/version={version}")


def read_published(spark: SparkSession, path: str) -> DataFrame | None:
    """The table that ``publish`` wrote last, or None.  A publish that was
    interrupted between its two renames is undone first."""
    previous = path.rstrip("/") + ".previous"
    if not _exists(spark, path) and _exists(spark, previous):
        _rename(spark, previous, path)
    return spark.read.parquet(path) if _exists(spark, path) else None


def publish(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Replace an unpartitioned table as a whole.

    The new version is written beside the table and takes its place by
    renames; the old one is deleted last.  At every moment the old or the new
    version is complete, and ``read_published`` finds it.
    """
    path = path.rstrip("/")
    new, previous = f"{path}.new-{uuid.uuid4().hex[:12]}", f"{path}.previous"
    df.write.mode("overwrite").parquet(new)
    if _exists(spark, path):
        fs, p = _fs(spark, previous)
        fs.delete(p, True)
        _rename(spark, path, previous)
    _rename(spark, new, path)
    fs, p = _fs(spark, previous)
    fs.delete(p, True)


def upsert_unpartitioned(spark: SparkSession, batch: DataFrame, path: str, keys: list[str], *,
                         update: list[str], preserve: dict[str, Column] | None = None) -> int:
    """K1 on an unpartitioned table (the instrument register): merge with the
    published version and publish the result.  Returns the number of batch
    rows, one per key."""
    batch = _stage(batch)
    n = batch.count()
    if n == 0:
        return 0
    target = read_published(spark, path)
    if target is None:
        empty = batch.select(*keys, *update)
        for c, d in (preserve or {}).items():
            empty = empty.withColumn(c, d)
        target = empty.limit(0)
    publish(spark, merge_upsert(target, batch, keys, update=update, preserve=preserve), path)
    return n


def attach_asset_id(facts: DataFrame, assets: DataFrame) -> DataFrame:
    """Facts with the ``asset_id`` of their ticker's register row, null
    where the register has none.  Facts are kept whole; the register has one
    row per ticker, and Spark broadcasts it only if its measured size allows."""
    ids = assets.select("ticker", F.xxhash64("ticker").alias("asset_id"))
    return facts.drop("asset_id").join(ids, "ticker", "left")
