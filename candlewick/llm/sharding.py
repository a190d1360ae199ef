"""Rendezvous hashing of stable record keys over weighted shards.

Every (key, shard) pair gets a pseudo-random number ``u`` in (0, 1) from the
MD5 of both; the record goes to the shard with the smallest ``-ln(u) /
weight``.  A record's shard depends on its key and the shard list only, so a
further shard takes records into itself and moves no other.

The whole operator is column expressions.  Slots inside a shard are numbered
by a prefix sum over hash ranges of the keys and parts of them, never by one
task per shard or per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.session import ensure_checkpoint_dir

#: Hash ranges per shard (three hex digits of the key's MD5).
CHUNK_DIGITS = 3
#: Different rows that one task numbers; a larger hash range is numbered in parts.
PART_ROWS = 1_000_000
#: Copies of a row that one task writes out at a time.
BLOCK_ROWS = 100_000


def _key(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit("null"))


def _draw(key: Column, shard: int, weight: float) -> Column:
    """Exponential draw of rate ``weight`` for a (key, shard) pair (52 bits of the MD5)."""
    digits = F.substring(F.md5(F.concat(_key(key), F.lit(f":{shard}"))), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**52))
    return -F.log(u) / F.lit(float(weight))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Shard index (int) of a key; ``weights`` holds a positive weight per shard.

    A null key counts as the string ``null``; equal keys share a shard; on
    equal draws the smaller shard index wins.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a positive weight")
    draws = [F.struct(_draw(key, s, w).alias("draw"), F.lit(s).alias("shard")) for s, w in enumerate(weights)]
    return (draws[0] if len(draws) == 1 else F.least(*draws))["shard"]


def with_slots(df: DataFrame, key: str, shard: str, order: Sequence[str] = ()) -> DataFrame:
    """Add ``slot``: 0, 1, 2, ... inside each shard, by MD5 of the key, the key, then ``order``.

    Repeated rows are counted before they are numbered and take consecutive
    slots.  A hash range with more than ``PART_ROWS`` different rows, as under a
    key that many rows share, is numbered in parts by a hash of the whole row,
    one after the other.  All columns of ``df`` must be of types that group.
    """
    spark, cols = df.sparkSession, df.columns
    ensure_checkpoint_dir(spark)
    rows = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    rows = rows.withColumn("__h", F.md5(_key(F.col(key)))).withColumn("__c", F.substring("__h", 1, CHUNK_DIGITS)).checkpoint(eager=True)
    ranges = rows.groupBy(F.col(shard).alias("__s"), F.col("__c").alias("__cc")).agg(F.count(F.lit(1)).alias("__rows"))
    split = ranges.where(F.col("__rows") > PART_ROWS).select("__s", "__cc", F.ceil(F.col("__rows") / PART_ROWS).alias("__parts"))
    dealt = rows.join(split, (F.col(shard) == F.col("__s")) & (F.col("__c") == F.col("__cc")), "left").drop("__s", "__cc")
    dealt = dealt.withColumn("__p", F.pmod(F.xxhash64(*cols), F.coalesce("__parts", F.lit(1)))).drop("__parts")
    counts = dealt.groupBy(F.col(shard).alias("__s"), F.col("__c").alias("__cc"), F.col("__p").alias("__pp")).agg(F.sum("__n").alias("__m"))
    before = Window.partitionBy("__s").orderBy("__cc", "__pp").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__s", "__cc", "__pp", F.coalesce(F.sum("__m").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(shard, "__c", "__p").orderBy("__h", key, *order, *[c for c in cols if c not in order]).rowsBetween(Window.unboundedPreceding, -1)
    ranked = dealt.withColumn("__r", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    joined = ranked.join(starts, (F.col(shard) == F.col("__s")) & (F.col("__c") == F.col("__cc")) & (F.col("__p") == F.col("__pp")))
    first = joined.select(*cols, (F.col("__start") + F.col("__r")).alias("__first"), "__n")
    if not rows.where(F.col("__n") > BLOCK_ROWS).isEmpty():
        # A row that recurs often is written out by many tasks.
        block = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / BLOCK_ROWS)))
        first = first.select("*", block.alias("__b")).select(
            *cols, (F.col("__first") + F.col("__b") * BLOCK_ROWS).alias("__first"), F.least(F.col("__n") - F.col("__b") * BLOCK_ROWS, F.lit(BLOCK_ROWS)).alias("__n"))
        first = first.repartition(F.col("__first"), F.col(shard))
    return first.select(*cols, F.explode(F.sequence(F.col("__first"), F.col("__first") + F.col("__n") - 1)).alias("slot"))


def assign(df: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per record: key, size, text_crc32, shard, slot, grown_shard.

    ``size`` is the UTF-8 length of the text (null: none) plus 16.  A null
    text has the checksum of the empty one.  Repeated rows go to one shard
    and take a slot each.  Extra columns of the input are left behind, so
    they cannot clash.  An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    slim = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
    )
    placed = slim.withColumn("shard", shard_of(F.col("doc_id"), weights))
    placed = placed.withColumn("grown_shard", shard_of(F.col("doc_id"), grown) if grown else F.lit(None).cast("int"))
    return with_slots(placed, "doc_id", "shard", order=("size", "text_crc32"))
