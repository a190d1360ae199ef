"""Token ids as directly addressable codes.

An id is cut into chunks of ``WIDTH`` = 8 bits.  Level 0 holds the lowest
chunk of every id, level k the next chunk of those ids that go on past level
k-1; a continuation bitmap per level says which do, and a rank directory (ones
before every 512th bit) finds an id's place in the next level.  Any token is
read by touching a few bytes per level: nothing else is decoded.

File format: Parquet written and committed by Spark, one row per block of
whole documents::

    shard int, block int, n_tokens long, doc_id array<long>,
    doc_start array<long> (inside the block), payload binary

``payload``: magic ``DAC1``, uint32 levels, uint64 tokens, then for each level
uint64 entries, the entries (uint8), the bitmap (bit i of byte i // 8) and the
rank directory (uint32), all little-endian.  Shards are consecutive ranges of
doc_id, blocks consecutive inside a shard, so (shard, block) is ascending
doc_id order.  A lost writer's attempt is discarded by Spark's commit.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.llm import common, token_ids

MAGIC = b"DAC1"
WIDTH = 8
SUPER = 512
#: A block closes at this many tokens; one document is never split.
BLOCK_TOKENS = 1 << 17


def pack(ids: np.ndarray) -> bytes:
    """Ids (unsigned, below 2**32) to a payload."""
    rest = ids.astype(np.uint32)
    levels = []
    while True:
        on = rest > 0xFF
        bits = np.packbits(on, bitorder="little")
        pad = np.zeros(-len(on) % SUPER + len(on), dtype=bool)
        pad[: len(on)] = on
        ones = pad.reshape(-1, SUPER).sum(axis=1, dtype=np.uint32)
        directory = np.cumsum(ones, dtype=np.uint32) - ones
        levels.append(struct.pack("<Q", len(rest)) + (rest & 0xFF).astype(np.uint8).tobytes() + bits.tobytes() + directory.astype("<u4").tobytes())
        if not on.any():
            break
        rest = rest[on] >> WIDTH
    return MAGIC + struct.pack("<IQ", len(levels), len(ids)) + b"".join(levels)


class Codes:
    """Random access to a payload."""

    def __init__(self, payload: bytes) -> None:
        if payload[:4] != MAGIC:
            raise ValueError("not a DAC payload")
        n_levels, self.n = struct.unpack_from("<IQ", payload, 4)
        at, self.levels = 16, []
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", payload, at)
            at += 8
            chunk = np.frombuffer(payload, np.uint8, n, at)
            at += n
            bits = np.frombuffer(payload, np.uint8, (n + 7) // 8, at)
            at += len(bits)
            directory = np.frombuffer(payload, "<u4", (n + SUPER - 1) // SUPER, at)
            at += 4 * len(directory)
            self.levels.append((chunk, bits, directory))

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for k, (chunk, bits, directory) in enumerate(self.levels):
            out |= int(chunk[i]) << (WIDTH * k)
            byte, bit = divmod(i, 8)
            if not bits[byte] >> bit & 1:
                return out
            top = i // SUPER
            inside = int(np.bitwise_count(bits[top * SUPER // 8 : byte]).sum()) + int(bits[byte] & ((1 << bit) - 1)).bit_count()
            i = int(directory[top]) + inside
        raise ValueError("continuation past the last level")

    def all(self) -> np.ndarray:
        """Every id, level by level."""
        out = np.zeros(self.n, dtype=np.uint32)
        where = np.arange(self.n)
        for k, (chunk, bits, _) in enumerate(self.levels):
            out[where] |= chunk.astype(np.uint32) << np.uint32(WIDTH * k)
            where = where[np.unpackbits(bits, count=len(chunk), bitorder="little").astype(bool)]
        return out


_BLOCKS = "shard int, block int, n_tokens long, doc_id array<long>, doc_start array<long>, payload binary"


def write(df: DataFrame, path: str, tokenizer: str, end_id: int = token_ids.END_ID, shards: int | None = None, block_tokens: int = BLOCK_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of whole texts, each followed by ``end_id``, in ascending doc_id order.

    Null ids come first; rows of one id are ordered by a hash of their text
    and then as read, and range shards may part them, so no id is too
    frequent.  A null or empty text is its end id alone.  Extra columns are
    left behind; an empty table writes an empty dataset.
    """
    spark = df.sparkSession
    order = ["doc_id", "__h", "__m"]
    docs = common.texts(df, id_col, text_col).withColumns({"__h": F.xxhash64("text"), "__m": F.monotonically_increasing_id()})
    ranged = docs.repartitionByRange(shards or common.partitions(spark), *order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("shard"), "doc_id", "text")

    def encode(batches):
        enc = token_ids.encoder(tokenizer)
        shard, block, ids, starts, parts, n = 0, 0, [], [], [], 0

        def close():
            payload = pack(np.frombuffer(b"".join(parts), dtype="<u4"))
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([n], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([starts], pa.list_(pa.int64())), pa.array([payload], pa.binary())],
                names=["shard", "block", "n_tokens", "doc_id", "doc_start", "payload"])

        for which, doc_ids, tx in common.rows(batches):
            shard = which[0]
            for i, t in zip(doc_ids, tx):
                got = token_ids.ids_with_end(enc, t, end_id)
                ids.append(i)
                starts.append(n)
                parts.append(got)
                n += len(got) // 4
                if n >= block_tokens:
                    yield close()
                    block, ids, starts, parts, n = block + 1, [], [], [], 0
        if ids:
            yield close()

    ranged.mapInArrow(encode, _BLOCKS).write.option("compression", "none").parquet(path)


def starts(blocks: DataFrame) -> DataFrame:
    """(shard, block, start): ids before each block, from the block sizes alone.

    Two levels: blocks inside their shard, then one row per shard.
    """
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocks.select("shard", "block", "n_tokens")
    totals = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    shards = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return sizes.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(shards, "shard").select("shard", "block", (F.col("base") + F.col("inside")).cast("long").alias("start"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32, shard, block."""
    blocks = spark.read.schema(_BLOCKS).parquet(path)

    def decode(batches):
        for shard, block, ids, at, payload in common.rows(batches):
            for s, b, doc, first, p in zip(shard, block, ids, at, payload):
                every = Codes(p).all().astype("<u4")
                ends = [*first[1:], len(every)]
                crc = [zlib.crc32(every[x:y].tobytes()) for x, y in zip(first, ends)]
                n = len(doc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s] * n, pa.int32()), pa.array([b] * n, pa.int32()), pa.array(doc, pa.int64()), pa.array(first, pa.int64()), pa.array([y - x for x, y in zip(first, ends)], pa.int64()), pa.array(crc, pa.int64())],
                    names=["shard", "block", "doc_id", "at", "n_tokens", "ids_crc32"])

    docs = blocks.select("shard", "block", "doc_id", "doc_start", "payload").mapInArrow(decode, "shard int, block int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return docs.join(starts(blocks), ["shard", "block"]).select("doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "shard", "block")


def token_at(spark: SparkSession, path: str, position: int) -> int | None:
    """The id at a global position, from one block and a few bytes a level; None past the end."""
    blocks = spark.read.schema(_BLOCKS).parquet(path)
    hit = starts(blocks).where(F.col("start") <= position).orderBy(F.desc("start")).limit(1).first()
    if hit is None or position < 0:
        return None
    row = blocks.where((F.col("shard") == hit["shard"]) & (F.col("block") == hit["block"])).select("payload").first()
    codes = Codes(bytes(row["payload"]))
    at = position - hit["start"]
    return codes[at] if at < len(codes) else None
