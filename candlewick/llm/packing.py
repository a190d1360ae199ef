"""Best-fit packing of token sequences with certified bin counts.

Pieces (a document's ids and an end id, cut only past the capacity) are dealt
by hash to groups of about ``GROUP`` pieces.  A group is packed by best-fit
decreasing, and dual feasible functions give a lower bound for its number of
bins: where both agree the group is certified optimal and done.  Groups with a
gap keep their completely full bins and exchange the documents of the others.
A certified group may still end on a loose bin, and many groups on as many, so
bins under ``LOOSE`` of the capacity are exchanged too.  The exchanged pieces
are dealt anew and packed again, until none are left, one group holds them all,
or a round no longer lowers the number of sequences; then the packing before
that round stands.

Ids never move: a worker cuts and checksums a text where it reads it, and only
piece rows (a few numbers each) are shuffled.  Groups are bounded by ``GROUP``
whatever the keys, since a piece's group comes from a hash of all its numbers.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm import common, token_ids

CAPACITY = 4096
GROUP = 20_000
LOOSE = 0.95


def pieces(df: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = token_ids.END_ID, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids).

    Only documents longer than ``capacity`` ids, end id included, are cut.  A
    null or empty text is one piece of its end id.  Repeated rows give pieces
    each; extra columns are left behind.
    """

    def run(batches):
        enc = token_ids.encoder(tokenizer)
        step = 4 * capacity
        for ids, tx in common.rows(batches):
            out: list[list] = [[], [], [], [], []]
            raw = []
            for i, t in zip(ids, tx):
                got = token_ids.ids_with_end(enc, t, end_id)
                for k, at in enumerate(range(0, len(got), step)):
                    part = got[at : at + step]
                    for col, v in zip(out, (i, k, at // 4, len(part) // 4, zlib.crc32(part))):
                        col.append(v)
                    if with_ids:
                        raw.append(np.frombuffer(part, dtype="<i4"))
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            cols = [pa.array(c, ty) for c, ty in zip(out, types)] + ([pa.array(raw, pa.list_(pa.int32()))] if with_ids else [])
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return common.texts(df, id_col, text_col).mapInArrow(run, schema)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item: longest first, into the fullest bin that takes it."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room r
    n = 0
    for i, size in zip(order.tolist(), lengths[order].tolist()):
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = open_by_room[room].pop()
            if not open_by_room[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, n
            n += 1
        bins[i], offsets[i] = b, capacity - room
        left = room - size
        if left:
            open_by_room[left].append(b)
            rooms |= 1 << left
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int, steps: int = 30) -> int:
    """Bins that any packing needs, by two families of dual feasible functions.

    * f_k: lengths over capacity - k count as full bins, those under k as
      nothing, the rest as they are, for every distinct length k <= capacity / 2;
    * u_k: length x as floor((k + 1) x / capacity) / k of a bin, or itself
      where (k + 1) x / capacity is whole, for k up to ``steps``.
    """
    if not len(lengths):
        return 0
    sizes, counts = np.unique(lengths, return_counts=True)
    best = -(-int((sizes * counts).sum()) // capacity)
    tail = np.concatenate((np.cumsum((sizes * counts)[::-1])[::-1], [0]))
    many = np.concatenate((np.cumsum(counts[::-1])[::-1], [0]))
    k = sizes[sizes <= capacity // 2]
    full = np.searchsorted(sizes, capacity - k, side="right")
    low = np.searchsorted(sizes, k, side="left")
    if len(k):
        best = max(best, int((many[full] + -(-(tail[low] - tail[full]) // capacity)).max()))
    for j in range(1, steps + 1):
        whole = (j + 1) * sizes % capacity == 0
        # in units of 1 / (j * capacity) of a bin
        value = np.where(whole, j * sizes, (j + 1) * sizes // capacity * capacity)
        best = max(best, -(-int((value * counts).sum()) // (j * capacity)))
    return best


def _packer(turn: int, capacity: int):
    def best(part: pd.DataFrame) -> pd.DataFrame:
        # Ties in a fixed order, so that a retried task packs the same way.
        part = part.sort_values(["length", "__uid"], ascending=[False, True], ignore_index=True)
        lengths = part["length"].to_numpy(np.int64)
        bins, offsets = best_fit_decreasing(lengths, capacity)
        used = np.bincount(bins, weights=lengths)
        base = (turn << 48) + (int(part["__part"].iloc[0]) << 24)
        certified = len(used) == lower_bound(lengths, capacity)
        settled = used >= (LOOSE * capacity if certified else capacity)
        return part.assign(sequence_id=base + bins, offset=offsets, certified=certified, __settled=settled[bins])

    return best


def pack(rows: DataFrame, capacity: int = CAPACITY, group: int = GROUP, rounds: int | None = None) -> DataFrame:
    """Add sequence_id and offset to piece rows; column ``certified`` says whether the bound was met.

    ``rows`` needs doc_id, piece and length (1 to ``capacity``); other columns
    pass through.  Repeated rows are packed each.  No rows, no sequences.
    ``rounds`` stops earlier.
    """
    names = rows.columns
    todo = common.cut(rows.withColumn("__uid", F.monotonically_increasing_id()))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in todo.schema), "__part int, sequence_id long, `offset` long, certified boolean, __settled boolean"])
    done = []
    last, before, turn = None, 0, 0
    while True:
        n = todo.count()
        groups = max(1, -(-n // group))
        dealt = todo.withColumn("__part", F.pmod(F.xxhash64("doc_id", "piece", "__uid", F.lit(turn)), F.lit(groups)).cast("int"))

        packed = common.cut(dealt.groupBy("__part").applyInPandas(_packer(turn, capacity), schema))
        turn += 1
        # One piece of each sequence has offset 0.
        bins, left = packed.where("offset = 0").select(F.count(F.lit(1)), F.count_if(~F.col("__settled"))).first()
        if last is not None and bins >= before:
            done.append(last)
            break
        if turn == rounds or groups == 1 or not left:
            done.append(packed)
            break
        done.append(packed.where("__settled"))
        last, before = packed.where("not __settled"), left
        todo = last.select(*names, "__uid")
    out = done[0]
    for d in done[1:]:
        out = out.unionAll(d)
    return out.select(*names, "sequence_id", "offset", "certified")


def sequences(packed: DataFrame) -> DataFrame:
    """Packed token sequences, from pieces that carry ``ids``: sequence_id, doc_ids, ids.

    A sequence holds at most ``capacity`` ids, so the grouped lists are bounded.
    """
    item = F.struct("offset", "doc_id", "piece", "ids")
    ordered = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(item)).alias("x"))
    return ordered.select("sequence_id", F.col("x.doc_id").alias("doc_ids"), F.flatten("x.ids").alias("ids"))
