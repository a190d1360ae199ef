"""Repeated-substring removal by sparse distributed prefix doubling.

A byte goes if it lies in a ``LENGTH``-byte (50) string that also starts in a
document with a smaller id.  Positions are named by ranks of growing prefixes:
the rank of 2h bytes at i is the (hashed) pair of the h-byte ranks at i and
i + h, and Spark sorts (rank, position) rows, drops positions whose rank is
unique, and ranks the rest at the next offset, until the threshold.

Ranks of a position are functions of its own text, so a task forms the pairs
and only positions that are still alive are sorted.  Every 50-byte string
holds a smallest 20-byte rank, its anchor; strings next to each other share
it, so the first round sorts one row per run of strings instead of one per
byte:

1. Map: ranks of 1, 2, 4, ... 32, then 20 = 16 + 4 and 50 = 32 + 18 bytes.  A
   run is up to 31 starts with the same anchor rank ``k0``; ``k1`` names its
   whole content by the 50-byte ranks at its ends.
2. Sort by k0, a task orders the few that share one by (k1, doc).  Unique k0: all strings of the run are unique, done.
   Same (k0, k1): equal content, so all but the smallest document lose it.
   Different k1 under one k0: first occurrences stay alive.
3. Offset 15: a string holds its anchor with the 15 bytes before it or with the
   15 after it.  Sort the 35-byte ranks of those alive; strings whose rank no
   other document has are unique, done.
4. Offset 18: sort the 50-byte ranks of every start that is left: all but the
   smallest document lose the string.
5. Ranges are merged per document and cut out of the text.

Before each sort a task ranks its own rows (``Limits.flush`` at a time) and settles
what is already decided there, so a passage held by any share of all documents
is one row per flush.  A 20-byte rank with many contents in a flush (the edge
of a popular passage) skips round 2: its rows go on to round 3, dealt by
content; and a 35-byte rank of several documents in a flush is alive already,
so its rows are dealt by document.  Ranks that are compared have 96 bits or more.  Nothing is collected;
intermediate tables are written to the shared folder.

Lengths are bytes of the UTF-8 text.  Rows without an id neither lose nor
remove anything.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm import common

LENGTH = 50
ANCHOR = 20
MIDDLE = 35
SIDE = MIDDLE - ANCHOR
#: String starts in a run at most: those that can share one anchor.
RUN = LENGTH - ANCHOR + 1


@dataclass(frozen=True)
class Limits:
    """Bounds of a task's memory; results do not depend on them."""

    #: Bytes ranked at once.
    piece: int = 1 << 21
    #: Rows that a task settles before it hands them on.
    flush: int = 1 << 20
    #: Contents of one anchor in a flush beyond which its rows skip round 2.
    crowd: int = 8


_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_BYTE = np.random.default_rng(50).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _pair(a: np.ndarray, b: np.ndarray, offset: int) -> np.ndarray:
    """Names of the pairs (a[i], b[i + offset])."""
    n = len(b) - offset
    x = a[:n] * _A
    x += b[offset:]
    x ^= x >> np.uint64(32)
    x *= _B
    x ^= x >> np.uint64(29)
    return x


def ranks(data: np.ndarray, middle: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(20-byte ranks, 50-byte or ``middle`` 35-byte ranks) of all starts of a byte array of at least 50 bytes."""
    r1 = _BYTE[data]
    r2 = _pair(r1, r1, 1)
    r4 = _pair(r2, r2, 2)
    r8 = _pair(r4, r4, 4)
    r16 = _pair(r8, r8, 8)
    r20 = _pair(r16, r4, ANCHOR - 4)
    r32 = _pair(r16, r16, 16)
    return r20, _pair(r32, r4, MIDDLE - 4) if middle else _pair(r32, r32, LENGTH - 32)


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    out = x
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[: len(out) - (width - span)], out[width - span :]) if span < width else out


def runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first start, number of starts, k0, k1) of the runs of concatenated texts that end at ``ends``."""
    r20, r50 = ranks(data)
    low = _window_min(r20, RUN)
    n = len(low)
    begin = np.concatenate(([0], ends[:-1]))
    valid = np.zeros(n + 1, dtype=np.int32)
    long = ends - begin >= LENGTH
    np.add.at(valid, begin[long], 1)
    np.add.at(valid, ends[long] - LENGTH + 1, -1)
    ok = np.cumsum(valid[:-1]) > 0
    new = np.ones(n, dtype=bool)
    new[1:] = (low[1:] != low[:-1]) | (ok[1:] != ok[:-1])
    new[begin[long]] = True
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, n))
    good = ok[at]
    at, size = at[good], size[good]
    parts = -(-size // RUN)  # a smallest rank that keeps coming back: cut the run
    if (parts > 1).any():
        k = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        at, size = np.repeat(at, parts) + k * RUN, np.minimum(np.repeat(size, parts) - k * RUN, RUN)
    last = at + size - 1
    k1 = _pair(_pair(r50[at], r50[last], 0), size.astype(np.uint64), 0)
    return at, size, low[at], k1


def _merge(doc: np.ndarray, tag: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Union of ranges per (doc, tag)."""
    if not len(doc):
        return doc, tag, start, end
    o = np.lexsort((start, tag, doc))
    doc, tag, start, end = doc[o], tag[o], start[o], end[o]
    group = np.concatenate(([True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])))
    lift = (np.cumsum(group) - 1) << 32
    top = np.maximum.accumulate(end + lift)
    new = group.copy()
    new[1:] |= (start + lift)[1:] > top[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(doc)) - 1
    return doc[at], tag[at], start[at], (top - lift)[last]


_ROW = "kind byte, k0 long, k1 long, doc long, tag long, at long"
_NAMES = ["kind", "k0", "k1", "doc", "tag", "at"]
# kind 0: range k0..k1 of (doc, tag) to cut; 1: live row; 2: live row of a crowded anchor.
# Live rows: at = first start << 5 | number of starts; a marker of a crowded anchor has at -1.
# Rows leave a task in text order: neighbours share doc and tag, which the shuffle's codec folds.


def _batch(kind, k0, k1, doc, tag, at) -> pa.RecordBatch:
    n = len(doc)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.broadcast_to(np.asarray(kind, np.int8), n)), *(pa.array(np.ascontiguousarray(c).view(np.int64)) for c in (k0, k1, doc, tag, at))], names=_NAMES)


def _cuts(doc, tag, start, end) -> pa.RecordBatch:
    doc, tag, start, end = _merge(doc, tag, start, end)
    return _batch(0, start, end, doc, tag, np.zeros(len(doc), np.int64))


def _settle(k0, k1, doc, start, size, tag, crowd: int | None) -> Iterator[pa.RecordBatch]:
    """What a task can decide on its own rows; the rest goes to the sort."""
    if not len(doc):
        return
    o, new0, new1, d = _order(k0, k1, doc)
    first = d[np.flatnonzero(new1)][np.cumsum(new1) - 1]
    gone = np.empty(len(o), dtype=bool)
    gone[o] = d > first
    yield _cuts(doc[gone], tag[gone], start[gone], start[gone] + size[gone] + LENGTH - 1)
    live = ~gone
    kind = np.ones(len(doc), dtype=np.int8)
    if crowd is not None:
        group = np.cumsum(new0) - 1
        many = np.bincount(group[new1])[group] > crowd
        kind[o[many]] = 2
        yield _markers(k0[o][new0 & many])
    yield _batch(kind[live], k0[live], k1[live], doc[live], tag[live], (start << 5 | size)[live])


def _order(k0, k1, doc):
    """Sorting order by (k0, k1, doc), where k0 and (k0, k1) begin in it, and doc in it."""
    o = np.argsort(k0)
    a = k0[o]
    same = np.concatenate(([False], a[1:] == a[:-1]))
    again = np.flatnonzero(same | np.append(same[1:], False))  # few share k0: sort those in full
    part = o[again]
    o[again] = part[np.lexsort((doc[part], k1[part], k0[part]))]
    b = k1[o]
    new1 = ~same
    new1[1:] |= b[1:] != b[:-1]
    return o, ~same, new1, doc[o]


def _markers(k0, k1=None) -> pa.RecordBatch:
    none = np.full(len(k0), -1)
    return _batch(1, k0, np.zeros(len(k0), np.int64) if k1 is None else k1, none, none, none)


def _settle_sides(k0, k1, doc, start, size, tag) -> Iterator[pa.RecordBatch]:
    """35-byte ranks: those of several documents are alive, whatever other tasks hold."""
    if not len(doc):
        return
    o, new0, new1, d = _order(k0, k1, doc)
    begin = np.flatnonzero(new1)
    last = np.append(begin[1:], len(d)) - 1
    shared = d[begin] != d[last]
    kind = np.ones(len(doc), dtype=np.int8)
    kind[o[np.repeat(shared, last - begin + 1)]] = 2
    at = o[begin[shared]]
    yield _markers(k0[at], k1[at])
    yield _batch(kind, k0, k1, doc, tag, start << 5 | size)


def _gather(cols: list[list[np.ndarray]]) -> list[np.ndarray]:
    return [np.concatenate(c) for c in cols]


def _runs(batches, limits: Limits):
    """Rows (anchor rank, content, doc, first start, number of starts, tag) of texts."""
    for ids, tags, tx in common.rows(batches):
        for buf, owner, offset in _pieces(tx, limits.piece):
            ends = np.cumsum([len(b) for b in buf])
            data = np.frombuffer(b"".join(buf), dtype=np.uint8)
            if len(data) < LENGTH:
                continue
            at, n, k0, k1 = runs(data, ends)
            which = np.searchsorted(ends, at, side="right")
            begin = np.concatenate(([0], ends[:-1]))
            row = np.array(owner)[which]
            yield k0.view(np.int64), k1.view(np.int64), np.array(ids, np.int64)[row], at - begin[which] + np.array(offset)[which], n, np.array(tags, np.int64)[row]


def _pieces(tx: list[str], piece: int):
    """(byte strings, their rows, their offsets) of about ``piece`` bytes; pieces of a long text overlap by 49 bytes."""
    buf, owner, offset, size = [], [], [], 0
    for k, t in enumerate(tx):
        b = t.encode()
        for at in range(0, max(1, len(b) - LENGTH + 1), piece):
            part = b[at : at + piece + LENGTH - 1]
            buf.append(part)
            owner.append(k)
            offset.append(at)
            size += len(part)
            if size >= piece:
                yield buf, owner, offset
                buf, owner, offset, size = [], [], [], 0
    if buf:
        yield buf, owner, offset


def _in_groups(cols: list[np.ndarray]) -> list[np.ndarray]:
    """Rows sorted by k0 in the order of (k0, kind, k1, doc): only those that share k0 move."""
    kind, k0, k1, doc = cols[:4]
    same = k0[1:] == k0[:-1]
    again = np.flatnonzero(np.concatenate(([False], same)) | np.concatenate((same, [False])))
    o = np.arange(len(k0))
    o[again] = again[np.lexsort((doc[again], k1[again], kind[again], k0[again]))]
    return [c[o] for c in cols]


def _sorted_groups(batches, flush: int) -> Iterator[list[np.ndarray]]:
    """Columns of sorted rows, never parting the live rows of one k0; ranges as they come."""
    held: list[list[np.ndarray]] = [[] for _ in _NAMES]
    size = 0
    for b in batches:
        cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(len(_NAMES))]
        old = cols[0] == 0
        if old.any():
            yield [c[old] for c in cols]
            cols = [c[~old] for c in cols]
        for c, x in zip(held, cols):
            c.append(x)
        size += len(cols[0])
        if size and size >= flush // 4:
            every = _gather(held)
            edge = np.flatnonzero(every[1] != every[1][-1])
            cut = int(edge[-1]) + 1 if len(edge) else 0
            if cut:
                yield _in_groups([c[:cut] for c in every])
            held, size = [[c[cut:]] for c in every], size - cut
    if size:
        yield _in_groups(_gather(held))


def _rank(keep_alive: bool, limits: Limits):
    """Sorted rows to ranges to cut and, in round 2, to the rows that stay alive."""

    def run(batches):
        for rows in _sorted_groups(batches, limits.flush):
            old = rows[0] == 0
            if old.any():
                yield _batch(*(c[old] for c in rows))
            kind, k0, k1, doc, tag, at = (c[~old] for c in rows)
            if not len(doc):
                continue
            new0 = np.concatenate(([True], (kind[1:] != kind[:-1]) | (k0[1:] != k0[:-1])))
            group = np.cumsum(new0) - 1
            real = at >= 0
            crowded = (kind == 2) | (np.bincount(group, weights=~real)[group] > 0)
            group, crowded, k0, k1, doc, tag, at = (c[real] for c in (group, crowded, k0, k1, doc, tag, at))
            if not len(doc):
                continue
            new1 = np.concatenate(([True], (group[1:] != group[:-1]) | (k1[1:] != k1[:-1])))
            first = doc[np.flatnonzero(new1)][np.cumsum(new1) - 1]
            gone = doc > first
            start, size = at >> 5, at & 31
            yield _cuts(doc[gone], tag[gone], start[gone], start[gone] + size[gone] + LENGTH - 1)
            if keep_alive:
                many = np.bincount(group[new1], minlength=group[-1] + 1)[group] > 1
                live = ~gone & (many | crowded)
                yield _batch(1, k0[live], k1[live], doc[live], tag[live], at[live])

    return run


def _rank_sides(limits: Limits):
    """Sorted 35-byte ranks to the rows whose rank several documents have."""

    def run(batches):
        for kind, k0, k1, doc, tag, at in _sorted_groups(batches, limits.flush):
            new = np.concatenate(([True], (kind[1:] != kind[:-1]) | (k0[1:] != k0[:-1]) | (k1[1:] != k1[:-1])))
            begin = np.flatnonzero(new)
            last = np.append(begin[1:], len(doc)) - 1
            many = (doc[begin] != doc[last]) | np.logical_or.reduceat(at < 0, begin)
            shared = np.repeat(many, last - begin + 1)
            live = (at >= 0) & (shared | (kind == 2))
            yield _batch(1, k0[live], k1[live], doc[live], tag[live], at[live])

    return run


def _slices(batches, limits: Limits):
    """Texts with their live runs, some at a time: (data, offsets of the slices in it, number of starts, anchor, doc, first start, tag)."""
    for ids, tags, tx, live in common.rows(batches):
        buf, who, where, n, anchor, total = [], [], [], [], [], 0

        def held():
            size = np.array([len(x) for x in buf])
            row = np.array(who)
            return (np.frombuffer(b"".join(buf), dtype=np.uint8), np.cumsum(size) - size, np.array(n), np.array(anchor, np.int64),
                    np.array(ids, np.int64)[row], np.array(where), np.array(tags, np.int64)[row])

        for r, (t, some) in enumerate(zip(tx, live)):
            b = t.encode()
            for x in some:
                start, count = x["at"] >> 5, x["at"] & 31
                buf.append(b[start : start + count + LENGTH - 1])
                who.append(r)
                where.append(start)
                n.append(count)
                anchor.append(x["k0"])
                total += len(buf[-1])
                if total >= limits.piece:
                    yield held()
                    buf, who, where, n, anchor, total = [], [], [], [], [], 0
        if buf:
            yield held()


def _within(count: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count."""
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)


def _sides(batches, limits: Limits):
    """Rows (35-byte rank, 32 bits of the anchor's, doc, first start, number of starts, tag)."""
    for data, begin, n, anchor, doc, where, tag in _slices(batches, limits):
        r20, r35 = ranks(data, middle=True)
        # Next place of the anchor's rank at or after each position of its slice.
        size = n + RUN - 1
        place = np.repeat(begin, size) + _within(size)
        hit = r20[place] == np.repeat(anchor.view(np.uint64), size)
        nxt = np.minimum.accumulate(np.where(hit, place, len(data))[::-1])[::-1]
        of = np.repeat(np.arange(len(n)), n)
        i = begin[of] + _within(n)
        p = nxt[np.repeat(np.cumsum(size) - size, n) + _within(n)]
        at = np.where(p - i >= SIDE, p - SIDE, p)
        new = np.concatenate(([True], (at[1:] != at[:-1]) | (of[1:] != of[:-1])))
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(at)))
        run = of[first]
        yield r35[at[first]].view(np.int64), anchor[run] >> 32, doc[run], where[run] + i[first] - begin[run], count, tag[run]


def _starts(batches, limits: Limits):
    """Rows (50-byte rank, 32 bits of the live rank, doc, start, 1, tag)."""
    for data, begin, n, anchor, doc, where, tag in _slices(batches, limits):
        _, r50 = ranks(data)
        of, k = np.repeat(np.arange(len(n)), n), _within(n)
        yield r50[begin[of] + k].view(np.int64), (anchor >> 32)[of], doc[of], where[of] + k, np.ones(len(k), np.int64), tag[of]


def _settled(find, settle, limits: Limits):
    """mapInArrow body: rows of ``find``, settled ``flush`` at a time."""

    def run(batches):
        held: list[list[np.ndarray]] = [[] for _ in range(6)]
        size = 0
        for cols in find(batches, limits):
            for c, v in zip(held, cols):
                c.append(v)
            size += len(cols[0])
            if size >= limits.flush:
                yield from settle(*_gather(held))
                held, size = [[] for _ in range(6)], 0
        if size:
            yield from settle(*_gather(held))

    return run


def _dealt(df: DataFrame, by) -> DataFrame:
    return df.repartition(common.partitions(df.sparkSession), by).sortWithinPartitions("k0")  # one number: a radix sort


def _tagged(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, tag (the text's hash: tells rows of one id apart), text."""
    docs = common.texts(df, id_col, text_col)
    return docs.select("doc_id", F.xxhash64("text").alias("tag"), "text")


def _with_live(docs: DataFrame, live: DataFrame) -> DataFrame:
    """Texts (one row each, copies of one id once) with their live rows in order."""
    per_doc = live.where("kind = 1").groupBy(F.col("doc").alias("doc_id"), "tag").agg(F.array_sort(F.collect_list(F.struct("at", "k0"))).alias("live"))
    return docs.join(per_doc, ["doc_id", "tag"]).dropDuplicates(["doc_id", "tag"]).select("doc_id", "tag", "text", "live")


def ranges(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """(doc_id, tag, cuts): the byte ranges that each text loses; they may overlap."""
    spark = df.sparkSession
    docs = _tagged(df, id_col, text_col).where(F.col("doc_id").isNotNull())
    found = docs.mapInArrow(_settled(_runs, lambda *c: _settle(*c, limits.crowd), limits), _ROW)
    settled = F.when(F.col("kind") == 0, F.xxhash64("doc", "tag"))  # ranges only pass through
    by = settled.when(F.col("kind") == 2, F.xxhash64("k0", "k1")).otherwise(F.col("k0"))
    alive = common.stored(_dealt(found, by).mapInArrow(_rank(True, limits), _ROW), "runs")
    common.release(spark)
    sides = _with_live(docs, alive).mapInArrow(_settled(_sides, _settle_sides, limits), _ROW)
    by = F.when(F.col("kind") == 2, F.xxhash64("doc", "at")).otherwise(F.xxhash64("k0", "k1"))
    shared = common.stored(_dealt(sides, by).mapInArrow(_rank_sides(limits), _ROW), "sides")
    common.release(spark)
    strings = _with_live(docs, shared).mapInArrow(_settled(_starts, lambda *c: _settle(*c, None), limits), _ROW)
    cut = common.stored(_dealt(strings, settled.otherwise(F.xxhash64("k0", "k1"))).mapInArrow(_rank(False, limits), _ROW), "starts")
    common.release(spark)
    both = alive.where("kind = 0").unionAll(cut.where("kind = 0"))
    return both.groupBy(F.col("doc").alias("doc_id"), "tag").agg(F.collect_list(F.struct(F.col("k0").alias("start"), F.col("k1").alias("end"))).alias("cuts"))


def apply_cuts(data: bytes, cuts: list[dict] | None) -> tuple[bytes, int]:
    """(remaining bytes, number of maximal removed runs)."""
    if not cuts:
        return data, 0
    z = np.zeros(len(cuts), np.int64)
    _, _, start, end = _merge(z, z, np.array([c["start"] for c in cuts]), np.array([c["end"] for c in cuts]))
    keep_from = np.concatenate(([0], end)).tolist()
    keep_to = [*start.tolist(), len(data)]
    return b"".join(data[a:b] for a, b in zip(keep_from, keep_to)), len(start)


_OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """One row per row of ``df``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A null or empty text has no bytes (digest of nothing); texts under 50
    bytes and rows with a null id lose nothing.  Rows that share an id never
    cut each other; repeated rows get the same result each.  Extra columns
    are left behind.
    """
    joined = _tagged(df, id_col, text_col).join(ranges(df, id_col, text_col, limits), ["doc_id", "tag"], "left").select("doc_id", "text", "cuts")

    def run(batches):
        for ids, tx, cuts in common.rows(batches):
            out: list[list] = [[], [], [], []]
            for t, c in zip(tx, cuts):
                b = t.encode()
                kept, spans = apply_cuts(b, c)
                for col, v in zip(out, (len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest())):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return joined.mapInArrow(run, _OUT)


def remove(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows and columns of ``df`` with the repeated bytes cut from the text.

    A character that lost some of its bytes goes as a whole.  Null texts stay
    null; a text may become empty, its row stays.
    """
    names = df.columns
    at = names.index(text_col)
    tag = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    r = ranges(df, id_col, text_col).select(F.col("doc_id").alias("__id"), F.col("tag").alias("__tag"), F.col("cuts").alias("__cuts"))
    joined = df.join(r, (F.col(id_col).cast("long") == F.col("__id")) & (tag == F.col("__tag")), "left").select(*(df[c] for c in names), "__cuts")

    def run(batches):
        for b in batches:
            cuts = b.column(len(names)).to_pylist()
            new = [t if not c else apply_cuts(t.encode(), c)[0].decode("utf-8", "ignore") for t, c in zip(b.column(at).to_pylist(), cuts)]
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if i == at else b.column(i) for i in range(len(names))], names=names)

    return joined.mapInArrow(run, df.schema)
