"""SimHash near-duplicates by a binary-trie self-join.

Fingerprints within ``MAX_BITS`` = 3 differing bits agree exactly on one of
four 16-bit blocks.  Each distinct fingerprint is rotated so that each block
comes first in turn, and Spark groups the rotations by that block: these are
the trie nodes at depth 16 whose pairs with themselves have spent no error.
Inside a task the trie below is traversed as pairs of nodes, ``STRIDE`` bits
at a step; a pair's differing bits add up and the pair is pruned once they
exceed the budget.  Every surviving leaf pair is a link, found without
comparing all pairs.

A node with more than ``NODE_LIMIT`` distinct fingerprints is not given to one
task: a further round deals its fingerprints to the pairs of its children that
are within the budget, 8 bits deeper, and again until no node is over the limit
or no bits are left.  Equal fingerprints are one row from the start, so a group
of copies of any size is one node.  Tasks return spanning forests, never all
pairs of a group; ``components`` joins them up.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm import common
from candlewick.llm.components import components, merge_labels

MAX_BITS = 3
SHINGLE = 3
SEED = 42
STRIDE = 4
NODE_LIMIT = 200_000
#: Node pairs expanded at once in a task, and rows gathered before a traversal.
FRONTIER = 1 << 20
GATHER = 1 << 16
_CHUNK = 1 << 15


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles, repeats included; no words: zero.

    A-Z count as a-z.  A text shorter than one shingle is one shingle.
    """
    words = text.encode().lower().split()  # bytes: exactly the six ASCII spaces, and only A-Z change
    if not words:
        return 0
    flat = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends[:-1])]
    h = xxhash.xxh64_intdigest
    last = ends[shingle - 1 :] or ends[-1:]
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(last), _CHUNK):
        hashed = np.array([h(flat[s:e], SEED) for s, e in zip(starts[i : i + _CHUNK], last[i : i + _CHUNK])], dtype="<u8")
        ones += np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(last), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, fp): fp is the fingerprint as a signed long, text_key a 64-bit hash of the text."""

    def run(batches):
        for ids, keys, tx in common.rows(batches):
            fp = np.array([fingerprint(t, shingle) for t in tx], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(fp)], names=["doc_id", "text_key", "fp"])

    docs = common.texts(df, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return docs.mapInArrow(run, "doc_id long, text_key long, fp long")


def _node_rows(fp: np.ndarray, depth: int) -> np.ndarray:
    """First ``depth`` bits."""
    return fp >> np.uint64(64 - depth)


def trie_pairs(fp: np.ndarray, node: np.ndarray, side: np.ndarray, depth: int, spent: np.ndarray, max_bits: int = MAX_BITS):
    """Yield (p, q) index arrays of all linked pairs of rows.

    Rows are sorted by (node, side, fp).  Rows of a node with side 0 only are
    joined with themselves, otherwise side 0 with side 1.  ``spent`` holds a
    row's differing bits down to ``depth``, the same for all rows of a node.
    """
    n = len(fp)
    if n == 0:
        return
    top = np.concatenate(([True], (node[1:] != node[:-1]) | (side[1:] != side[:-1])))
    levels = {}

    def level(d: int):
        """Per row its trie node at depth d; per trie node its first row and one past its last."""
        if d not in levels:
            new = top.copy()
            if d:
                key = _node_rows(fp, d)
                new[1:] |= key[1:] != key[:-1]
            first = np.flatnonzero(new)
            levels[d] = (np.cumsum(new) - 1, first, np.append(first[1:], n))
        return levels[d]

    # Root pairs at the given depth: each (node, side) is one trie node there.
    of, first, _ = level(0)
    roots = np.arange(len(first))
    is_b = side[first] == 1
    has_b = np.append(is_b[1:], False) & ~is_b & (np.append(node[first][1:], -1) == node[first])
    p = np.concatenate((roots[~is_b & ~has_b], roots[has_b]))
    q = np.concatenate((roots[~is_b & ~has_b], roots[has_b] + 1))
    stack = [(depth, 0, p, q, spent[first[p]].astype(np.int64))]
    while stack:
        d, at, p, q, diff = stack.pop()
        if d == 64:
            _, first, _ = level(at)
            a, b = first[p], first[q]
            apart = a != b
            if apart.any():
                yield a[apart], b[apart]
            continue
        step = min(STRIDE, 64 - d)
        of, first, end = level(at)
        sub, sub_first, _ = level(d + step)
        a0, b0 = sub[first[p]], sub[first[q]]
        na, nb = sub[end[p] - 1] - a0 + 1, sub[end[q] - 1] - b0 + 1
        size = na * nb
        if len(p) > 1 and size.sum() > FRONTIER:
            half = len(p) // 2
            for s in (slice(None, half), slice(half, None)):
                stack.append((d, at, p[s], q[s], diff[s]))
            continue
        pair = np.repeat(np.arange(len(p)), size)
        k = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
        a, b = a0[pair] + k // nb[pair], b0[pair] + k % nb[pair]
        once = (p[pair] != q[pair]) | (a <= b)
        pair, a, b = pair[once], a[once], b[once]
        mask = np.uint64((1 << step) - 1)
        digit = (fp[sub_first] >> np.uint64(64 - d - step)) & mask
        left = diff[pair] + np.bitwise_count(digit[a] ^ digit[b])
        good = left <= max_bits
        if good.any():
            stack.append((d + step, d + step, a[good], b[good], left[good]))


def _traverse(depth: int, max_bits: int):
    """mapInArrow body: sorted rows (node, side, spent, rotated, fp) to spanning edges (a, b)."""

    def edges(cols):
        node, side, spent, rot, fp = cols
        rot = rot.view(np.uint64)
        labels = np.arange(len(rot))
        for p, q in trie_pairs(rot, node, side, depth, spent, max_bits):
            merge_labels(labels, p, q)
        tied = np.flatnonzero(labels != np.arange(len(labels)))
        return pa.RecordBatch.from_arrays([pa.array(fp[tied]), pa.array(fp[labels[tied]])], names=["a", "b"])

    def run(batches):
        held: list[tuple] = []
        size = 0
        for b in batches:
            if not b.num_rows:
                continue
            cols = tuple(b.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            held.append(cols)
            size += b.num_rows
            if size >= GATHER:
                every = tuple(np.concatenate(c) for c in zip(*held))
                cut = int(np.searchsorted(every[0], every[0][-1]))  # the last node may go on
                if cut:
                    yield edges(tuple(c[:cut] for c in every))
                held, size = [tuple(c[cut:] for c in every)], len(every[0]) - cut
        if held:
            yield edges(tuple(np.concatenate(c) for c in zip(*held)))

    return run


def links(distinct: DataFrame, max_bits: int = MAX_BITS, node_limit: int = NODE_LIMIT) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints (column fp) linked directly or through others.

    ``max_bits`` up to 3.  Spanning forests of the links, so at most a few
    rows for each fingerprint.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("four blocks find at most 3 differing bits")
    spark = distinct.sparkSession
    rotations = F.explode(F.array(*(F.struct(F.lit(16 * r).alias("by"), F.expr(f"(fp << {16 * r}) | shiftrightunsigned(fp, {64 - 16 * r})" if r else "fp").alias("rot")) for r in range(4)))).alias("r")
    live = distinct.select("fp", rotations).select(
        (F.col("r.by") * 4096 + F.shiftrightunsigned("r.rot", 48)).cast("long").alias("node"),
        F.lit(0).alias("side"), F.lit(0).alias("spent"), F.col("r.rot").alias("rot"), "fp")
    live = common.cut(live)
    out, depth = None, 16
    while True:
        sizes = live.groupBy("node").agg(F.count(F.lit(1)).alias("n"), (F.max("side") == 1).alias("cross"))
        over = sizes.where(F.col("n") > node_limit).select("node", "cross")
        any_over = depth < 64 and bool(over.limit(1).count())
        ready = live.join(over, "node", "left_anti") if any_over else live
        deal = ready.repartition(common.partitions(spark), "node").sortWithinPartitions("node", "side", F.col("rot").bitwiseXOR(F.lit(-(2**63))))
        found = deal.select("node", "side", "spent", "rot", "fp").mapInArrow(_traverse(depth, max_bits), "a long, b long")
        out = found if out is None else out.unionAll(found)
        if not any_over:
            return out
        live = common.cut(_deeper(live.join(over, "node"), depth, max_bits))
        depth += 8


def _deeper(hot: DataFrame, depth: int, max_bits: int) -> DataFrame:
    """Deal the rows of hot nodes to the pairs of their children 8 bits deeper.

    A child pairs with every child within the remaining budget, at most 93 of
    256; a pair of equal children of a self-joined node is joined with itself.
    """
    digit = F.pmod(F.shiftrightunsigned("rot", 64 - depth - 8), F.lit(256)).cast("int")
    flips = [x for x in range(256) if x.bit_count() <= max_bits]
    dealt = hot.withColumn("digit", digit).select("*", F.explode(F.array(*map(F.lit, flips))).alias("flip"))
    cost = F.col("spent") + F.bit_count(F.col("flip").cast("int"))
    other = F.col("digit").bitwiseXOR(F.col("flip"))
    # Self-joined node: the pair {digit, other} once, the smaller digit as side 0.
    a = F.when(F.col("cross"), F.when(F.col("side") == 0, F.col("digit")).otherwise(other)).otherwise(F.least("digit", other))
    b = F.when(F.col("cross"), F.when(F.col("side") == 0, other).otherwise(F.col("digit"))).otherwise(F.greatest("digit", other))
    side = F.when(F.col("cross"), F.col("side")).otherwise((F.col("digit") > other).cast("int"))
    return dealt.where(cost <= max_bits).select(
        F.xxhash64("node", "cross", a, b).alias("node"), side.cast("int").alias("side"), cost.cast("int").alias("spent"), "rot", "fp")


def near_duplicates(df: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, node_limit: int = NODE_LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, text_key, fingerprint, component_id, kept.

    component_id is the smallest doc_id reachable over links of at most
    ``max_bits`` differing bits (null if all reachable ids are null).  kept
    marks the component's first (doc_id, text_key), nulls last; rows equal in
    both carry the same mark.  Null and empty texts have fingerprint zero and
    link like any other.  Extra columns are left behind.
    """
    fps = common.cut(fingerprints(df, shingle, id_col, text_col))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("first")
    classes = fps.groupBy("fp").agg(first)
    edges = common.cut(links(classes.select("fp"), max_bits, node_limit))
    roots = components(edges)
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = common.cut(named)
    # Cut, so that the join below has an exchange on both sides and Spark can split a hot root.
    heads = common.cut(named.groupBy("root").agg(F.min("first").alias("head")))
    names = named.join(heads, "root").select("fp", "head")
    return fps.join(names, "fp").select(
        "doc_id", "text_key", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("head.doc_id").alias("component_id"),
        (common.same(F.col("doc_id"), F.col("head.doc_id")) & (F.col("text_key") == F.col("head.text_key"))).alias("kept"))


def keep_first(df: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each near-duplicate group, with the columns of ``df``."""
    names = df.columns
    kept = near_duplicates(df, shingle, max_bits, id_col=id_col, text_col=text_col).where("kept").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    keyed = df.withColumn("__id", F.col(id_col).cast("long")).withColumn("__key", F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    k = kept.select(F.col("__id").alias("__id2"), F.col("__key").alias("__key2"))
    one = keyed.join(k, common.same(F.col("__id"), F.col("__id2")) & (F.col("__key") == F.col("__key2")), "left_semi").dropDuplicates(["__id", "__key"])
    return one.select(*names)
