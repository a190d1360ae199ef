"""Embedding near-duplicates by collision counting on one-dimensional projections.

Unit vectors with cosine c differ by N(0, 2 - 2c) on a Gaussian direction, so
on ``PROJECTIONS`` directions a pair at the threshold collides (differs by at
most the window) a binomial number of times.  The count that a pair must reach
is calibrated from that law: the largest one that a pair exactly at the
threshold reaches with probability ``RECALL``; closer pairs reach it more
surely.  Pairs that pass are verified by their cosine in double precision.

1. Equal vectors of a label become one class with a count (combining
   aggregate), so a vector held by any share of the rows is one row.
2. Spark range-sorts the classes by (label, dimension, first projection) and
   cuts the sorted order into blocks of at most ``BLOCK`` classes, a row each.
3. Blocks whose windows around their queries overlap are paired; a task takes
   a pair of blocks at a time and counts collisions, in rounds of projections
   that drop the pairs which fell behind.  A hot label is many blocks; memory
   is two blocks and one count matrix, whatever the label's size.

Tasks return link counts and spanning edges, never pairs.  In the worst case
(one label, vectors without structure) the pairs tested grow with the square
of a label's classes: one-dimensional windows cannot prune more than that.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm import common
from candlewick.llm.components import components, merge_labels

THRESHOLD = 0.93
PROJECTIONS = 64
ROUND = 32
RECALL = 0.99999
#: Window half-width in standard deviations of a pair at the threshold.
WINDOW = 1.0
#: The sorted first projection's window; a pair at the threshold leaves it with probability 1e-5.
SORT_WINDOW = 4.42
BLOCK = 1024
SEED = 20


def needed(trials: int, recall: float = RECALL, window: float = WINDOW) -> int:
    """Largest count that a binomial of ``trials`` window hits reaches with probability ``recall``."""
    p = math.erf(window / math.sqrt(2))
    below, k = 0.0, 0
    while k <= trials:
        below += math.comb(trials, k) * p**k * (1 - p) ** (trials - k)
        if below > 1 - recall:
            return k
        k += 1
    return trials


def directions(dim: int, n: int = PROJECTIONS, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, n))


def _unit(v: np.ndarray) -> np.ndarray:
    scaled = v / np.abs(v).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def linked_pairs(a: np.ndarray, b: np.ndarray, same: bool, threshold: float, recall: float = RECALL) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) of unit rows with cosine >= threshold among those that pass the count."""
    sigma = math.sqrt(max(0.0, 2 - 2 * threshold))
    width = WINDOW * sigma + 1e-9
    d = directions(a.shape[1])
    pa_, pb = (a @ d).astype(np.float32), (b @ d).astype(np.float32)
    hits = np.zeros((len(a), len(b)), dtype=np.uint8)
    for k in range(ROUND):
        hits += np.abs(pa_[:, k, None] - pb[None, :, k]) <= width
    i, j = np.nonzero(hits >= needed(ROUND, recall))
    if same:
        once = i < j
        i, j = i[once], j[once]
    count = hits[i, j].astype(np.int64)
    for at in range(ROUND, PROJECTIONS, ROUND):
        for k in range(at, at + ROUND):
            count += np.abs(pa_[i, k] - pb[j, k]) <= width
        go_on = count >= needed(at + ROUND, recall)
        i, j, count = i[go_on], j[go_on], count[go_on]
    out_i, out_j = [], []
    for s in range(0, len(i), 1 << 16):
        x, y = i[s : s + (1 << 16)], j[s : s + (1 << 16)]
        good = np.einsum("ij,ij->i", a[x], b[y]) >= threshold
        out_i.append(x[good])
        out_j.append(y[good])
    return (np.concatenate(out_i), np.concatenate(out_j)) if out_i else (i, j)


def classes(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, DataFrame]:
    """(rows, classes): every row with its class key, and one row per distinct usable vector of a label."""
    vec = F.col(vec_col).cast("array<double>")
    fine = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vec, lambda x: x != 0)
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.coalesce(fine, F.lit(False)).alias("fine"), F.col(label_col).cast("string").alias("label"), vec.alias("v"))
    keyed = rows.withColumn("h1", F.xxhash64("label", "v")).withColumn("h2", F.xxhash64("v", "label", F.size("v")))
    distinct = keyed.where("fine").groupBy("label", "h1", "h2").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("v").alias("v"))
    return keyed.select("vec_id", "fine", "label", "h1", "h2"), distinct


def _first_projection(batches):
    """Add dim and p, the unit vector's first projection."""
    for b in batches:
        vecs = b.column(b.schema.get_field_index("v")).to_pylist()
        dims, p = [len(v) for v in vecs], np.zeros(len(vecs))
        of = np.array(dims)
        for dim in set(dims):
            at = np.flatnonzero(of == dim)
            p[at] = _unit(np.array([vecs[k] for k in at])) @ directions(dim)[:, 0]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(dims, pa.int32()), pa.array(p)], names=[*b.schema.names, "dim", "p"])


_BLOCK = "block long, label string, dim int, lo double, hi double, reps binary, counts binary, vectors binary"


def _blocks(size: int):
    """Cut rows sorted by (label, dim, p) into block rows."""

    def run(batches):
        held: list[tuple] = []
        serial = 0

        def close():
            part, label, dim = held[0][0], held[0][1], held[0][2]
            cols = list(zip(*held))
            arrays = [
                pa.array([(part << 32) + serial], pa.int64()), pa.array([label]), pa.array([dim], pa.int32()), pa.array([cols[3][0]]), pa.array([cols[3][-1]]),
                pa.array([np.array(cols[4], np.int64).tobytes()], pa.binary()), pa.array([np.array(cols[5], np.int64).tobytes()], pa.binary()), pa.array([np.array(cols[6], np.float64).tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, names=["block", "label", "dim", "lo", "hi", "reps", "counts", "vectors"])

        for cols in common.rows(batches):
            for row in zip(*cols):
                if held and (row[1:3] != held[0][1:3] or len(held) == size):
                    yield close()
                    serial, held = serial + 1, []
                held.append(row)
        if held:
            yield close()

    return run


def _count(threshold: float):
    """Pairs of block rows to (node, mate, links)."""

    def run(batches):
        for same, dim, *cols in common.rows(batches):
            for s, d, ra, ca, va, rb, cb, vb in zip(same, dim, *cols):
                a, b = _unit(np.frombuffer(va).reshape(-1, d)), _unit(np.frombuffer(vb).reshape(-1, d))
                i, j = linked_pairs(a, b, s, threshold)
                if not len(i):
                    continue
                ra, rb, ca, cb = (np.frombuffer(x, np.int64) for x in (ra, rb, ca, cb))
                reps, counts = (ra, ca) if s else (np.concatenate((ra, rb)), np.concatenate((ca, cb)))
                j = j if s else j + len(ra)
                links = np.bincount(i, weights=counts[j], minlength=len(reps)) + np.bincount(j, weights=counts[i], minlength=len(reps))
                labels = np.arange(len(reps))
                merge_labels(labels, i, j)
                hit = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays([pa.array(reps[hit]), pa.array(reps[labels[hit]]), pa.array(links[hit].astype(np.int64))], names=["node", "mate", "links"])

    return run


def near_duplicates(df: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors are compared when labels are equal and not null and dimensions
    agree.  A vector that is null, empty, zero or holds a null or non-finite
    component, or whose id or label is null, links with nothing and is its own
    component (null id: null component, kept).  Repeated rows link with each
    other; rows that share an id but not the vector or
    the label are vectors of their own.  Extra
    columns are left behind.
    """
    spark = df.sparkSession
    rows, distinct = classes(df, id_col, vec_col, label_col)
    distinct = common.cut(distinct.withColumn("class", F.monotonically_increasing_id()))
    ordered = distinct.select("label", "class", "n", "v").mapInArrow(_first_projection, "label string, class long, n long, v array<double>, dim int, p double")
    order = ["label", "dim", "p", "class"]
    ranged = ordered.repartitionByRange(common.partitions(spark), *order).sortWithinPartitions(*order)
    blocks = ranged.select(F.spark_partition_id().cast("long").alias("part"), "label", "dim", "p", "class", "n", "v").mapInArrow(_blocks(block), _BLOCK)
    blocks = common.cut(blocks)
    reach = SORT_WINDOW * math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9
    ends = blocks.select("block", "label", "dim", "lo", "hi")
    other = ends.select(F.col("block").alias("mate"), "label", "dim", F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    pairs = ends.join(other, ["label", "dim"]).where((F.col("block") <= F.col("mate")) & (F.col("lo2") <= F.col("hi") + reach) & (F.col("lo") <= F.col("hi2") + reach)).select("block", "mate")
    left = blocks.select("block", "dim", F.col("reps").alias("ra"), F.col("counts").alias("ca"), F.col("vectors").alias("va"))
    right = blocks.select(F.col("block").alias("mate"), F.col("reps").alias("rb"), F.col("counts").alias("cb"), F.col("vectors").alias("vb"))
    loaded = pairs.join(left, "block").join(right, "mate")
    deal = loaded.select((F.col("block") == F.col("mate")).alias("same"), "dim", "ra", "ca", "va", "rb", "cb", "vb")
    found = common.cut(deal.mapInArrow(_count(threshold), "node long, mate long, links long"))
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("mate").alias("b"))).withColumnRenamed("node", "class")
    # A component is called by the smallest id of its classes.
    least = roots.join(distinct.select("class", "rep"), "class").groupBy("root").agg(F.min("rep").alias("least"))
    roots = roots.join(least, "root").select("class", F.col("least").alias("root"))
    mine = distinct.select("label", "h1", "h2", "class", "rep", "n").join(sums.withColumnRenamed("node", "class"), "class", "left").join(roots, "class", "left")
    named = common.cut(mine.select("label", "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id")))
    fine = rows.where("fine").join(named, ["label", "h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.col("fine")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return fine.unionAll(alone).withColumn("kept", common.same(F.col("vec_id"), F.col("component_id")))
