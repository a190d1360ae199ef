"""Nearest neighbours by largest inner product: collision counting with virtual rehashing.

Largest inner product becomes smallest distance: vectors are scaled by the
largest norm and get one more component that makes all of them unit vectors;
a query's extra component is zero.  Projected on a Gaussian direction, two
vectors at distance s differ by N(0, s^2).

The index are blocks of vectors; each holds ``PROJECTIONS`` one-dimensional
projections as sorted arrays.  A query opens a window around its own
projection in every array and counts in how many windows it meets a vector.
Windows of radius R expand by ``GROWTH`` (virtual rehashing: wider windows
include the narrower ones, only the new ends are counted).  A vector at
distance R or less meets the query in a binomial number of arrays; those that
reach the count which such a vector reaches with probability ``RECALL`` are
verified by their inner product in double precision.  The search of a block
ends once the wanted number are verified within R, or R has reached a bound.

1. Equal vectors become one class; of its ids only the ``k + 1`` smallest can
   be among a query's k nearest, ties going to smaller ids.
2. Spark range-sorts the classes by their first projection and cuts blocks.
3. Every query is searched in its own block, which bounds how far its k-th
   nearest can be.
4. Queries, in chunks, visit the blocks that a window of that bound can reach;
   a task holds one block's index and lets the chunks pass.
5. The best of all blocks are merged per query.

The query set is every ``QUERY_EVERY``-th id; chunks of it, not pairs, are
shipped to blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm import common

K = 20
QUERY_EVERY = 20
PROJECTIONS = 64
RECALL = 0.98
GROWTH = 2.0
#: First radius, of unit vectors.
NEAR = 0.0625
#: Window half-width in units of the radius.
WINDOW = 1.0
#: Blocks are left out beyond so many standard deviations of the bound.
REACH = 3.3
BLOCK = 16384
CHUNK = 128
SEED = 11


def needed(trials: int = PROJECTIONS, recall: float = RECALL, window: float = WINDOW) -> int:
    """Largest count that a vector at the radius reaches with probability ``recall``."""
    p = math.erf(window / math.sqrt(2))
    below = 0.0
    for k in range(trials + 1):
        below += math.comb(trials, k) * p**k * (1 - p) ** (trials - k)
        if below > 1 - recall:
            return k
    return trials


def directions(dim: int, seed: int = SEED) -> np.ndarray:
    """Gaussian directions for vectors of ``dim`` components and the one that is added."""
    return np.random.default_rng([seed, dim]).standard_normal((dim + 1, PROJECTIONS))


def _scale(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors divided by their largest component, and their norms as logarithms: neither overflows."""
    top = np.abs(v).max(axis=1, keepdims=True)
    w = v / top
    norm = np.sqrt((w * w).sum(axis=1, keepdims=True))
    return w / norm, (np.log(top) + np.log(norm))[:, 0]


def on_sphere(v: np.ndarray, log_largest: float) -> np.ndarray:
    """Unit vectors with one more component, nearest to a query where the inner product is largest."""
    unit, log_norm = _scale(v)
    share = np.exp(np.minimum(log_norm - log_largest, 0.0))[:, None]
    return np.hstack((unit * share, np.sqrt(np.maximum(0.0, 1 - share * share))))


def as_query(v: np.ndarray) -> np.ndarray:
    return np.hstack((_scale(v)[0], np.zeros((len(v), 1))))


def inner(a: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of rows with a vector, components added in order."""
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * q[d]
    return out


class Index:
    """Sorted projection arrays of one block, one behind another."""

    def __init__(self, vectors: np.ndarray, log_largest: float, recall: float = RECALL) -> None:
        self.vectors, self.sphere = vectors, on_sphere(vectors, log_largest)
        self.rough = self.sphere.astype(np.float32)
        projected = np.ascontiguousarray((self.sphere @ directions(vectors.shape[1])).T)
        self.order = np.argsort(projected, axis=1).astype(np.int32)
        self.sorted = np.take_along_axis(projected, self.order, axis=1)
        self.span = 4.0 + 2 * np.abs(self.sorted).max()
        self.shift = np.arange(PROJECTIONS) * self.span  # arrays do not overlap: one search serves all
        self.flat = (self.sorted + self.shift[:, None]).ravel()
        self.first = np.arange(PROJECTIONS) * len(vectors)
        self.order = self.order.ravel()
        self.needed = needed(recall=recall)

    def _ends(self, at: np.ndarray, side: str) -> np.ndarray:
        half = self.span / 2 - 1
        return np.searchsorted(self.flat, np.clip(at, -half, half) + self.shift, side=side)

    def search(self, point: np.ndarray, at: np.ndarray, want: int, bound: float) -> tuple[np.ndarray, np.ndarray]:
        """Verified rows and their squared distances to ``point``, projected at ``at``, in single precision.

        None beyond ``bound`` need be found.  Without a bound windows expand
        until ``want`` are found or every row is verified.
        """
        rough = point.astype(np.float32)
        count = np.zeros(len(self.sphere), np.int64)
        left = np.ones(len(self.sphere), bool)
        rows, dist, verified = [], [], 0
        within = np.zeros(0, np.float32)
        radius = NEAR if bound == math.inf else max(bound / GROWTH**2, min(NEAR, bound))
        lo = hi = None
        while True:
            new_lo, new_hi = self._ends(at - radius * WINDOW, "left"), self._ends(at + radius * WINDOW, "right")
            if lo is None:
                cuts = zip(new_lo.tolist(), new_hi.tolist())
            else:  # only what the wider windows add
                cuts = zip([*new_lo.tolist(), *hi.tolist()], [*lo.tolist(), *new_hi.tolist()])
            count += np.bincount(np.concatenate([self.order[a:b] for a, b in cuts]), minlength=len(count))
            lo, hi = new_lo, new_hi
            met = np.flatnonzero((count >= self.needed) & left)
            if len(met):
                left[met] = False
                d = np.maximum(0, 2 - 2 * (self.rough[met] @ rough))
                rows.append(met)
                dist.append(d)
                verified += len(met)
                within = np.concatenate((within, d))
                if len(within) > want:
                    within = np.partition(within, want - 1)[:want]
            if radius >= bound or verified == len(left) or (len(within) >= want and within.max() <= radius * radius):
                break
            radius = min(radius * GROWTH, bound)
        return (np.concatenate(rows), np.concatenate(dist)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.float32))


def _usable(vec):
    return vec.isNotNull() & (F.size(vec) > 0) & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vec, lambda x: x != 0)


def _placed_task(log_largest: dict[int, float]):
    """Add the first projection of the vector on the sphere."""

    def run(batches):
        for b in batches:
            vecs = b.column(b.schema.get_field_index("v")).to_pylist()
            p, of = np.zeros(len(vecs)), np.array([len(v) for v in vecs])
            for dim in set(of.tolist()):
                at = np.flatnonzero(of == dim)
                p[at] = on_sphere(np.array([vecs[k] for k in at]), log_largest[dim]) @ directions(dim)[:, 0]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p)], names=[*b.schema.names, "p"])

    return run


_BLOCK = "block long, dim int, lo double, hi double, class binary, sizes binary, ids binary, query binary, vectors binary"


def _blocks_task(batches):
    """Rows sorted by (block, p) to block rows: block, dim, p, class, ids, query, v."""

    def packed(held):
        block, dim, p, cls, ids, query, vecs = zip(*held)
        pack = lambda x, t: pa.array([np.array(x, t).tobytes()], pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array([block[0]]), pa.array([dim[0]], pa.int32()), pa.array([p[0]]), pa.array([p[-1]]), pack(cls, np.int64), pack([len(x) for x in ids], np.int64), pack([i for x in ids for i in x], np.int64), pack(query, bool), pack(vecs, np.float64)],
            names=[c.split()[0] for c in _BLOCK.split(", ")])

    held: list[tuple] = []
    for cols in common.rows(batches):
        for row in zip(*cols):
            if held and row[0] != held[0][0]:
                yield packed(held)
                held = []
            held.append(row)
    if held:
        yield packed(held)


class _Block:
    def __init__(self, dim: int, cls: bytes, sizes: bytes, ids: bytes, query: bytes, vectors: bytes, log_largest: float, recall: float) -> None:
        self.cls, self.query = np.frombuffer(cls, np.int64), np.frombuffer(query, bool)
        sizes = np.frombuffer(sizes, np.int64)
        self.ids, self.begin = np.frombuffer(ids, np.int64), np.cumsum(sizes) - sizes
        self.sizes = sizes
        self.index = Index(np.frombuffer(vectors).reshape(-1, dim), log_largest, recall)

    def best(self, q: np.ndarray, point: np.ndarray, at: np.ndarray, want: int, bound: float) -> tuple[np.ndarray, np.ndarray, float]:
        """Ids and scores of the best ``want``, and the distance of the last of them (infinite if there are fewer)."""
        rows, rough = self.index.search(point, at, want, bound)
        if len(rows) > want:  # single precision rounds; scores decide among all that may be among the best
            near = rough <= np.partition(rough, want - 1)[want - 1] + 1e-5
            rows = rows[near]
        dist = np.sqrt(np.maximum(0.0, 2 - 2 * (self.index.sphere[rows] @ point)))
        with np.errstate(over="ignore", invalid="ignore"):
            score = inner(self.index.vectors[rows], q)
        size = self.sizes[rows]
        ids = self.ids[np.repeat(self.begin[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        score, dist = np.repeat(score, size), np.repeat(dist, size)
        top = np.lexsort((ids, -score))[:want]
        last = float(dist[top].max()) + 1e-7 if len(top) == want else math.inf
        top = top[dist[top] <= bound]
        return ids[top], score[top], last


_FOUND = "class long, vec_id long, score double"


def _home_task(log_largest: dict[int, float], want: int, recall: float, chunk: int):
    """Block rows to the answers of their own queries (class, vec_id, score) and to query chunks with bounds."""

    def run(batches):
        for cols in common.rows(batches):
            for block, dim, _, _, cls, sizes, ids, query, vecs in zip(*cols):
                b = _Block(dim, cls, sizes, ids, query, vecs, log_largest[dim], recall)
                asked = np.flatnonzero(b.query)
                if not len(asked):
                    continue
                q = b.index.vectors[asked]
                points = as_query(q)
                at = points @ directions(dim)
                found = [b.best(v, p, a, want, math.inf) for v, p, a in zip(q, points, at)]
                bound = np.array([f[2] for f in found])
                reach = bound * REACH + 1e-9
                names = ["kind", "class", "vec_id", "score", "home", "chunk", "dim", "lo", "hi", "classes", "bound", "vectors"]
                types = [pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.binary()]
                size = [len(f[0]) for f in found]
                n = sum(size)
                if n:
                    answers = [np.zeros(n, np.int32), np.repeat(b.cls[asked], size), np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])]
                    yield pa.RecordBatch.from_arrays([*(pa.array(x, t) for x, t in zip(answers, types)), *(pa.nulls(n, t) for t in types[4:])], names=names)
                order = np.argsort(at[:, 0] - reach)
                for k, s in enumerate(range(0, len(order), chunk)):
                    o = order[s : s + chunk]
                    row = [1, None, None, None, block, (block << 12) + k, dim, (at[o, 0] - reach[o]).min(), (at[o, 0] + reach[o]).max(), b.cls[asked][o].tobytes(), bound[o].tobytes(), q[o].tobytes()]
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=names)

    return run


_HOME = "kind int, class long, vec_id long, score double, home long, chunk long, dim int, lo double, hi double, classes binary, bound binary, vectors binary"


def _visit_task(log_largest: dict[int, float], want: int, recall: float):
    """Rows sorted by (block, kind): a block, then the query chunks that visit it."""

    def run(batches):
        block = held = None
        for cols in common.rows(batches):
            for number, kind, dim, lo, hi, cls, sizes, ids, query, bound, vecs in zip(*cols):
                if kind == 0:
                    block, held = _Block(dim, cls, sizes, ids, query, vecs, log_largest[dim], recall), (number, lo, hi)
                    continue
                if held is None or held[0] != number:
                    raise RuntimeError(f"queries visit block {number}, which is missing")
                q = np.frombuffer(vecs).reshape(-1, dim)
                points, classes, bounds = as_query(q), np.frombuffer(cls, np.int64), np.frombuffer(bound)
                at = points @ directions(dim)
                reach = bounds * REACH + 1e-9
                go = np.flatnonzero((at[:, 0] - reach <= held[2]) & (at[:, 0] + reach >= held[1]))
                found = [(classes[k], *block.best(q[k], points[k], at[k], want, float(bounds[k]))[:2]) for k in go]
                if found:
                    size = [len(f[1]) for f in found]
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array([f[0] for f in found], np.int64), size)), pa.array(np.concatenate([f[1] for f in found])), pa.array(np.concatenate([f[2] for f in found]))], names=["class", "vec_id", "score"])

    return run


def search(df: DataFrame, k: int = K, every: int = QUERY_EVERY, block: int = BLOCK, chunk: int = CHUNK, recall: float = RECALL, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of every row whose id is divisible by ``every``.

    Candidates are all rows with another id and as many components; fewer than
    k give all.  Ties go to the smaller vec_id.  A vector that is null, empty,
    zero or holds a null or non-finite component, or whose id is null, takes
    no part.  A repeated row counts once; rows that share an id but not the
    vector are candidates and queries of that id, with their best score.  No
    usable rows give no rows; extra columns are left behind.
    """
    spark = df.sparkSession
    n = common.partitions(spark)
    vec = F.transform(F.col(vec_col).cast("array<double>"), lambda x: x + F.lit(0.0))  # no negative zero
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("v")).where(F.col("vec_id").isNotNull() & F.coalesce(_usable(F.col("v")), F.lit(False)))
    keyed = rows.select("vec_id", "v", F.size("v").alias("dim"), F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(7), "v").alias("h2"), (F.col("vec_id") % every == 0).alias("query"))
    # Of equal vectors the k + 1 smallest ids matter, and whether one of them asks.
    same = ["h1", "h2", "dim"]
    distinct = keyed.groupBy(*same).agg(F.first("v").alias("v"), F.max("query").alias("query"))
    few = keyed.select(*same, "vec_id").distinct().withColumn("r", F.row_number().over(Window.partitionBy(*same).orderBy("vec_id"))).where(F.col("r") <= k + 1)
    few = few.groupBy(*same).agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    classes = common.cut(distinct.join(few, same).select(*same, F.monotonically_increasing_id().alias("class"), "query", "ids", "v"))
    top = F.array_max(F.transform("v", lambda x: F.abs(x)))
    norm = F.log(top) + 0.5 * F.log(F.aggregate(F.transform("v", lambda x: F.pow(x / top, F.lit(2.0))), F.lit(0.0), lambda a, x: a + x))
    log_largest = {r["dim"]: r["m"] for r in classes.groupBy("dim").agg(F.max(norm).alias("m")).collect()}  # one number for each length of vectors
    placed = classes.select("class", "dim", "query", "ids", "v").mapInArrow(_placed_task(log_largest), "class long, dim int, query boolean, ids array<long>, v array<double>, p double")
    order = ["dim", "p", "class"]
    ranged = placed.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    ranged = common.stored(ranged.withColumn("part", F.shiftright("place", 33)), "sphere")
    # Ranks along the sorted projection cut blocks of one size, however many partitions there are.
    parts = ranged.groupBy("dim", "part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("from"))
    before = parts.withColumn("before", F.sum("n").over(Window.partitionBy("dim").orderBy("part")) - F.col("n")).drop("n")
    rank = F.col("place") - F.col("from") + F.col("before")
    size = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(64 * block) / F.col("dim")))
    numbered = ranged.join(before, ["dim", "part"]).withColumn("block", F.floor(rank / size) * (1 << 20) + F.col("dim"))
    numbered = numbered.repartition(n, "block").sortWithinPartitions("block", "p", "class").select("block", "dim", "p", "class", "ids", "query", "v")
    blocks = common.stored(numbered.mapInArrow(_blocks_task, _BLOCK), "blocks")
    common.arrow_batches(spark, 4)  # a row is a block
    home = common.stored(blocks.repartition(n, "block").mapInArrow(_home_task(log_largest, k + 1, recall, chunk), _HOME), "home")
    # With fewer blocks than tasks each goes to several, which share its visitors; a copy serves two chunks at least.
    copies = max(1, min(2 * n // max(1, blocks.count()), home.where("kind = 1").count() // 2))
    # Which chunks visit which blocks: small rows, blocks dealt by a salt, chunks to every salt.
    salts = max(1, n)
    ends = blocks.select("block", "dim", F.col("lo").alias("from"), F.col("hi").alias("to"), F.pmod(F.xxhash64("block"), F.lit(salts)).alias("salt"))
    chunks = home.where("kind = 1").select("home", "chunk", "dim", "lo", "hi", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"))
    visits = chunks.join(ends, ["dim", "salt"]).where((F.col("home") != F.col("block")) & (F.col("lo") <= F.col("to")) & (F.col("hi") >= F.col("from"))).select("block", "chunk")
    asked = home.where("kind = 1").select("chunk", "dim", "classes", "bound", "vectors")
    none = F.lit(None).cast("binary")
    missing = F.lit(None).cast("double")
    calls = visits.join(asked, "chunk").select("block", F.pmod(F.xxhash64("chunk"), F.lit(copies)).alias("copy"), F.lit(1).alias("kind"), "dim", missing.alias("lo"), missing.alias("hi"), F.col("classes").alias("class"), none.alias("sizes"), none.alias("ids"), none.alias("query"), "bound", "vectors")
    held = blocks.select("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))).alias("copy"), F.lit(0).alias("kind"), "dim", "lo", "hi", "class", "sizes", "ids", "query", none.alias("bound"), "vectors")
    sorted_calls = held.unionAll(calls).repartition(n, "block", "copy").sortWithinPartitions("block", "copy", "kind").drop("copy")
    away = common.stored(sorted_calls.mapInArrow(_visit_task(log_largest, k + 1, recall), _FOUND), "visits")
    common.arrow_batches(spark)
    found = home.where("kind = 0").select("class", "vec_id", "score").unionAll(away)
    best = Window.partitionBy("class").orderBy(F.col("score").desc(), "vec_id")
    found = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r")
    queries = keyed.where("query").select(F.col("vec_id").alias("query_id"), *same).distinct().join(classes.select(*same, "class"), same).select("query_id", "class")
    pairs = queries.join(found, "class").where("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
