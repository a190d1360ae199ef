"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm import common


def _stars(e: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u, v) with u > v."""
    if large:
        near = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = e.select("u", "v")
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    if large:
        out = near.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = near.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b: long); root is the component's smallest node.

    Self-loops, repeated and reversed edges do no harm; nulls are ignored; no
    edges give no rows.  Each round is joins and combining aggregates on the
    edge table, cut in the shared checkpoint folder; a hub is an aggregate
    with map-side combine and a sort-merge join that Spark can split.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = common.cut(e)
    mark = None
    while True:
        now = e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if now["n"] == 0 or (now["n"], now["x"]) == mark:
            break
        mark = (now["n"], now["x"])
        e = common.cut(_stars(_stars(e, True), False))
    pairs = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pairs.unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def merge_labels(labels: np.ndarray, p: np.ndarray, q: np.ndarray) -> None:
    """Union-find over local indices: afterwards linked items share their smallest index as label."""
    while len(p):
        a, b = labels[p], labels[q]
        apart = a != b
        if not apart.any():
            return
        p, q, a, b = p[apart], q[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels[:] = up
