import math

import numpy as np
from helpers import find, unite

from candlewick.llm import vectors


def rows_with_clusters():
    rng = np.random.default_rng(1)
    rows = []
    for label in (0, 1, None):
        centres = rng.standard_normal((4, 64))
        for c in centres:
            for _ in range(25):
                rows.append((label, (c + rng.standard_normal(64) * rng.choice([0.05, 0.2, 0.27, 0.35])).astype(float).tolist()))
    rows += [(0, rows[0][1])] * 6 + [(0, [x * 1e-30 for x in rows[0][1]]), (0, [x * 1e30 for x in rows[1][1]])]
    rows += [(0, None), (0, []), (0, [0.0] * 64), (0, [1.0, None]), (0, [math.nan] * 64), (0, [math.inf] + [0.0] * 63), (1, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [0.0, 1.0])]
    return [(i, v, label, "x", 7) for i, (label, v) in enumerate(rows)]


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def test_matches_brute_force(spark):
    rows = rows_with_clusters()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, n_links string, kept int")
    got = {r.vec_id: r for r in vectors.near_duplicates(df, block=16).collect()}
    parent, links = {r[0]: r[0] for r in rows}, {r[0]: 0 for r in rows}
    for i, a, la, *_ in rows:
        for j, b, lb, *_ in rows[i + 1 :]:
            if la is not None and la == lb and usable(a) and usable(b) and len(a) == len(b):
                x, y = np.array(a), np.array(b)
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.93:
                    links[i] += 1
                    links[j] += 1
                    unite(parent, i, j)
    assert len(got) == len(rows) and sum(links.values()) > 100
    for i in links:
        assert got[i].n_links == links[i], i
        assert got[i].component_id == find(parent, i)
        assert got[i].kept == (find(parent, i) == i)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((600, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.standard_normal((600, 64))
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.9301 * a + math.sqrt(1 - 0.9301**2) * side
    i, j = vectors.linked_pairs(a, b, False, 0.93)
    assert sum(x == y for x, y in zip(i, j)) >= 599


def test_null_ids_and_empty(spark):
    df = spark.createDataFrame([(None, [1.0, 2.0], 1), (4, [1.0, 2.0], 1), (4, [1.0, 2.0], 1)], "vec_id long, embedding array<double>, label int")
    got = sorted((r.vec_id or -1, r.n_links, r.component_id or -1, r.kept) for r in vectors.near_duplicates(df).collect())
    assert got == [(-1, 0, -1, True), (4, 1, 4, True), (4, 1, 4, True)]
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_rows_of_one_id_keep_their_labels_apart(spark):
    a, b = [1.0, 0.0], [0.99, 0.1]
    rows = [(1, a, 1), (1, a, 2), (2, b, 1), (3, b, 2), (1, [0.0, 1.0], 3)]
    got = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 0, 1), (1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)]
    two = [(5, a, 1), (5, a, 2), (2, b, 1), (3, b, 2)]
    got = vectors.near_duplicates(spark.createDataFrame(two, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(2, 1, 2), (3, 1, 3), (5, 1, 2), (5, 1, 3)]
