import math

import numpy as np
import pytest

from candlewick.llm import neighbours

SCHEMA = "vec_id long, embedding array<double>, label int, rank string, score int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "clash", 2) for i, v in rows], SCHEMA)


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def score(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += x * y
    return total


def brute(rows, k=20, every=20):
    rows = {(i, tuple(x + 0.0 for x in v)) for i, v in rows if i is not None and usable(v)}
    out = {}
    for q, a in rows:
        if q % every == 0:
            best = out.setdefault(q, {})
            for i, b in rows:
                if i != q and len(a) == len(b):
                    best[i] = max(best.get(i, -math.inf), score(a, b))
    return {q: sorted(((-s, i) for i, s in best.items()))[:k] for q, best in out.items() if best}


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, {})[r["rank"]] = (-r.score, r.vec_id)
    for q, ranks in out.items():
        assert sorted(ranks) == list(range(1, len(ranks) + 1))
        out[q] = [ranks[k] for k in sorted(ranks)]
        assert out[q] == sorted(out[q])
    return out


def recall(got, want):
    hit = total = 0
    for q, w in want.items():
        assert len(got[q]) == len(w), q
        hit += sum(x in set(got[q]) for x in w)
        total += len(w)
    return hit / total


def clustered(n=1500, dim=32, norms=False, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, dim))
    v = np.where(rng.random((n, 1)) < 0.6, centres[rng.integers(0, 6, n)] + rng.standard_normal((n, dim)) * 0.2, rng.standard_normal((n, dim)))
    if norms:
        v *= np.exp(rng.standard_normal((n, 1)))
    return [(int(i), x.tolist()) for i, x in enumerate(v)]


@pytest.mark.parametrize("norms", [False, True])
def test_recall_against_brute_force(spark, norms):
    rows = clustered(norms=norms)
    got, want = found(neighbours.search(frame(spark, rows), block=200, chunk=16)), brute(rows)
    assert set(got) == set(want)
    assert recall(got, want) >= 0.95


def test_whole_query_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in df.collect()]
    got, want = found(neighbours.search(df)), brute(rows)
    assert set(got) == set(want) and recall(got, want) >= 0.95


def test_copies_ties_and_odd_rows(spark):
    base = clustered(60, 8)
    rows = base + [(1000 + i, base[0][1]) for i in range(300)] + [(40, base[7][1]), (40, base[40][1]), (3, base[3][1])]
    rows += [(2000, None), (2020, []), (2040, [0.0] * 8), (2060, [1.0, None]), (2080, [math.nan] * 8), (2100, [math.inf] + [1.0] * 7), (None, base[1][1])]
    rows += [(3000, [1.0, 2.0]), (3001, [-1.0, 0.5]), (3002, [1e-200, 1e-200]), (3020, [-0.0, 3.0]), (3021, [0.0, 3.0]), (5000, [7.0])]
    got, want = found(neighbours.search(frame(spark, rows), block=16, chunk=3, recall=1 - 1e-9)), brute(rows)
    assert got == want
    assert len(got[3000]) == 4 and 5000 not in got


def test_fewer_candidates_than_asked_and_empty(spark):
    rows = clustered(15, 4)
    assert found(neighbours.search(frame(spark, rows))) == brute(rows)
    assert neighbours.search(frame(spark, [])).count() == 0
    assert neighbours.search(frame(spark, [(0, None), (1, [1.0])])).count() == 0
    assert neighbours.search(frame(spark, [(0, [1.0])])).count() == 0


def test_most_rows_of_another_cluster_are_not_verified():
    rng = np.random.default_rng(1)
    v = rng.standard_normal((4000, 64))
    v[:100] = v[0] + 0.1 * rng.standard_normal((100, 64))
    index = neighbours.Index(v, float(np.log(np.linalg.norm(v, axis=1)).max()))
    p = neighbours.as_query(v[:1])[0]
    rows, _ = index.search(p, p @ neighbours.directions(64), 21, math.inf)
    assert 90 <= len(rows) <= 2500
