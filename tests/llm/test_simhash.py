import random

import numpy as np
import pytest
import xxhash
from helpers import AWKWARD, documents, empty, find, unite, words

from candlewick.llm import simhash
from candlewick.llm.components import components


def brute_fingerprint(text):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    ids = sorted(fps)
    parent = {i: i for i in ids}
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                unite(parent, i, j)
    return {i: find(parent, i) for i in ids}


def near_texts():
    rng = random.Random(1)
    vocab = [f"w{k}" for k in range(60)]
    out = list(AWKWARD)
    for _ in range(25):
        base = [rng.choice(vocab) for _ in range(rng.randint(2, 90))]
        for _ in range(rng.randint(1, 4)):
            copy = list(base)
            copy[rng.randrange(len(copy))] = rng.choice(vocab)
            out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("node_limit", [200_000, 2])
def test_matches_brute_force(spark, node_limit):
    texts = near_texts()
    got = simhash.near_duplicates(documents(spark, texts), node_limit=node_limit).collect()
    fps = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    want = brute_components(fps)
    assert len(got) == len(texts)
    for r in got:
        assert int(r.fingerprint, 16) == fps[r.doc_id] and len(r.fingerprint) == 16
        assert r.component_id == want[r.doc_id]
        assert r.kept == (r.component_id == r.doc_id)


def test_trie_pairs_against_all_pairs():
    rng = np.random.default_rng(2)
    centre = rng.integers(0, 2**63, 6, dtype=np.uint64)
    fp = np.unique(np.concatenate([c ^ (np.uint64(1) << rng.integers(0, 48, 40).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 48, 40).astype(np.uint64)) for c in centre]))
    node = (fp >> np.uint64(48)).astype(np.int64)
    zero = np.zeros(len(fp), np.int32)
    got = {tuple(sorted(x)) for p, q in simhash.trie_pairs(fp, node, zero, 16, zero) for x in zip(p.tolist(), q.tolist())}
    want = {(i, j) for i in range(len(fp)) for j in range(i + 1, len(fp)) if node[i] == node[j] and int(fp[i] ^ fp[j]).bit_count() <= 3}
    assert got == want


def test_null_and_repeated_ids(spark):
    df = documents(spark, ["a b c d", "a b c d", "a b c d", None, "z y x w v"], [None, 7, 7, None, 9])
    got = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in simhash.near_duplicates(df).collect())
    assert got == [(-1, -1, True), (-1, 7, False), (7, 7, True), (7, 7, True), (9, 9, True)]
    assert simhash.keep_first(df).count() == 3
    assert simhash.keep_first(df).columns == df.columns


def test_empty_table(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.keep_first(empty(spark)).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(4)
    edges = [(k, k + 1) for k in range(0, 60)] + [(500, 500 + k) for k in range(40)] + [(900, 900)] + [(rng.randint(1000, 1100), rng.randint(1000, 1100)) for _ in range(80)]
    nodes = {x for e in edges for x in e if e[0] != e[1]}
    parent = {x: x for x in nodes}
    for a, b in edges:
        if a != b:
            unite(parent, a, b)
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.root for r in got.collect()} == {x: find(parent, x) for x in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
