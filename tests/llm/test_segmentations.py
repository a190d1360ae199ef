import math
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from helpers import AWKWARD, documents, empty

from candlewick.llm import segmentations

MODEL = segmentations.piece_model_path()


@pytest.fixture(scope="module")
def lattice():
    return segmentations.Pieces(MODEL)


def brute(p, text):
    """Probability of every segmentation."""
    t = "▁" + text.replace(" ", "▁")
    out = []

    def go(i, ids, w):
        if i == len(t):
            out.append((ids, w))
            return
        alone = False
        for j in range(i + 1, min(len(t), i + 16) + 1):
            if t[i:j] in p.weight:
                alone |= j == i + 1
                go(j, (*ids, p.weight[t[i:j]][0]), w * p.weight[t[i:j]][1])
        if not alone:
            b = t[i].encode()
            go(i + 1, (*ids, *(p.byte[x] for x in b)), w * p.byte_weight ** len(b))

    go(0, (), 1.0)
    total = sum(w for _, w in out)
    return {ids: w / total for ids, w in out}


def test_distribution_without_replacement(lattice):
    text, n = "then, a✓\n  x日𝄞", 6000
    want = brute(lattice, text)
    got = segmentations.sample_top_k(lattice, [text] * n, np.arange(n, dtype=np.uint64), 2)
    first = Counter(tuple(s[0][0].tolist()) for s in got)
    best = max(want, key=want.get)
    second = Counter(tuple(s[1][0].tolist()) for s in got if tuple(s[0][0].tolist()) == best)
    for ids, p in want.items():
        assert abs(first[ids] / n - p) < 4.5 * math.sqrt(p / n) + 1e-3
        if ids != best:
            m, q = first[best], p / (1 - want[best])
            assert abs(second[ids] / m - q) < 4.5 * math.sqrt(q / m) + 1e-3
    for samples in got:
        assert len({tuple(s[0].tolist()) for s in samples}) == 2
        assert samples[0][2] >= samples[1][2]
        assert all(abs(s[1] - math.log(want[tuple(s[0].tolist())])) < 1e-9 for s in samples)
    # Horvitz-Thompson: probabilities over inclusion probabilities add up to 1 on average.
    assert abs(np.mean([sum(math.exp(s[1] - s[3]) for s in samples) for samples in got]) - 1) < 0.05


def test_all_segmentations_of_a_short_text(lattice):
    for text in ("a", "b ", "zz", "the"):
        want = brute(lattice, text)
        (got,) = segmentations.sample_top_k(lattice, [text], np.array([3], dtype=np.uint64), 500)
        assert {tuple(s[0].tolist()) for s in got} == set(want) and all(s[3] == 0 for s in got)


def test_decodes_like_the_library(lattice):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for t in AWKWARD:
        ids = sp.encode(t or "")
        assert lattice.decode(np.array(ids, dtype=np.int64)).decode() == sp.decode(ids)


def test_rows(spark):
    texts = AWKWARD * 2 + ["y" * 3000]
    ids = [i % len(AWKWARD) if i % len(AWKWARD) else None for i in range(len(texts))]
    df = segmentations.segment(documents(spark, texts, ids), MODEL, k=3, with_ids=True)
    got = segmentations.decode(df, MODEL).collect()
    assert all(r.decodes for r in got)
    assert {r.decoded for r in got} == {t or "" for t in texts}
    copies = Counter((r.doc_id, r.sample, r.ids_crc32) for r in got if r.doc_id is not None)
    assert set(copies.values()) <= {1, 2}  # repeated rows draw alike
    again = segmentations.segment(documents(spark, texts, ids).repartition(5), MODEL, k=3).collect()
    assert sorted((r.doc_id or -1, r.sample, r.ids_crc32, r.score) for r in got) == sorted((r.doc_id or -1, r.sample, r.ids_crc32, r.score) for r in again)
    assert segmentations.segment(empty(spark), MODEL).count() == 0
