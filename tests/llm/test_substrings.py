import hashlib
import random

import pytest
from helpers import AWKWARD, documents, empty, overlapping_texts

from candlewick.llm import substrings


def brute(ids, texts):
    first = {}
    for d, t in zip(ids, texts):
        b = (t or "").encode()
        for i in range(len(b) - 49):
            if d is not None:
                first[b[i : i + 50]] = min(first.get(b[i : i + 50], d), d)
    out = []
    for d, t in zip(ids, texts):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if d is not None and first[b[i : i + 50]] < d:
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((-1 if d is None else d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("limits", [substrings.Limits(), substrings.Limits(piece=200, flush=64, crowd=0), substrings.Limits(piece=64, flush=300, crowd=1)])
def test_matches_brute_force(spark, limits):
    rng = random.Random(5)
    texts = overlapping_texts() + AWKWARD
    ids = [rng.choice([None, rng.randint(0, 150), i]) for i in range(len(texts))]
    got = substrings.report(documents(spark, texts, ids), limits=limits).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute(ids, texts)


def test_long_text_and_popular_passage(spark):
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(400))
    long = "".join(rng.choice("abcdefgh ") for _ in range(150_000))
    texts = [long, "x" + long[70_000:] + passage] + [f"{k} {passage} {k * 7919}" for k in range(200)]
    limits = substrings.Limits(piece=4096)
    got = substrings.report(documents(spark, texts), limits=limits).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute(range(len(texts)), texts)


def test_remove_keeps_rows_columns_and_whole_characters(spark):
    shared = "é" * 40
    df = documents(spark, [shared, "a" + shared + "z", None, ""])
    out = substrings.remove(df).orderBy("doc_id").collect()
    assert [r.text for r in out] == [shared, "az", None, ""] and out[0].__fields__ == df.columns
    assert substrings.remove(empty(spark)).count() == substrings.report(empty(spark)).count() == 0
