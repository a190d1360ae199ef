import hashlib
import random
import zlib

import pytest
from helpers import words

from candlewick.llm import common, conversations

SCHEMA = "conv_id long, turn long, role string, text string, depth string, words int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - c % 20, [])[:h] + v[h:]
    nodes = {}
    for c, v in rebuilt.items():
        for d in range(len(v) + 1):
            nodes.setdefault(tuple(v[:d]), []).append(c)
    children, leaves, saved = {}, {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        kids = children.get(p, [])
        leaves[p] = sum(leaves[k] for k in kids) or 1
        saved[p] = sum(saved[k] for k in kids) + ((len(nodes[p]) - 1) * len(words(p[-1][1])) if p else 0)
        if p:
            children.setdefault(p[:-1], []).append(p)
    out = []
    for p, members in nodes.items():
        ended = ",".join(str(c) for c in sorted(members) if len(rebuilt[c]) == len(p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(children.get(p, [])), leaves[p], saved[p], hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, **kw):
    got = sorted((tuple(r) for r in conversations.trie(frame(spark, rows), **kw).collect()), key=str)
    want = brute(rows)
    assert len(got) == len(want)
    assert got == want
    return got


def some(seed, n=150):
    rng = random.Random(seed)
    texts = ["", None, "hello there friend", "a b", "same opening words", "long " * 400, "x\ny\tz", "é \x1c ö"]
    rows = []
    for c in rng.sample(range(300), n):
        for t in range(rng.choice([0, 1, 1, 2, 3, 3, 4, 6, 9])):
            rows.append((c, t, rng.choice(["user", "assistant"]) if rng.random() < 0.9 else None, rng.choice(texts[: 3 + t])))
    first = [(k, r, t) for k, (r, t) in enumerate([("system", "same opening words"), ("user", "a b"), ("assistant", "c d e"), ("user", "f"), ("assistant", "g h")])]
    for c in range(400, 520):  # a third of all rows are one conversation, or begin like it
        rows += [(c, k, r, t) for k, r, t in first[: rng.choice([1, 3, 5, 5, 5])]]
    rows += [(600, None, "user", "null first"), (600, None, "user", "null first"), (600, -3, None, None), (600, 5, "a", "tie"), (600, 5, "a", "tie two"), (600, 5, "a", "tie"), (None, 1, "user", "nobody's"), (None, None, None, None)]
    rows += [(c, 0, "user", "short") for c in range(700, 760, 7)]  # some become turnless
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "cells"), [(1, conversations.MAX_CELLS), (2, 64), (3, 1024)])
def test_matches_brute_force(spark, monkeypatch, seed, cells):
    monkeypatch.setattr(conversations, "MIN_CELLS", 64)
    monkeypatch.setattr(conversations, "CHUNK", 40)
    got = check(spark, some(seed), max_cells=cells)
    assert any(r[3] > 30 and r[1] > 2 for r in got) and any(r[3] == 1 for r in got)


def test_long_conversations_cross_stretches(spark, monkeypatch):
    monkeypatch.setattr(conversations, "_SEGMENT", 3)
    rows = [(c, t, "user", f"turn {t}" if t < 90 or c < 2 else f"own {c} {t}") for c in (1, 2, 3, 41) for t in range(150)]
    check(spark, rows)


def test_most_prefixes_are_proven_single(spark):
    rows = [(c, t, "user", f"{c} {t}" if t else "hello") for c in range(1000) for t in range(5)]
    prefixes, _ = conversations.rebuild(frame(spark, rows))
    flagged = conversations.Screen(prefixes).maybe_shared(prefixes, {"maybe": ("d1", "d2")})
    counts = prefixes.groupBy("d1", "d2").count()
    wrong = flagged.join(counts, ["d1", "d2"])
    assert wrong.where("not maybe and count > 1").count() == 0
    assert wrong.where("maybe and count = 1").count() < 0.1 * wrong.where("count = 1").count()


def test_empty_and_turnless(spark):
    assert conversations.trie(frame(spark, [])).count() == 0
    assert conversations.trie(frame(spark, [(None, 1, "a", "b")])).count() == 0
    lone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 1)
    check(spark, [(lone, 0, "user", "gone")])
    common.arrow_batches(spark)
