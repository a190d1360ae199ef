import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import AWKWARD, documents, empty

from candlewick.llm import alignment

ODD = [
    "plain words and more words", "  two  spaces\tand\ttabs  ", "a▁b", "x" * 3000, "naïve café “quoted” — dash…", "日本語のテキスト と 漢字", "ﬁ ligature ½ ²", "emoji 😀👍🏽 done", "<|endoftext|> <s> </s> <unk> <0x41>",
    "tabs\t\tand\nlines\n\n\nend", "don't we'll I'm", "1234567890 12.5e-7", "​  odd 　 space", "é combining", "\x00 nul", "plain words and more words",
]


def brute(texts):
    a_lib, b_lib = alignment.tokens(alignment.byte_bpe_path(), alignment.piece_model_path())
    parts, count = [], Counter()
    for t in texts:
        if not t:
            parts.append(None)
            continue
        whole = (" " + t).encode()
        a, b = a_lib._by_library(" " + t), b_lib.lib.encode(t)
        ba, bb = [a_lib.bytes[i] for i in a], [b_lib.bytes[i] for i in b]
        if b"".join(ba) != whole or b"".join(bb) != whole:
            parts.append(None)
            continue
        spans = []
        for pieces in (ba, bb):
            at, out = 0, []
            for p in pieces:
                out.append((at, at + len(p)))
                at += len(p)
            spans.append(out)
        links, j0 = [], 0
        for i, (s, e) in enumerate(spans[0]):
            while spans[1][j0][1] <= s:
                j0 += 1
            j = j0
            while j < len(b) and spans[1][j][0] < e:
                links.append((a[i], b[j]))
                j += 1
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, start = [], 0
        ends_a, ends_b = [e for _, e in spans[0]], [e for _, e in spans[1]]
        pa = pb = 0
        for c in cuts:
            qa, qb = ends_a.index(c, pa) + 1, ends_b.index(c, pb) + 1
            groups.append(",".join(map(str, a[pa:qa])) + "|" + ",".join(map(str, b[pb:qb])))
            pa, pb = qa, qb
        count.update(links)
        parts.append((len(a), len(b), groups, links))
    top = {}
    for (_, y), n in count.items():
        top[y] = max(top.get(y, 0), n)
    out = []
    for p in parts:
        if p is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((p[0], p[1], len(p[2]), len(p[3]), sum(count[x] == top[x[1]] for x in p[3]), sum(count[x] for x in p[3]), hashlib.sha256(";".join(p[2]).encode()).hexdigest()))
    return out


def mixed():
    rng = random.Random(4)
    words = "the of and straße über naïve tokenization antidisestablishment x1 42 foo_bar https://a.b/c?d=e ... !!".split()
    return AWKWARD + ODD + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(40)] + ["long " * 30_000, "z" * 60_000]


@pytest.mark.parametrize(("block_chars", "memo"), [(alignment.BLOCK_CHARS, alignment.MEMO), (300, 20)])
def test_matches_brute_force(spark, block_chars, memo):
    texts = mixed()
    df = documents(spark, texts).repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in alignment.align(df, block_chars=block_chars, memo=memo).collect()}
    want = brute(texts)
    assert len(got) == len(texts) and sum(w[0] > 0 for w in want) > 50
    for i, w in enumerate(want):
        assert got[i] == w, texts[i][:60] if texts[i] else texts[i]


def test_repeated_null_ids_and_empty(spark):
    df = documents(spark, ["one two", "one two", None, ""], [None, 5, 5, 6])
    rows = sorted(tuple(r) for r in alignment.align(df.where("doc_id is not null")).collect())
    assert [r[0] for r in rows] == [5, 5, 6] and rows[1][1] > 0 and rows[0][1:] == (0, 0, 0, 0, 0, 0, "")
    whole = alignment.align(df).collect()
    assert len(whole) == 4 and {r.count_sum for r in whole if r.n_a} == {2 * r.n_links for r in whole if r.n_a}
    assert alignment.align(empty(spark)).count() == 0


def test_both_byte_level_libraries_agree():
    lib = alignment.ByteTokens(alignment.byte_bpe_path())
    assert lib._ranks is not None
    for t in mixed():
        if t:
            assert lib.encode(" " + t) == lib._by_library(" " + t), t[:50]


def test_pair_counts(spark):
    table = alignment.pair_counts(documents(spark, ["one two", "one"]))
    assert table.agg({"n": "sum"}).first()[0] == 3 and table.where("best").count() == 2


def test_distinct_parts_with_and_without_shared_digests(monkeypatch):
    row, at = np.array([5, 6, 5, 6, 7, 5, 6, 6, 5]), np.array([0, 2, 4, 5, 7, 9])
    for digests in (alignment._ODD, np.zeros(64, np.uint64)):
        monkeypatch.setattr(alignment, "_ODD", digests)
        once, again = alignment._distinct(row, at)
        assert sorted(once.tolist()) == [0, 2, 4] and once[again].tolist() == [0, 0, 2, 0, 4]
