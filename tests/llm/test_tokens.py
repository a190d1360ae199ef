import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import AWKWARD, documents, empty
from tokenizers import Tokenizer

from candlewick.llm import common, dac, packing, token_ids

PATH = token_ids.word_bpe_path()


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


def fuzz(n=1500, seed=5):
    rng = random.Random(seed)
    pool = list("abcABC'sdtÀÖßéÿ.,!?;:|1²½٣_-́İKſ\x1c\xa0 ​ \t\n日本ǅΣς") + ["<|endoftext|>", "'re", "'LL", "ﬁ"]
    return ["".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_encoder_is_the_library(lib, monkeypatch):
    monkeypatch.setattr(token_ids, "CACHE", 500)
    enc = token_ids.IdEncoder(PATH)
    assert enc.shortcut
    for t in fuzz() + [t or "" for t in AWKWARD]:
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("high", [1, 200, 256, 70_000, 2**32])
def test_codes_round_trip(high):
    ids = np.random.default_rng(high).integers(0, high, 3000, dtype=np.uint64).astype(np.uint32)
    codes = dac.Codes(dac.pack(ids))
    assert (codes.all() == ids).all() and [codes[i] for i in range(0, 3000, 7)] == ids[::7].tolist()
    assert len(dac.Codes(dac.pack(ids[:0]))) == 0
    with pytest.raises(IndexError):
        codes[3000]


def test_files_round_trip(spark, lib):
    rng = random.Random(2)
    texts = AWKWARD + fuzz(100)
    ids = [rng.choice([None, 5, i]) for i in range(len(texts))]
    path = common.shared_path(spark, "dac-test")
    dac.write(documents(spark, texts, ids), path, PATH, shards=4, block_tokens=300)
    got = sorted(dac.read(spark, path).collect(), key=lambda r: r.start)
    coded = {t: lib.encode(t or "", add_special_tokens=False).ids + [1] for t in texts}
    want = sorted((-1 if i is None else i, len(coded[t]), zlib.crc32(np.array(coded[t], "<u4").tobytes())) for i, t in zip(ids, texts))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    order = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert order == sorted(order) and [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    last = got[-1].start + got[-1].n_tokens
    row = got[len(got) // 2]
    assert dac.token_at(spark, path, row.start + row.n_tokens - 1) == 1
    assert dac.token_at(spark, path, last) is None and dac.token_at(spark, path, -1) is None


def test_empty_files(spark):
    path = common.shared_path(spark, "dac-empty")
    dac.write(empty(spark), path, PATH)
    assert dac.read(spark, path).count() == 0


def test_lower_bound_is_a_bound():
    rng = np.random.default_rng(3)
    for _ in range(300):
        cap = int(rng.integers(8, 60))
        x = rng.integers(1, cap + 1, int(rng.integers(1, 40)))
        bins, offsets = packing.best_fit_decreasing(x, cap)
        used = np.bincount(bins, weights=x)
        assert used.max() <= cap and packing.lower_bound(x, cap) <= len(used)
        for b in range(len(used)):
            at = np.flatnonzero(bins == b)
            at = at[np.argsort(offsets[at])]
            assert (offsets[at] == np.cumsum(np.append(0, x[at]))[:-1]).all()
    assert packing.lower_bound(np.array([6, 6, 6]), 10) == 3
    assert packing.lower_bound(np.array([4, 4, 4, 4, 4]), 10) == 3
    assert packing.lower_bound(np.array([], dtype=np.int64), 10) == 0


@pytest.mark.parametrize("group", [20_000, 40])
def test_packing(spark, lib, group):
    rng = random.Random(4)
    texts = AWKWARD + [" ".join(rng.choice(["alpha", "beta", "gamma,"]) for _ in range(rng.randint(0, 90))) for _ in range(300)]
    cap = 64
    df = documents(spark, texts, [i if i % 5 else None for i in range(len(texts))])
    rows = packing.pack(packing.pieces(df, PATH, cap, with_ids=True), cap, group=group)
    got = rows.collect()
    coded = [lib.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
    want = [(-1 if i % 5 == 0 else i, k, a, c[a : a + cap]) for i, c in enumerate(coded) for k, a in enumerate(range(0, len(c), cap))]
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.ids) for r in got) == sorted(want)
    assert all(r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for s in seqs.values():
        s.sort()
        assert [o for o, _ in s] == np.cumsum([0] + [n for _, n in s])[:-1].tolist() and sum(n for _, n in s) <= cap
    bound = packing.lower_bound(np.array([r.length for r in got]), cap)
    assert bound <= len(seqs) <= bound + (0 if group > len(got) else 12)
    full = packing.sequences(rows).collect()
    assert sorted(len(r.ids) for r in full) == sorted(sum(n for _, n in s) for s in seqs.values())


def test_packing_goes_on_while_rounds_help(spark):
    rng = random.Random(12)
    rows = spark.createDataFrame([(i, 0, rng.randint(12, 50)) for i in range(1500)], "doc_id long, piece int, length long").repartition(2)
    count = lambda **k: packing.pack(rows, 100, group=12, **k).select("sequence_id").distinct().count()
    by_round = [count(rounds=k) for k in (1, 4)]
    assert by_round[0] > by_round[1] > count()


def test_packing_nothing(spark):
    assert packing.pack(packing.pieces(empty(spark), PATH)).count() == 0
