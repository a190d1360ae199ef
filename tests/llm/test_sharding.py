import zlib
from collections import Counter, defaultdict

import pytest
from helpers import AWKWARD, documents, empty

from candlewick.llm import queries, sharding
from candlewick.plans.oracle_check import compare, duckdb_connection


def test_query_matches_sql(spark):
    got = queries.QUERIES["op7_rendezvous_sharding"](spark, "/root/testdata/sf0.01").drop("text_crc32")
    result = compare(got, duckdb_connection("/root/testdata/sf0.01"), queries.OP7_SQL)
    assert result["match"], result


def test_new_shard_takes_rows_only_into_itself(spark):
    df = documents(spark, ["t"] * 3000)
    rows = sharding.assign(df, [1.0] * 10, [1.0] * 11).collect()
    moved = [r for r in rows if r.shard != r.grown_shard]
    assert moved and all(r.grown_shard == 10 for r in moved)
    assert 0.5 * 3000 / 11 < len(moved) < 1.6 * 3000 / 11


def test_weights_set_the_shares(spark):
    share = Counter(r.shard for r in sharding.assign(documents(spark, ["t"] * 4000), [1.0, 3.0]).collect())
    assert 0.7 < share[1] / 4000 < 0.8


def test_awkward_rows(spark):
    texts = AWKWARD * 2
    ids = [None, 1, 1, 1] * (len(texts) // 4)
    rows = sharding.assign(documents(spark, texts, ids), [1.0] * 3).collect()
    assert Counter((r.size, r.text_crc32) for r in rows) == Counter((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for t in texts)
    by_id = defaultdict(set)
    slots = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in by_id.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assign(empty(spark), [1.0] * 3).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_of(1, [])


@pytest.mark.parametrize("part, block", [(7, 5), (1, 1), (10**6, 10**5)])
def test_hot_keys_and_copies_are_numbered_in_parts(spark, monkeypatch, part, block):
    """One key with a third of all rows, all different, and one row that is another third."""
    monkeypatch.setattr(sharding, "PART_ROWS", part)
    monkeypatch.setattr(sharding, "BLOCK_ROWS", block)
    n = 120
    ids = [5] * n + [None] * n + list(range(100, 100 + n))
    texts = [f"text {i}" for i in range(n)] + ["same"] * n + ["other"] * n
    rows = sharding.assign(documents(spark, texts, ids), [1.0] * 4, [1.0] * 5).collect()
    want = Counter((i, len(t) + 16, zlib.crc32(t.encode())) for i, t in zip(ids, texts))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.shard for r in rows if r.doc_id == 5}) == 1
