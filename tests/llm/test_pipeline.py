import corpus_pipeline
from helpers import documents
from test_quality import brute as measures
from test_secrets import brute as secret_spans
from test_simhash import brute_components, brute_fingerprint
from test_substrings import brute as removal

from candlewick.llm import common, quality, secrets, substrings


def test_stages_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = common.table(spark, sf, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "SimHash near-dedup", "suffix-array dedup", "secret scans", "best-fit packing"]
    kept = {i: t for i, t in rows.items() if quality.cascade(quality.Doc(t or ""), quality.RULES) is None}
    for i, t in rows.items():
        n, _, _, _, repeat = measures(t)
        if n < 20 or 100 * repeat > 30 * n:
            assert i not in kept
    out = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = common.stored(stage(spark, out, sf), "stage")
        if k < 4:
            assert out.columns == docs.columns
        if k == 0:
            assert {r.doc_id: r.text for r in out.collect()} == kept
        if k == 1:
            comp = brute_components({i: brute_fingerprint(t) for i, t in kept.items()})
            kept = {i: t for i, t in kept.items() if comp[i] == i}
            assert {r.doc_id: r.text for r in out.collect()} == kept
        if k == 2:
            got = {r.doc_id: r.text for r in out.collect()}
            ids = sorted(kept)
            assert set(got) == set(ids)
            for i, n, gone, _, _ in removal(ids, [kept[i] for i in ids]):
                if not gone:
                    assert got[i] == kept[i]
                else:
                    assert 0 <= n - gone - len(got[i].encode()) <= 6 * gone
            kept = got
        if k == 3:
            got = {r.doc_id: r.text for r in out.collect()}
            for i, t in kept.items():
                assert not secret_spans(got[i])
                if not secret_spans(t) and got[i] == t:
                    assert "[" not in t or got[i] == t
            kept = got
    assert {r.doc_id for r in out.collect()} == set(kept)


def test_run_writes_all_stages(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and "sequence_id" in out.columns


def test_stages_take_awkward_documents(spark):
    from helpers import AWKWARD

    df = documents(spark, AWKWARD, [None, 3, 3] + list(range(len(AWKWARD) - 3))).selectExpr("doc_id", "text", "'en' lang", "'s' source", "cast(length(text) as bigint) n_chars")
    for data in (df, df.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, data, "").count()
