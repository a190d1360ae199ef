from collections import Counter

import pytest
from helpers import AWKWARD, documents, empty, words

from candlewick.llm import queries, quality
from candlewick.plans.oracle_check import compare, duckdb_connection


def brute(text):
    t = text or ""
    w = words(t)
    wins = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    repeated = set()
    for i in range(len(w) - 7):
        if wins[tuple(w[i : i + 8])] > 1:
            repeated |= set(range(i, i + 8))
    lines = [x for x in t.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeated))


TEXTS = AWKWARD + ["a b c d e f g h i j " * 3 + "z " * 30, "one two three four five six seven eight nine ten " * 2 + " ".join(f"u{k}" for k in range(80)), "Good prose with many different words " + " ".join(f"w{k}" for k in range(60)), "SHOUT!! " * 40]
ASKED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@pytest.mark.parametrize("reverse", [False, True])
def test_measures_and_verdict(spark, reverse):
    rules = list(quality.RULES)[:: -1 if reverse else 1]
    got = {r.doc_id: r for r in quality.judge(documents(spark, TEXTS), rules, ASKED).collect()}
    for i, t in enumerate(TEXTS):
        assert tuple(got[i][m] for m in ASKED) == brute(t)
        n, chars, symbols, dup, repeat = brute(t)
        lines = sum(1 for x in (t or "").split("\n") if words(x))
        bad = n < 20 or 100 * repeat > 30 * n or 10 * symbols > 3 * n or 10 * dup > 4 * lines or not 2 * n <= chars <= 20 * n or 10 * (t or "").count("!") > 5 * n
        assert got[i].kept == (not bad) == (got[i].failed_rule is None)


def test_plan_orders_by_rejections_per_cost(spark):
    slow = quality.Rule("slow", lambda d: [sum(range(3000)) for _ in range(20)] is None)
    never = quality.Rule("never", lambda d: False)
    always = quality.Rule("always", lambda d: True)
    df = documents(spark, ["text one two"] * 40)
    order = [r.name for r, _, _ in quality.plan(df, [slow, never, always])]
    assert order[0] == "always"
    assert order.index("never") < order.index("slow")
    assert {r.name for r, _, _ in quality.plan(empty(spark), [slow, never])} == {"slow", "never"}


def test_keep_returns_whole_rows(spark):
    df = documents(spark, TEXTS + [TEXTS[-2]], [None] * (len(TEXTS) + 1))
    kept = quality.keep(df, list(quality.RULES))
    want = [t for t in TEXTS + [TEXTS[-2]] if quality.cascade(quality.Doc(t or ""), quality.RULES) is None]
    assert sorted(r.text for r in kept.collect()) == sorted(want) and kept.columns == df.columns
    assert quality.keep(empty(spark), list(quality.RULES)).count() == 0


def test_query_matches_sql(spark):
    got = compare(queries.QUERIES["op4_quality_rules"](spark, "/root/testdata/sf0.001"), duckdb_connection("/root/testdata/sf0.001"), queries.ORACLES["op4_quality_rules"])
    assert got["match"], got
