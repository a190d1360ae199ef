"""Quality rules as a short-circuit cascade.

A document is kept if it passes every rule.  Each rule is a small function of
the document; what it costs and how often it rejects are estimated on a
sample, and the rules run in descending order of rejections per second, so a
document is judged by the cheap and decisive rules first and the rest never
run on what they reject.  The verdict is a conjunction: the order changes the
cost only, never the result.

One pass over whole texts without a shuffle.  The sample is bounded by
``SAMPLE_DOCS`` documents chosen by the hash of their id; one row per rule and
task comes back to the driver.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm import common

SAMPLE_DOCS = 2000
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
_DROP_SYMBOLS = str.maketrans("", "", SYMBOLS)
WINDOW = 8


class Doc:
    """A text with its measures, each worked out when first asked for."""

    __slots__ = ("text", "_words", "_made")

    def __init__(self, text: str) -> None:
        self.text, self._words, self._made = text, None, {}

    @property
    def words(self) -> list[str]:
        if self._words is None:
            self._words = split_words(self.text)
        return self._words

    def get(self, name: str) -> int:
        if name not in self._made:
            self._made[name] = MEASURES[name](self)
        return self._made[name]


def split_words(text: str) -> list[str]:
    # bytes.split() knows exactly the six ASCII spaces; far faster than a pattern.
    return [w.decode() for w in text.encode().split()] if not text.isascii() else _ascii_words(text)


def _ascii_words(text: str) -> list[str]:
    # str.split() also cuts at \x1c-\x1f, which are word characters here.
    return text.split() if not re.search("[\x1c-\x1f]", text) else WORD.findall(text)


def _dup_lines(d: Doc) -> int:
    lines = d.text.split("\n")
    if len(set(lines)) == len(lines):
        return 0
    real = [x for x in lines if WORD.search(x)]
    return len(real) - len(set(real))


def _repeat_words(d: Doc) -> int:
    """Words covered by a window of 8 words that the text holds twice or more."""
    n = len(d.words)
    if n <= WINDOW:
        return 0
    names: dict[str, int] = {}
    rank = np.fromiter((names.setdefault(w, len(names)) for w in d.words), dtype=np.int64, count=n)
    if len(names) == n:
        return 0
    span, counts = 1, None
    while span < WINDOW:  # exact names of 2, 4 and 8 words
        pairs = rank[:-span] * np.int64(n + 1) + rank[span:]
        _, rank, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        span *= 2
        if counts.max() == 1:
            return 0
    starts = np.flatnonzero(counts[rank] > 1)
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


MEASURES: dict[str, Callable[[Doc], int]] = {
    "n_words": lambda d: len(d.words),
    "word_chars": lambda d: sum(map(len, d.words)),
    "n_symbols": lambda d: len(d.text) - len(d.text.translate(_DROP_SYMBOLS)) if not d.text.isascii() else sum(map(d.text.count, SYMBOLS)),
    "n_dup_lines": _dup_lines,
    "n_repeat_words": _repeat_words,
    "n_lines": lambda d: sum(1 for x in d.text.split("\n") if WORD.search(x)),
    "n_exclamations": lambda d: d.text.count("!"),
}


@dataclass(frozen=True)
class Rule:
    """``rejects(doc)`` is true for a document to drop."""

    name: str
    rejects: Callable[[Doc], bool]


#: The two rules that any document must pass.
BASE_RULES = (
    Rule("few_words", lambda d: d.get("n_words") < 20),
    Rule("repeated_words", lambda d: 100 * d.get("n_repeat_words") > 30 * d.get("n_words")),
)
#: Further rules; limits lie well outside what ordinary prose shows.
METHOD_RULES = (
    Rule("symbols", lambda d: 10 * d.get("n_symbols") > 3 * d.get("n_words")),
    Rule("duplicate_lines", lambda d: 10 * d.get("n_dup_lines") > 4 * d.get("n_lines")),
    Rule("word_length", lambda d: not 2 * d.get("n_words") <= d.get("word_chars") <= 20 * d.get("n_words")),
    Rule("exclamations", lambda d: 10 * d.get("n_exclamations") > 5 * d.get("n_words")),
)
RULES = BASE_RULES + METHOD_RULES


def plan(df: DataFrame, rules: Sequence[Rule] = RULES, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[Rule, float, float]]:
    """Rules in running order, each with its seconds and rejections a sampled document.

    Every rule runs alone on every sampled document.  Rules that reject
    nothing come last, cheapest first; ties keep the given order.
    """
    docs = common.texts(df, id_col, text_col)
    n = docs.count()
    share = min(1.0, sample_docs / n) if n else 1.0
    pick = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20))
    todo = list(rules)

    def trial(batches):
        spent, hits, seen = [0.0] * len(todo), [0] * len(todo), 0
        for _, tx in common.rows(batches):
            for t in tx:
                seen += 1
                for k, r in enumerate(todo):
                    began = time.perf_counter()
                    hits[k] += bool(r.rejects(Doc(t)))
                    spent[k] += time.perf_counter() - began
        yield pa.RecordBatch.from_arrays([pa.array(range(len(todo)), pa.int32()), pa.array(spent), pa.array(hits, pa.int64()), pa.array([seen] * len(todo), pa.int64())], names=["k", "spent", "hits", "seen"])

    got = docs.where(pick).mapInArrow(trial, "k int, spent double, hits long, seen long").groupBy("k").agg(F.sum("spent").alias("spent"), F.sum("hits").alias("hits"), F.sum("seen").alias("seen")).collect()
    stats = {r["k"]: (r["spent"] / max(1, r["seen"]), r["hits"] / max(1, r["seen"])) for r in got}
    out = [(r, *stats.get(k, (0.0, 0.0))) for k, r in enumerate(todo)]
    return sorted(out, key=lambda x: (-(x[2] / max(x[1], 1e-9)), x[1]))


def cascade(doc: Doc, order: Sequence[Rule]) -> str | None:
    """Name of the first rule that rejects, or None."""
    for r in order:
        if r.rejects(doc):
            return r.name
    return None


def judge(df: DataFrame, order: Sequence[Rule], measures: Sequence[str] = (), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, the asked measures, kept, failed_rule.

    Without measures, only what the cascade reaches is worked out.  A null or
    empty text has no words and fails ``few_words``.  Null ids and repeated
    rows are judged like any other; extra columns are left behind.
    """
    order, measures = list(order), list(measures)

    def run(batches):
        for ids, tx in common.rows(batches):
            got: list[list] = [[] for _ in measures]
            failed = []
            for t in tx:
                d = Doc(t)
                failed.append(cascade(d, order))
                for out, m in zip(got, measures):
                    out.append(d.get(m))
            cols = [pa.array(ids, pa.int64()), *(pa.array(g, pa.int64()) for g in got), pa.array([f is None for f in failed]), pa.array(failed, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", *measures, "kept", "failed_rule"])

    schema = ", ".join(["doc_id long", *(f"{m} long" for m in measures), "kept boolean", "failed_rule string"])
    return common.texts(df, id_col, text_col).mapInArrow(run, schema)


def keep(df: DataFrame, order: Sequence[Rule], text_col: str = "text") -> DataFrame:
    """The rows that pass every rule, all columns unchanged."""
    names, order = df.columns, list(order)
    at = names.index(text_col)

    def run(batches):
        for b in batches:
            good = [cascade(Doc(t or ""), order) is None for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(good, pa.bool_()))

    return df.mapInArrow(run, df.schema)
