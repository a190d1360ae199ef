"""Secret scan: fixed patterns plus character Markov models.

Base kinds are regular expressions.  The method adds spans of kind
``random``: stretches of key-like characters that two first-order character
Markov models, one of random strings and one of ordinary identifiers, tell apart
by their log-likelihood ratio; words joined to a key do not dilute it.  Both models are trained from labelled samples:

* random: the secrets that the base kinds find in the sampled documents (of an
  assignment its value), and drawn strings over the usual key alphabets, base64
  with padding and base64url among them (seeded by document);
* identifiers: the sampled documents' own words, joined the way identifiers
  are written (snake_case, camelCase, dotted paths, with a number now and then).

The sample is bounded by ``SAMPLE_DOCS`` documents, chosen by the hash of
their id; training sends transition counts (at most ``2 * S * S`` cells, S
symbols) to the driver.  Scanning is one pass over whole texts without a
shuffle; a hot source or group of copies is plain rows there.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm import common

# Fixed patterns of the base kinds.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
HINTS = ("passw", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "random")

#: Candidates of the models: long runs of key-like characters.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SIGNS = "+/_=-"
SYMBOL = np.zeros(128, dtype=np.int64)
for _i, _c in enumerate(ALPHABET):
    SYMBOL[ord(_c)] = _i + 1
N_SYMBOLS = len(ALPHABET) + 1  # 0: start of string

SAMPLE_DOCS = 4000
#: A stretch of a candidate is random from both on: nats in all, and nats a character.
MIN_LLR = 15.0
MIN_LLR_PER_CHAR = 0.7
MIN_STRETCH = 16
#: A stretch grows by so many characters at a time, and in the end by a loss of so many nats.
GROW = 64
SLACK = 3.0

Span = tuple[int, int, int]  # start, kind index, end


def base_spans(text: str) -> list[Span]:
    """Spans of the base kinds: whole matches, code points, end exclusive."""
    out: list[Span] = []
    low = text.lower()
    if any(h in low for h in HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    out.sort()
    return out


def _cells(s: str) -> np.ndarray:
    """Transition cells of a string over ALPHABET, start state first."""
    sym = SYMBOL[np.frombuffer(s.encode("ascii"), dtype=np.uint8)]
    prev = np.concatenate(([0], sym[:-1]))
    return prev * N_SYMBOLS + sym


def random_strings(rng: random.Random, n: int) -> Iterator[str]:
    sets = ("0123456789abcdef", "0123456789ABCDEF", ALPHABET[:62], ALPHABET[:64], ALPHABET[:26] + ALPHABET[52:62], ALPHABET[26:62], ALPHABET[:62] + "_-")
    for _ in range(n):
        chars = rng.choice(sets)
        pad = "=" * rng.randrange(3) if len(chars) == 64 else ""
        yield "".join(rng.choice(chars) for _ in range(rng.randint(20, 48))) + pad


def identifiers(rng: random.Random, text: str, n: int) -> Iterator[str]:
    words = re.findall(r"[A-Za-z]{2,}", text) or ["value", "index"]
    for _ in range(n):
        some = [rng.choice(words) for _ in range(rng.randint(2, 5))]
        style = rng.randrange(5)
        if style == 0:
            s = "_".join(w.lower() for w in some)
        elif style == 1:
            s = some[0].lower() + "".join(w.capitalize() for w in some[1:])
        elif style == 2:
            s = "-".join(some)
        elif style == 3:
            s = "/".join(some)
        else:
            s = "_".join(w.upper() for w in some)
        yield s + (f"_{rng.randint(0, 2030)}" if rng.random() < 0.3 else "")


def labelled(doc_id: int | None, text: str, per_doc: int = 8) -> Iterator[tuple[int, str]]:
    """Labelled strings of a document: (1, random) and (0, identifier)."""
    rng = random.Random(doc_id if doc_id is not None else -1)
    for start, kind, end in base_spans(text):
        value = text[start:end]
        if kind == 0:
            value = ASSIGN.match(value)[2].replace(".", "")
        if len(value) >= 16:
            yield 1, value
    for s in random_strings(rng, per_doc):
        yield 1, s
    for s in identifiers(rng, text, per_doc):
        yield 0, s


def _maximal(x: list[float]) -> list[tuple[int, int]]:
    """All maximal scoring stretches (Ruzzo and Tompa), in order, disjoint."""
    found: list[tuple[float, float, int, int, int]] = []  # sum before, sum after, start, end, last stretch with a smaller sum before
    total = 0.0
    for i, v in enumerate(x):
        before, start = total, i
        total += v
        if v <= 0:
            continue
        k = len(found) - 1
        while True:
            while k >= 0 and found[k][0] >= before:
                k = found[k][4]
            if k < 0 or found[k][1] >= total:
                found.append((before, total, start, i + 1, k))
                break
            before, _, start, _, up = found[k]
            del found[k:]
            k = up
    return [(f[2], f[3]) for f in found]


def _grown(total: np.ndarray, word: np.ndarray, i: int, j: int, per_char: float) -> int:
    """The end of the stretch [i, j) grown to the right; ``total`` are sums, ``word`` word ends.

    To the end of its word, by what raises its sum, and over a few more
    characters up to a word's end that are no clear identifier; each while
    the mean stays at ``per_char``.
    """

    def fits(b: int) -> bool:
        return total[b] - total[i] >= per_char * (b - i)

    b = int(word[j])
    j = b if fits(b) else j
    while (b := j + int(np.argmax(total[j : j + GROW + 1]))) > j and fits(b):
        j = b
    near = np.arange(j + 1, min(j + GROW, len(word) - 1) + 1)
    near = near[(word[near] == near) & (total[near] >= total[j] - SLACK)]
    return next((int(b) for b in near[::-1] if fits(b)), j)


@dataclass(frozen=True)
class MarkovRatio:
    """Log-likelihood ratio per transition cell, random over identifier."""

    ratio: np.ndarray

    @staticmethod
    def from_counts(counts: np.ndarray, smoothing: float = 0.5) -> "MarkovRatio":
        """Ratio zero out of contexts where smoothing outweighs what either class has seen.

        A sign after a sign counts for identifiers or not at all: rule lines,
        form blanks and table borders are in neither class's samples.
        """
        c = counts.reshape(2, N_SYMBOLS, N_SYMBOLS)
        seen = (c.sum(axis=2) >= smoothing * N_SYMBOLS).all(axis=0)
        p = np.log((c + smoothing) / (c + smoothing).sum(axis=2, keepdims=True))
        ratio = np.where(seen[:, None], p[1] - p[0], 0.0)
        signs = np.ix_(SYMBOL[[ord(x) for x in SIGNS]], SYMBOL[[ord(x) for x in SIGNS]])
        ratio[signs] = np.minimum(ratio[signs], 0.0)
        return MarkovRatio(ratio.ravel())

    def stretches(self, s: str, min_llr: float = MIN_LLR, per_char: float = MIN_LLR_PER_CHAR) -> list[tuple[int, int]]:
        """(start, end) of the random stretches of a run, in order and disjoint.

        The whole run, if it is; else the maximal stretches whose ratios
        exceed ``per_char`` on the whole, grown to what belongs to them.
        """
        r = self.ratio[_cells(s)]
        n = len(s)
        if r[r > 0].sum() < min_llr:
            return []
        total = np.concatenate(([0.0], np.cumsum(r)))
        if total[n] >= min_llr and total[n] >= per_char * n:
            return [(0, n)]
        sign = np.array([c in SIGNS for c in s] + [True])
        word = np.minimum.accumulate(np.where(sign, np.arange(n + 1), n)[::-1])[::-1]  # the word's end from each position on
        # The same to the left, as the mirrored run.
        back = total[n] - total[::-1]
        mirrored = np.append(sign[:n][::-1], True)
        word_back = np.minimum.accumulate(np.where(mirrored, np.arange(n + 1), n)[::-1])[::-1]
        out: list[tuple[int, int]] = []
        for i, j in _maximal((r - per_char).tolist()):
            if out and j <= out[-1][1]:
                continue
            j = _grown(total, word, i, j, per_char)
            i = n - _grown(back, word_back, n - j, n - i, per_char)
            if j - i >= MIN_STRETCH and total[j] - total[i] >= min_llr:
                while out and i <= out[-1][1]:
                    i = min(i, out.pop()[0])
                out.append((i, j))
        return out

    def is_random(self, s: str, min_llr: float = MIN_LLR, per_char: float = MIN_LLR_PER_CHAR) -> bool:
        return bool(self.stretches(s, min_llr, per_char))


def train(df: DataFrame, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text") -> MarkovRatio:
    """Train both models on about ``sample_docs`` documents (all, if fewer).

    An empty table leaves only the smoothing: nothing scores as random.
    """
    docs = common.texts(df, id_col, text_col)
    n = docs.count()
    share = min(1.0, sample_docs / n) if n else 1.0
    pick = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20))

    def count(batches):
        counts = np.zeros(2 * N_SYMBOLS * N_SYMBOLS, dtype=np.int64)
        for ids, tx in common.rows(batches):
            for i, t in zip(ids, tx):
                cells = np.concatenate([label * N_SYMBOLS * N_SYMBOLS + _cells(s) for label, s in labelled(i, t)])
                counts += np.bincount(cells, minlength=len(counts))
        cells = np.flatnonzero(counts)  # one small batch a task
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(counts[cells])], names=["cell", "n"])

    found = docs.where(pick).mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(2 * N_SYMBOLS * N_SYMBOLS)
    for r in found:  # at most 2 * S * S cells
        counts[r["cell"]] = r["n"]
    return MarkovRatio.from_counts(counts)


def all_spans(text: str, base: list[Span], model: MarkovRatio) -> list[Span]:
    """Base spans plus random stretches of what they leave of each candidate, by start then kind."""
    added = []
    for m in CANDIDATE.finditer(text):
        at, end = m.span()
        for a, b in [x[::2] for x in base if x[0] < end and at < x[2]] + [(end, end)]:
            if a - at >= MIN_STRETCH:
                added += [(at + s, 3, at + e) for s, e in model.stretches(text[at:a])]
            at = max(at, b)
    return sorted(base + added) if added else base


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_OUT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan(df: DataFrame, model: MarkovRatio, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, digest, all spans.

    A null or empty text has no spans (digest of the empty string).  A null
    id stays null, repeated rows are scanned each.  Texts are read whole,
    whatever their length.  Extra columns are left behind.
    """

    def run(batches):
        for ids, tx in common.rows(batches):
            out: list[list] = [[], [], [], [], []]
            for t in tx:
                base = base_spans(t)
                kinds = [k for _, k, _ in base]
                for k in range(3):
                    out[k].append(kinds.count(k))
                out[3].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out[4].append(joined(all_spans(t, base, model)))
            cols = [pa.array(ids, pa.int64()), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.string()), pa.array(out[4], pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return common.texts(df, id_col, text_col).mapInArrow(run, _OUT)


def redact(df: DataFrame, model: MarkovRatio, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same rows and columns, each secret span in the text replaced by ``[kind]``.

    Overlapping spans are replaced as one by the first one's kind.  Null
    texts stay null; every other column passes through.
    """
    names = df.columns
    at = names.index(text_col)

    def clean(t: str | None) -> str | None:
        if not t:
            return t
        out, pos = [], 0
        for s, k, e in all_spans(t, base_spans(t), model):
            if s >= pos:
                out += [t[pos:s], f"[{KINDS[k]}]"]
            pos = max(pos, e)
        return "".join(out) + t[pos:] if out else t

    def run(batches):
        for b in batches:
            col = pa.array([clean(t) for t in b.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([col if i == at else b.column(i) for i in range(b.num_columns)], names=b.schema.names)

    return df.mapInArrow(run, df.schema)
