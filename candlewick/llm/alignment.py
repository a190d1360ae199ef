"""Cross-tokenizer alignment on white-space anchors.

Every text is tokenised in full by both vocabularies.  A byte offset at which
both have a token that begins with a space is an anchor: the tokens before it
end there in either sequence.  Anchors, verified on the bytes, split the
document into windows of token ids, mostly one word each; a window's alignment
(groups, links, linked id pairs) depends on its ids alone, so it is worked out
once and memoised by its two id tuples.

A document's columns that need corpus-wide counts are found without holding
the pair table anywhere whole:

1. A task aligns its documents block by block (``BLOCK_CHARS`` characters; a
   memo of ``MEMO`` windows ends a block too and starts anew).  A document
   keeps its window numbers and how often it has each; a block keeps its
   windows' links, and emits every pair once with its count.
2. Spark sums the block counts by id pair and takes the highest of each B id.
3. The sums go back to the blocks that hold the pair, and each block's
   documents are added up from its windows.

What is shuffled are distinct pairs a block, and the documents' window numbers.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm import common

BLOCK_CHARS = 8_000_000
MEMO = 700_000
FLUSH_BYTES = 4 << 20
TOGETHER = 500_000
_DICTIONARY, _DOCUMENT, _PAIR = 0, 1, 2


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _byte_letters() -> dict[str, int]:
    """Letter of a byte-level vocabulary to its byte: visible Latin-1 stands for itself, the rest follows from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(visible))
    return {chr(b): b for b in visible} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


class ByteTokens:
    """A byte-level BPE file: ids of a text and the bytes of each id."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        vocab = spec["model"]["vocab"]
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes = [b""] * (max([*vocab.values(), *added.values()]) + 1)
        for token, i in (vocab | added).items():
            self.bytes[i] = token.encode() if token in added else bytes(letters[c] for c in token)
        self.path, self._library = path, None
        self._ranks = self._as_ranks(spec, vocab, added)

    def _as_ranks(self, spec: dict, vocab: dict, added: dict):
        """The same vocabulary for the faster library, if ids are in the order of the merges and words split by the usual rule."""
        import public_tokenizers
        import tiktoken

        merges = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
        plain = spec.get("normalizer") is None and (spec.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and spec["pre_tokenizer"].get("use_regex", True)
        if not plain or any(vocab[m.replace(" ", "", 1)] != 256 + k for k, m in enumerate(merges)):
            return None
        ranks = {self.bytes[i]: i for t, i in vocab.items() if t not in added}
        return tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _by_library(self, text: str) -> list[int]:
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
            self._library.encode_special_tokens = True
        return self._library.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> list[int] | None:
        """Ids of a text; None if their bytes differ from it (ranks of single bytes keep them)."""
        if self._ranks is not None:
            try:
                return self._ranks.encode_ordinary(text)
            except BaseException as e:  # its regular expressions give up on some very long runs
                if type(e).__name__ != "PanicException" and not isinstance(e, ValueError):
                    raise
        ids = self._by_library(text)
        return ids if b"".join(map(self.bytes.__getitem__, ids)) == text.encode() else None


class PieceTokens:
    """A SentencePiece model: ids of texts and the bytes of each id."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = self.lib.id_to_piece(list(range(self.lib.get_piece_size())))
        self.bytes = [bytes([int(p[3:5], 16)]) if self.lib.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]

    def encode(self, texts: list[str]) -> list[list[int] | None]:
        """Ids of each text; None where their bytes are not a space and the text.  Texts go together: a call starts threads."""
        letters = self.bytes.__getitem__
        found = self.lib.encode(texts, out_type=int, num_threads=1)
        return [ids if b"".join(map(letters, ids)) == b" " + t.encode() else None for t, ids in zip(texts, found)]


_B = 1 << 31
_ODD = np.random.default_rng(12).integers(0, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def _woven(first: np.ndarray, second: np.ndarray, cut_first: np.ndarray, cut_second: np.ndarray) -> np.ndarray:
    """Both sequences in one, part by part: a part of the first, then its part of the second; cuts include 0 and the end."""
    row = np.empty(len(first) + len(second), np.int64)
    row[np.arange(len(first)) + np.repeat(cut_second[:-1], np.diff(cut_first))] = first
    row[np.arange(len(second)) + np.repeat(cut_first[1:], np.diff(cut_second))] = second
    return row


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _distinct(row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First part of ``row`` (cut at ``at``) of each content, and for every part the number of its content."""
    size = np.diff(at)
    place = np.arange(len(row)) - np.repeat(at[:-1], size)
    mixed = (row.astype(np.uint64) + np.uint64(1)) * _ODD[place % len(_ODD)] * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1))
    mixed ^= mixed >> np.uint64(29)
    digest = np.add.reduceat(mixed * np.uint64(0x9E3779B97F4A7C15), at[:-1])
    _, once, again = np.unique(digest, return_index=True, return_inverse=True)
    of = once[again]
    if (size == size[of]).all() and (row == row[_ranges(at[of], size)]).all():
        return once, again
    parts: dict[bytes, int] = {}  # two contents share a digest
    first, again = [], []
    for k in range(len(size)):
        n = parts.setdefault(row[at[k] : at[k + 1]].tobytes(), len(parts))
        if n == len(first):
            first.append(k)
        again.append(n)
    return np.array(first), np.array(again)


class Aligner:
    """Memoised window alignments, and what one block of documents has of them.

    A window's key are its A ids and then its B ids, these with the highest
    bit set.  A document's new windows are aligned together.  The memo
    outlives blocks; ``forget`` bounds it.
    """

    def __init__(self, a: ByteTokens, b: PieceTokens) -> None:
        self.a, self.b = a, b
        self.len_a, self.len_b = (np.array([len(x) for x in t.bytes], np.int64) for t in (a, b))
        self.mark_a, self.mark_b = (np.array([x[:1] == b" " for x in t.bytes]) for t in (a, b))
        na, nb = range(len(a.bytes)), range(len(b.bytes))
        self.spelled = [*(f"{x}," for x in na), *(f"{x}|" for x in na), *(f"{x}," for x in nb), *(f"{x};" for x in nb)]
        self.forget()

    def forget(self) -> None:
        self.windows: dict[bytes, int] = {}
        self.texts: list[str] = []  # groups, each with a semicolon behind it
        self.groups, self.links, self.pairs = array("q"), array("q"), array("q")  # per window; the last has all windows' linked ids in a row
        self.seen = np.zeros(1 << 16, np.int64)

    def _learn(self, a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> None:
        """Align windows that lie one behind another in ``a`` and ``b``."""
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        ends = np.union1d(end_a, end_b)  # each stretch between two ends is one overlap
        i, j = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        both = (end_a[i] == ends) & (end_b[j] == ends)
        last_a, last_b = i[both], j[both]
        window = end_a[np.cumsum(size_a) - 1]
        count = [np.diff(np.searchsorted(x, window, side="right"), prepend=0).astype(np.int64) for x in (ends[both], ends)]
        self.groups.frombytes(count[0].tobytes())
        self.links.frombytes(count[1].tobytes())
        self.pairs.frombytes((a[i] << 32 | b[j]).tobytes())
        word_a, word_b = a.copy(), b + 2 * len(self.a.bytes)
        word_a[last_a] += len(self.a.bytes)
        word_b[last_b] += len(self.b.bytes)
        words = list(map(self.spelled.__getitem__, _woven(word_a, word_b, np.r_[0, last_a + 1], np.r_[0, last_b + 1]).tolist()))
        at = np.r_[0, np.cumsum(size_a + size_b)].tolist()
        self.texts.extend(map("".join, map(words.__getitem__, map(slice, at, at[1:]))))

    def _tokens(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both vocabularies, or None where the joined bytes are not a space and the text."""
        filled = [d for d, t in enumerate(texts) if t]
        out: list = [None] * len(texts)
        for d, b in zip(filled, self.b.encode([texts[d] for d in filled])):
            if b is not None and (a := self.a.encode(" " + texts[d])) is not None:
                out[d] = (np.array(a, np.int64), np.array(b, np.int64))
        return out

    def documents(self, texts: list[str | None]) -> list[tuple | None]:
        """For each text (n_a, n_b, n_groups, n_links, groups_sha256, window numbers, times), or None without tokens."""
        found = self._tokens(texts)
        out: list[tuple | None] = [None] * len(texts)
        filled = [d for d, f in enumerate(found) if f]
        if not filled:
            return out
        a, b = (np.concatenate([found[d][k] for d in filled]) for k in (0, 1))
        start_a, start_b = (np.cumsum(size) - size for size in (self.len_a[a], self.len_b[b]))
        at_a, at_b = np.flatnonzero(self.mark_a[a]), np.flatnonzero(self.mark_b[b])
        where, look = start_a[at_a], start_b[at_b]
        mate = np.searchsorted(look, where)
        shared = mate < len(look)
        shared[shared] = look[mate[shared]] == where[shared]
        cut_a, cut_b = np.r_[at_a[shared], len(a)], np.r_[at_b[mate[shared]], len(b)]  # every document begins with a space: an anchor
        row, at = _woven(a, b + _B, cut_a, cut_b), cut_a + cut_b
        once, again = _distinct(row, at)
        raw, begin, end = row.astype("<u4").tobytes(), (4 * at[once]).tolist(), (4 * at[once + 1]).tolist()
        keys = list(map(raw.__getitem__, map(slice, begin, end)))
        numbers = list(map(self.windows.get, keys))
        if None in numbers:
            new = [w for w, n in enumerate(numbers) if n is None]
            for known, w in enumerate(new, len(self.windows)):
                numbers[w] = self.windows[keys[w]] = known
            new = once[new]
            size_a, size_b = np.diff(cut_a)[new], np.diff(cut_b)[new]
            self._learn(a[_ranges(cut_a[new], size_a)], b[_ranges(cut_b[new], size_b)], size_a, size_b)
        numbers = np.array(numbers, np.int64)[again]
        if len(self.seen) < len(self.texts):
            self.seen = np.r_[self.seen, np.zeros(len(self.texts), np.int64)]
        spelled = list(map(self.texts.__getitem__, numbers.tolist()))
        n_a = np.array([len(found[d][0]) for d in filled])
        first = np.searchsorted(cut_a, np.r_[0, np.cumsum(n_a)])
        key, times = np.unique(np.repeat(np.arange(len(filled)), np.diff(first)) << 40 | numbers, return_counts=True)
        begin, own = np.searchsorted(key >> 40, np.arange(len(filled) + 1)), key & ((1 << 40) - 1)
        np.add.at(self.seen, own, times)
        groups, links = (np.add.reduceat(np.frombuffer(x, np.int64)[own] * times, begin[:-1]).tolist() for x in (self.groups, self.links))
        for k, d in enumerate(filled):
            digest = hashlib.sha256("".join(spelled[first[k] : first[k + 1]])[:-1].encode()).hexdigest()
            mine = slice(begin[k], begin[k + 1])
            out[d] = (len(found[d][0]), len(found[d][1]), groups[k], links[k], digest, own[mine], times[mine])
        return out

    def block(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The block's windows, their numbers of links, the links as pair numbers; the pairs' ids and counts.  Starts a new block."""
        used = np.flatnonzero(self.seen)
        links = np.frombuffer(self.links, np.int64)
        size, begin = links[used], (np.cumsum(links) - links)[used]
        own, local = np.unique(np.frombuffer(self.pairs, np.int64)[_ranges(begin, size)], return_inverse=True)
        counts = np.zeros(len(own), np.int64)
        np.add.at(counts, local, np.repeat(self.seen[used], size))
        ids = np.stack((own >> 32, own & 0xFFFFFFFF), axis=1)
        self.seen[:] = 0
        return used, size, local, ids, counts


@lru_cache(maxsize=2)
def tokens(byte_path: str, piece_path: str) -> tuple[ByteTokens, PieceTokens]:
    """The worker's vocabularies; kept for all its tasks."""
    return ByteTokens(byte_path), PieceTokens(piece_path)


@lru_cache(maxsize=1)
def worker_aligner(byte_path: str, piece_path: str) -> Aligner:
    return Aligner(*tokens(byte_path, piece_path))


def _runs(texts: list[str | None]):
    """Ranges of texts that are aligned together, ``TOGETHER`` characters or one text."""
    lo = chars = 0
    for hi, t in enumerate(texts, 1):
        chars += len(t or "")
        if chars >= TOGETHER or hi == len(texts):
            yield lo, hi
            lo, chars = hi, 0


_ALIGNED = "kind int, block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, data binary, pair int, a int, b int, n long"
_NAMES = [c.split()[0] for c in _ALIGNED.split(", ")]
_TYPES = dict(zip(_NAMES, [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]))


def _batch(**cols) -> pa.RecordBatch:
    n = len(next(iter(cols.values())))
    return pa.RecordBatch.from_arrays([pa.array(cols[c], _TYPES[c]) if c in cols else pa.nulls(n, _TYPES[c]) for c in _NAMES], names=_NAMES)


def _packed(*parts: np.ndarray) -> bytes:
    return b"".join(p.astype("<u4").tobytes() for p in parts)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u4").astype(np.int64)


def _align_task(byte_path: str, piece_path: str, block_chars: int, memo: int):
    def run(batches):
        aligner = worker_aligner(byte_path, piece_path)
        aligner.seen[:] = 0  # of a task that failed
        block, chars, held, size = TaskContext.get().partitionId() << 32, 0, [], 0

        def documents():
            ids, found = zip(*held)
            cols = {c: [f[k] if f else 0 for f in found] for k, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))}
            return _batch(kind=[_DOCUMENT] * len(held), block=[block] * len(held), doc_id=ids, groups_sha256=[f[4] if f else "" for f in found], data=[f[5] if f else None for f in found], **cols)

        def close():
            used, links, flat, ids, counts = aligner.block()
            if not len(used):
                return
            yield _batch(kind=[_DICTIONARY], block=[block], n=[len(used)], data=[_packed(np.diff(used, prepend=0), links, flat)])
            for s in range(0, len(counts), 50_000):
                e = min(len(counts), s + 50_000)
                yield _batch(kind=np.full(e - s, _PAIR), block=np.full(e - s, block), pair=np.arange(s, e), a=ids[s:e, 0], b=ids[s:e, 1], n=counts[s:e])

        for ids, texts in common.rows(batches):
            for lo, hi in _runs(texts):
                for i, got in zip(ids[lo:hi], aligner.documents(texts[lo:hi])):
                    if got:
                        got = (*got[:5], _packed(np.diff(got[5], prepend=0), got[6]))
                        size += len(got[5])
                    held.append((i, got))
                    size += 200
                chars += sum(len(t) for t in texts[lo:hi] if t)
                full = chars >= block_chars or len(aligner.texts) >= memo
                if full or size >= FLUSH_BYTES:
                    yield documents()
                    held, size = [], 0
                if full:
                    yield from close()
                    block, chars = block + 1, 0
                    if len(aligner.texts) >= memo:
                        aligner.forget()
        if held:
            yield documents()
        yield from close()

    return run


def _add_up_task(batches):
    """Rows sorted by (block, kind): a block's dictionary with its pairs' counts, then its documents."""
    held = used = sums = tops = None
    for block, kind, doc_id, n_a, n_b, n_groups, n_links, sha, data, n, counts, best in common.rows(batches):
        out_best, out_sum, keep = [], [], []
        for r in range(len(block)):
            if kind[r] == _DICTIONARY:
                rest = _unpacked(data[r])
                used, links, flat = np.cumsum(rest[: n[r]]), rest[n[r] : 2 * n[r]], rest[2 * n[r] :]
                end = np.cumsum(links)
                running = [np.r_[0, np.cumsum(np.array(x, np.int64)[flat])] for x in (counts[r], best[r])]
                sums, tops = (x[end] - x[end - links] for x in running)
                held = block[r]
                continue
            keep.append(r)
            if data[r] is None:
                out_best.append(0)
                out_sum.append(0)
                continue
            if held != block[r]:
                raise RuntimeError(f"block {block[r]} has documents and no dictionary")
            rest = _unpacked(data[r])
            own, times = np.searchsorted(used, np.cumsum(rest[: len(rest) // 2])), rest[len(rest) // 2 :]
            out_best.append(int((tops[own] * times).sum()))
            out_sum.append(int((sums[own] * times).sum()))
        if keep:
            pick = [[c[r] for r in keep] for c in (doc_id, n_a, n_b, n_groups, n_links)]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in pick), pa.array(out_best, pa.int64()), pa.array(out_sum, pa.int64()), pa.array([sha[r] for r in keep], pa.string())],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _aligned(df: DataFrame, byte_path: str, piece_path: str, block_chars: int, memo: int, id_col: str, text_col: str) -> DataFrame:
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return common.stored(docs.mapInArrow(_align_task(byte_path, piece_path, block_chars, memo), _ALIGNED), "aligned")


def _pair_counts(stored: DataFrame) -> DataFrame:
    summed = stored.where(F.col("kind") == _PAIR).groupBy("a", "b").agg(F.sum("n").alias("n"))
    return summed.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b")))


def pair_counts(df: DataFrame, byte_path: str | None = None, piece_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The translation table: a, b, n (links of the id pair in the corpus), best (n is the highest of its B id)."""
    return _pair_counts(_aligned(df, byte_path or byte_bpe_path(), piece_path or piece_model_path(), BLOCK_CHARS, MEMO, id_col, text_col))


def align(df: DataFrame, byte_path: str | None = None, piece_path: str | None = None, block_chars: int = BLOCK_CHARS, memo: int = MEMO, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Null and empty texts, and texts whose joined token bytes differ from a
    space and the text (the piece model normalises some signs), have no
    tokens: zeros and an empty string.  Repeated rows and null ids are rows of
    their own and count in the corpus-wide counts as often as they occur.  No
    rows give no rows; extra columns are left behind.
    """
    stored = _aligned(df, byte_path or byte_bpe_path(), piece_path or piece_model_path(), block_chars, memo, id_col, text_col)
    pairs = stored.where(F.col("kind") == _PAIR).select("block", "pair", "a", "b")
    back = pairs.join(_pair_counts(stored), ["a", "b"]).groupBy("block").agg(F.sort_array(F.collect_list(F.struct("pair", "n", "best"))).alias("p"))
    back = back.select("block", F.col("p.n").alias("counts"), F.transform("p.best", lambda x: x.cast("long")).alias("best"))
    cols = ["block", "kind", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "data", "n"]
    dictionary = stored.where(F.col("kind") == _DICTIONARY).select(*cols).join(back, "block").select(*cols, "counts", "best")
    docs = stored.where(F.col("kind") == _DOCUMENT).select(*cols, F.lit(None).cast("array<long>").alias("counts"), F.lit(None).cast("array<long>").alias("best"))
    ordered = dictionary.unionAll(docs).repartition(common.partitions(df.sparkSession), "block").sortWithinPartitions("block", "kind")
    return ordered.mapInArrow(_add_up_task, _RESULT)
