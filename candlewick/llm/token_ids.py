"""Whole texts to token ids with a public tokenizers file, white-space chunk by chunk.

The tokenizer drops white space and splits there, so a text's ids are the ids
of its white-space separated chunks in order.  A worker keeps the ids of the
chunks it has met (``CACHE`` at most, then it starts anew) and asks the
library only about new ones; the result is the library's own for every text.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

#: Chunks and words a worker remembers at most.
CACHE = 700_000
END_ID = 1
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Letters, then signs that no rule joins to letters: two tokens groups, lower-cased one by one.
_PLAIN = re.compile(f"([{_LETTERS}]+)([.,!?;:|]*)")
_CONTROL = re.compile("[\x1c-\x1f]")  # white space to str.split(), not to the tokenizer


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class IdEncoder:
    """Ids of a text as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.lib = Tokenizer.from_file(path)
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelled = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100) if c != 0xF7}
        self.shortcut = self._plain_words_agree()

    def _library(self, text: str) -> bytes:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _model(self, word: str) -> bytes:
        """Ids of a lower-cased word straight from the library's model."""
        return np.array([t.id for t in self.lib.model.tokenize(word.translate(self.spelled))], dtype="<u4").tobytes()

    def _plain_words_agree(self) -> bool:
        """Whether the file treats plain words as ``_PLAIN`` says; any other file goes the long way."""
        tried = ("Über,", "naïve", "The", "über", "façade.!", "don", "ÀÖØÞ", "zzgh;:", "Straße?", "ÿ|")
        try:
            return all(self._library(x) == self._split(x) for x in tried) and all(self._library(f"a {x} b") == self._library("a") + self._library(x) + self._library("b") for x in tried)
        except Exception as e:  # a model without tokenize(), or unknown letters
            if isinstance(e, MemoryError):
                raise
            return False

    def _split(self, chunk: str) -> bytes | None:
        m = _PLAIN.fullmatch(chunk)
        if not m:
            return None
        word, signs = m[1].lower(), m[2]
        got = self.words.get(word)
        if got is None:
            got = self.words[word] = self._model(word)
        if signs:
            tail = self.words.get(signs)
            if tail is None:
                tail = self.words[signs] = self._library(signs)
            got += tail
        return got

    def encode(self, text: str) -> bytes:
        if _CONTROL.search(text):
            return self._library(text)
        chunks = text.split()
        known = self.chunks
        try:
            return b"".join(map(known.__getitem__, chunks))
        except KeyError:
            pass
        new = set(chunks).difference(known)
        if len(known) + len(new) > CACHE or len(self.words) > CACHE:
            known.clear()
            self.words.clear()
            new = set(chunks)
        for c in new:
            got = self._split(c) if self.shortcut else None
            known[c] = self._library(c) if got is None else got
        return b"".join(map(known.__getitem__, chunks))


@lru_cache(maxsize=2)
def encoder(path: str) -> IdEncoder:
    """The worker's encoder of a file; kept for all its tasks."""
    return IdEncoder(path)


def ids_with_end(enc: IdEncoder, text: str, end_id: int = END_ID) -> bytes:
    return enc.encode(text) + int(end_id).to_bytes(4, "little")
