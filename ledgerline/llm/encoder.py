"""Token ids of whole texts, with every distinct word encoded once per worker."""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer, pre_tokenizers

from ledgerline.llm.batches import ragged

#: Distinct words a worker remembers; beyond it the memory starts anew, which costs time only.
MOST_WORDS = 500_000

SPACE, LETTER, MARK, OTHER = range(4)
#: Kinds of single bytes. Marks are the ASCII punctuation that occurs in no contraction or special token.
KINDS = np.full(256, OTHER, np.uint8)
KINDS[list(b" \t\n\x0b\x0c\r")] = SPACE
KINDS[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = LETTER
KINDS[list(b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~")] = MARK
#: A Latin-1 letter is this byte and a second one; two of the seconds are signs.
LATIN, SIGNS = 0xC3, (0x97, 0xB7)
ONE_PIECE = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+|[!-&(-/:;=?@\[-`{}~]+")
LATIN_LETTERS = "".join(chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7))


def cut(texts: list[bytes]) -> tuple[pa.BinaryArray, np.ndarray]:
    """Pieces of all texts that a tokenizer may encode one by one, and the number of pieces of each text.

    Texts are cut at white space. A chunk of plain letters (ASCII and Latin-1) and marks alone is also
    cut between letters and marks, and lower-cased; every other chunk stays as it is.
    """
    raw = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    kinds = KINDS[raw]
    leads = np.flatnonzero(raw == LATIN)
    seconds = raw[np.minimum(leads + 1, len(raw) - 1)]
    leads = leads[(seconds & 0xC0 == 0x80) & (seconds != SIGNS[0]) & (seconds != SIGNS[1])]
    kinds[leads] = kinds[leads + 1] = LETTER
    if len(others := np.flatnonzero(kinds == OTHER)):
        spaces = np.flatnonzero(kinds == SPACE)
        chunks = np.unique(np.searchsorted(spaces, others))
        begins = np.where(chunks > 0, spaces[chunks - 1] + 1, 0)
        kinds[ragged(begins, spaces[chunks] - begins)] = OTHER
    low = raw.copy()
    low[(kinds == LETTER) & (raw >= 65) & (raw <= 90)] += 32
    leads = leads[kinds[leads] == LETTER]
    low[leads[(raw[leads + 1] < 0x9F)] + 1] += 32
    filled = kinds != SPACE
    first = filled.copy()
    first[1:] &= kinds[1:] != kinds[:-1]
    at = np.flatnonzero(first)
    offsets = np.append(np.cumsum(filled)[at] - 1, np.count_nonzero(filled)).astype(np.int32)
    found = pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(low[filled])])
    ends = np.cumsum([len(t) + 1 for t in texts])
    return found, np.diff(np.searchsorted(at, ends), prepend=0)


class WordEncoder:
    """Encodes UTF-8 texts with a tokenizer that cuts at white space and drops it.

    The ids of a text are the ids of its pieces (see ``cut``), one after another, so each distinct
    piece goes through the tokenizer once. The result equals ``Tokenizer.encode`` of the whole
    text with ``add_special_tokens=False``.
    """

    def __init__(self, path: str, most_words: int = MOST_WORDS):
        self.tokenizer = Tokenizer.from_file(path)
        both, parts = self._ids(["a\n b."])[0], self._ids(["a", "b."])
        if both != parts[0] + parts[1]:
            raise ValueError(f"{path}: this tokenizer keeps white space")
        # What the tokenizer's byte level makes of letters beyond ASCII.
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {ord(c): level.pre_tokenize_str(c)[0][0] for c in LATIN_LETTERS}
        probes = ["word", "wordling", "!?", ".", "--", *LATIN_LETTERS.lower(), "\xe9cole", "gr\xf6\xdfe"]
        self.model = self.tokenizer.model
        if self._ids(probes) != [self._merged(w.encode()) for w in probes]:
            raise ValueError(f"{path}: this tokenizer does not merge the bytes of a word")
        self.most_words = most_words
        self._forget()

    def _forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 12, np.int64)
        self.lengths = np.zeros(1 << 12, np.int64)
        self.used = 0

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _merged(self, word: bytes) -> list[int]:
        """Ids of one piece by the tokenizer's model alone; nothing has to be normalized or cut."""
        text = word.decode()
        return [t.id for t in self.model.tokenize(text if text.isascii() else text.translate(self.letters))]

    def _encoded(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word; only words that are not one plain piece go through the whole tokenizer."""
        found = [self._merged(w) if ONE_PIECE.fullmatch(w) else None for w in words]
        odd = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(odd, self._ids([words[i].decode("utf-8", "replace") for i in odd]), strict=True):
            found[i] = ids
        return found

    def _learn(self, words: list[bytes]) -> None:
        found = self._encoded(words)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        first, count, total = len(self.index), len(found), int(lengths.sum())
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while first + count > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        self.starts[first : first + count] = self.used + np.cumsum(lengths) - lengths
        self.lengths[first : first + count] = lengths
        self.flat[self.used : self.used + total] = np.fromiter(chain.from_iterable(found), np.uint32, total)
        self.used += total
        self.index.update(zip(words, range(first, first + count), strict=True))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the number of ids of each text."""
        words, counts = cut(texts)
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [w for w in distinct if w not in self.index]
        if len(self.index) + len(new) > self.most_words and self.index:
            self._forget()
            new = distinct
        if new:
            self._learn(new)
        of = np.fromiter(map(self.index.__getitem__, distinct), np.int64, len(distinct))
        numbers = of[coded.indices.to_numpy()]
        lengths = self.lengths[numbers]
        ids = self.flat[ragged(self.starts[numbers], lengths)]
        sums = np.concatenate([[0], np.cumsum(lengths)])
        return ids, np.diff(sums[np.cumsum(counts)], prepend=0)


@lru_cache(maxsize=2)
def encoder(path: str, most_words: int = MOST_WORDS) -> WordEncoder:
    """The encoder of this worker for a tokenizer file."""
    return WordEncoder(path, most_words)


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with the id ``end`` after every text."""
    return np.insert(ids, np.cumsum(counts), np.uint32(end)), counts + 1
