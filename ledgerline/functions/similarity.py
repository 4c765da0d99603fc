"""Jaro-Winkler similarity, for which Spark has no built-in, and an upper bound that has one.

Published basis: M. A. Jaro (1989) and W. E. Winkler (1990). The shorter text is matched against the
longer one; half-transpositions are halved with integer division, as in Winkler's own program.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ledgerline.functions.text import MASK_WORDS

# Fixed values of the published measure.
PREFIX_WEIGHT = 0.1
PREFIX_LENGTH = 4
BOOST_ABOVE = 0.7

# Characters held per batch of comparisons, so that long texts make small batches.
CELLS = 1 << 18
# Texts of at most this length keep their matched positions in one machine word.
WORD = 64
# Words that hold the characters of such a text, without their places.
BAG_WORDS = 2
# Where at least one in so many pairs of a matrix has enough characters in common, all are compared.
DENSE = 4


def _codes(texts: list[str], width: int) -> np.ndarray:
    """Code points, one row per text, zero-padded to ``width``."""
    return np.array(texts, dtype=f"<U{max(width, 1)}").view(np.uint32).reshape(len(texts), -1)


def _in_order(codes: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Chosen characters of each row moved to its front, order kept."""
    order = np.argsort(~chosen, axis=1, kind="stable")
    return np.take_along_axis(codes, order, axis=1)


def _score(
    a: np.ndarray, b: np.ndarray, ls: np.ndarray, ll: np.ndarray, m: np.ndarray, moved: np.ndarray
) -> np.ndarray:
    """Jaro-Winkler from the number of matched characters and of those out of order."""
    total = m / np.maximum(ls, 1) + m / np.maximum(ll, 1)
    jaro = np.where(m > 0, (total + (m - moved // 2) / np.maximum(m, 1)) / 3.0, 0.0)
    head = min(PREFIX_LENGTH, a.shape[1], b.shape[1])
    alike = (a[:, :head] == b[:, :head]) & (np.arange(head)[None, :] < ls[:, None])
    prefix = np.cumprod(alike, axis=1).sum(axis=1)
    return jaro + np.where(jaro > BOOST_ABOVE, prefix * PREFIX_WEIGHT * (1.0 - jaro), 0.0)


def _low_bits(count: np.ndarray) -> np.ndarray:
    """Words whose lowest ``count`` bits are set."""
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    shift = np.clip(WORD - count, 0, WORD - 1).astype(np.uint64)
    return np.where(count > 0, full >> shift, np.uint64(0))


def _compare_words(short: list[str], long: list[str], ls: np.ndarray, ll: np.ndarray) -> np.ndarray:
    """For texts that fit one word of matched positions each."""
    a, b = _codes(short, int(ls.max())), _codes(long, WORD)
    if max(a.max(initial=0), b.max(initial=0)) < 256:
        a, b = a.astype(np.uint8), b.astype(np.uint8)
    reach = np.maximum(ll // 2 - 1, 0)
    used = np.zeros(len(short), np.uint64)
    hits = np.zeros(a.shape, bool)
    for i in range(a.shape[1]):
        same = np.packbits(b == a[:, i, None], axis=1, bitorder="little").view("<u8")[:, 0]
        window = _low_bits(np.minimum(i + reach + 1, ll)) & ~_low_bits(np.maximum(i - reach, 0))
        free = np.where(i < ls, same & window & ~used, np.uint64(0))
        used |= free & (~free + np.uint64(1))
        hits[:, i] = free != 0
    moved = np.zeros(len(short), np.int64)
    rows = np.arange(len(short))
    for i in range(a.shape[1]):
        first = used & (~used + np.uint64(1))
        place = np.where(hits[:, i], np.bitwise_count(first - np.uint64(1)), 0)
        moved += hits[:, i] & (b[rows, place] != a[:, i])
        used = np.where(hits[:, i], used ^ first, used)
    return _score(a, b, ls, ll, hits.sum(axis=1), moved)


def _compare_any(short: list[str], long: list[str], ls: np.ndarray, ll: np.ndarray) -> np.ndarray:
    """For texts of any length."""
    a, b = _codes(short, int(ls.max())), _codes(long, int(ll.max()))
    reach = np.maximum(ll // 2 - 1, 0)
    widest = int(reach.max())
    rows = np.arange(len(short))
    used_a, used_b = np.zeros(a.shape, bool), np.zeros(b.shape, bool)
    places = np.arange(b.shape[1])
    for i in range(a.shape[1]):
        lo, hi = max(0, i - widest), min(b.shape[1], i + widest + 1)
        if lo >= hi:
            break
        near = places[None, lo:hi]
        fits = (b[:, lo:hi] == a[:, i, None]) & ~used_b[:, lo:hi]
        fits &= (np.abs(near - i) <= reach[:, None]) & (near < ll[:, None]) & (i < ls[:, None])
        first = fits.argmax(axis=1)
        hit = fits[rows, first]
        used_a[hit, i] = True
        used_b[rows[hit], first[hit] + lo] = True
    m = used_a.sum(axis=1)
    width = min(a.shape[1], b.shape[1])
    moved = _in_order(a, used_a)[:, :width] != _in_order(b, used_b)[:, :width]
    moved &= np.arange(width)[None, :] < m[:, None]
    return _score(a, b, ls, ll, m, moved.sum(axis=1))


def jaro_winkler_pairs(left: pd.Series, right: pd.Series) -> pd.Series:
    """Similarity of each pair of texts; NULL where either is NULL."""
    out = np.full(len(left), np.nan)
    known = np.flatnonzero((left.notna() & right.notna()).to_numpy())
    lefts, rights = left.to_numpy(object)[known], right.to_numpy(object)[known]
    if len(known) == 0:
        return pd.Series(out)
    flipped = np.fromiter((len(x) > len(y) for x, y in zip(lefts, rights)), bool, len(known))
    short, long = np.where(flipped, rights, lefts), np.where(flipped, lefts, rights)
    ls = np.fromiter((len(x) for x in short), np.int64, len(known))
    ll = np.fromiter((len(x) for x in long), np.int64, len(known))
    order = np.argsort(ll, kind="stable")  # texts of like length share a batch
    start = 0
    while start < len(order):
        # Rows are sorted by length, so the last row of a batch sets its width.
        stop = start + max(1, CELLS // max(1, int(ll[order[start]])))
        stop = min(stop, len(order))
        while stop - start > 1 and (stop - start) * int(ll[order[stop - 1]]) > CELLS:
            stop = start + (stop - start) // 2
        part = order[start:stop]
        x, y = list(short[part]), list(long[part])
        compare = _compare_words if ll[part].max() <= WORD else _compare_any
        out[known[part]] = compare(x, y, ls[part], ll[part])
        start = stop
    return pd.Series(out)


def reaching(lefts: list[str], rights: list[str], threshold: float) -> np.ndarray:
    """Which of all pairs of the two lists reach a similarity, as a matrix; the same as comparing them one by one.

    Each list is turned into numbers once, and only pairs that share enough characters to reach the threshold are
    compared. Meant for tiles of some thousand texts a side.
    """
    out = np.zeros((len(lefts), len(rights)), bool)
    sizes = [np.fromiter(map(len, texts), np.int64, len(texts)) for texts in (lefts, rights)]
    fits = [np.flatnonzero(size <= WORD) for size in sizes]
    for long, others, flip in ((lefts, rights, False), (rights, lefts, True)):
        for i in np.flatnonzero(sizes[flip] > WORD):
            scores = jaro_winkler_pairs(*_in_pairs(long[i], others, flip)).to_numpy()
            if flip:
                out[:, i] = scores >= threshold
            else:
                out[i] = scores >= threshold
    alphabet = {c: k for k, c in enumerate(sorted(set().union(*lefts, *rights)))}
    sides = [_Side([texts[i] for i in rows], alphabet) for texts, rows in zip((lefts, rights), fits, strict=True)]
    # The left text is the shorter one of equally long ones.
    for short, other, flip in ((0, 1, False), (1, 0, True)):
        for size, rows in sides[short].by_size():
            columns = np.flatnonzero(sides[other].sizes > size if flip else sides[other].sizes >= size)
            if not len(columns):
                continue
            long = _Longer(sides[other], columns, size, threshold)
            step = max(1, CELLS // (8 * len(columns)))
            for i in range(0, len(rows), step):
                some = rows[i : i + step]
                x, y = _reach(sides[short], some, long, threshold)
                mine, theirs = fits[short][some[x]], fits[other][columns[y]]
                out[(theirs, mine) if flip else (mine, theirs)] = True
    return out


def _in_pairs(text: str, others: list[str], flip: bool) -> tuple[pd.Series, pd.Series]:
    pair = pd.Series([text] * len(others), dtype=object), pd.Series(others, dtype=object)
    return pair[::-1] if flip else pair


class _Side:
    """Texts of at most one word of positions, as numbers of an alphabet."""

    def __init__(self, texts: list[str], alphabet: dict[str, int]):
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.codes = np.full((len(texts), WORD), -1, np.int64)
        for i, text in enumerate(texts):
            self.codes[i, : len(text)] = [alphabet[c] for c in text]
        # Positions of each character, a bit each: one row per character, one column per text.
        self.places = np.zeros((len(alphabet) + 1, len(texts)), np.uint64)
        for p in range(int(self.sizes.max(initial=0))):
            rows = np.flatnonzero(self.sizes > p)
            self.places[self.codes[rows, p], rows] |= np.uint64(1 << p)

        # The characters of each text as bits, a second occurrence apart from the first. Where two of them share a
        # bit, less seems to be lacking than is.
        self.bags = np.zeros((BAG_WORDS, len(texts)), np.uint64)
        for p in range(int(self.sizes.max(initial=0))):
            rows = np.flatnonzero(self.sizes > p)
            before = (self.codes[rows, :p] == self.codes[rows, p, None]).sum(axis=1)
            slot = (self.codes[rows, p] + before * len(alphabet)) % (WORD * BAG_WORDS)
            self.bags[slot // WORD, rows] |= np.uint64(1) << (slot % WORD).astype(np.uint64)

    def by_size(self) -> list[tuple[int, np.ndarray]]:
        return [(int(s), np.flatnonzero(self.sizes == s)) for s in np.unique(self.sizes) if s]


class _Longer:
    """What the longer texts need to be compared with texts of one size."""

    def __init__(self, side: _Side, columns: np.ndarray, size: int, threshold: float):
        self.codes, self.ll, self.absent = side.codes[columns], side.sizes[columns], ~side.bags[:, columns]
        self.places = side.places[:, columns]
        reach = np.maximum(self.ll // 2 - 1, 0)
        self.windows = [
            _low_bits(np.minimum(i + reach + 1, self.ll)) & ~_low_bits(np.maximum(i - reach, 0))
            for i in range(size)
        ]
        # Characters that the short text may lack a partner for: all others matched, in order, after the longest prefix.
        m = np.arange(size + 1)
        best = _boosted(size, self.ll[:, None], m, np.zeros_like(m), np.int64(PREFIX_LENGTH))
        enough = best >= threshold - 1e-9
        self.spare = np.where(enough.any(axis=1), size - enough.argmax(axis=1), -1)


def _reach(side: _Side, some: np.ndarray, long: _Longer, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs that reach the threshold, of equally long short texts (rows ``some``) and longer ones."""
    lacking = sum(
        np.bitwise_count(bag[some, None] & absent[None, :])
        for bag, absent in zip(side.bags, long.absent, strict=True)
    )
    x, y = np.nonzero(lacking <= long.spare[None, :])
    size = int(side.sizes[some[0]])
    if DENSE * len(x) > lacking.size:  # a matrix is compared faster than as many single pairs
        codes = side.codes[some, :size]
        used, hits = _matched(long.places, codes, ..., long.windows)
        used, hits = used[x, y], hits[x, y]
    else:
        codes = side.codes[some[x], :size]
        used, hits = _matched(long.places, codes, y, long.windows)
    m = np.bitwise_count(hits).astype(np.int64)
    left = size - m <= long.spare[y]
    x, y, used, hits, m = x[left], y[left], used[left], hits[left], m[left]
    short, moved = side.codes[some[x], :size], np.zeros(len(x), np.int64)
    head = min(PREFIX_LENGTH, size)
    prefix = np.cumprod(short[:, :head] == long.codes[y, :head], axis=1).sum(axis=1)
    for i in range(size):
        hit = (hits >> np.uint64(i)) & np.uint64(1) != 0
        first = used & (~used + np.uint64(1))
        moved += hit & (first & long.places[short[:, i], y] == 0)
        used = np.where(hit, used ^ first, used)
    reached = _boosted(size, long.ll[y], m, moved, prefix) >= threshold
    return x[reached], y[reached]


def _matched(
    places: np.ndarray, codes: np.ndarray, which: np.ndarray, windows: list[np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Matched positions of the longer and of the shorter texts; ``which`` longer text meets each row, or ``...`` for all."""
    used = np.zeros(np.broadcast_shapes(places[codes[:, 0], which].shape, windows[0][which].shape), np.uint64)
    hits = np.zeros_like(used)
    for i, window in enumerate(windows):
        free = places[codes[:, i], which] & window[which] & ~used
        free &= ~free + np.uint64(1)
        used |= free
        hits |= (free != 0).astype(np.uint64) << np.uint64(i)
    return used, hits


def _boosted(
    ls: int, ll: np.ndarray, m: np.ndarray, moved: np.ndarray, prefix: np.ndarray
) -> np.ndarray:
    total = m / ls + m / np.maximum(ll, 1)
    jaro = np.where(m > 0, (total + (m - moved // 2) / np.maximum(m, 1)) / 3.0, 0.0)
    return jaro + np.where(jaro > BOOST_ABOVE, prefix * PREFIX_WEIGHT * (1.0 - jaro), 0.0)


@F.pandas_udf(DoubleType())
def jaro_winkler(left: pd.Series, right: pd.Series) -> pd.Series:
    return jaro_winkler_pairs(left, right)


def least_jaro(threshold: float, prefix: int) -> float:
    """Jaro similarity that texts with a shared prefix need for this Jaro-Winkler similarity."""
    gain = prefix * PREFIX_WEIGHT
    return min(threshold, max(BOOST_ABOVE, (threshold - gain) / (1.0 - gain)))


def may_reach(threshold: float, prefix: int, left: str, right: str) -> Column:
    """False only where the similarity of two texts must stay below ``threshold``.

    ``left`` and ``right`` are suffixes of columns made by ``with_character_masks``. With ``s`` shared
    characters the Jaro similarity is at most ``(s / a + s / b + 1) / 3``, and no text can share more
    than its characters that the other has.
    """
    a, b = F.col(f"length_{left}"), F.col(f"length_{right}")
    needed = F.lit(3.0 * least_jaro(threshold, prefix) - 1.0 - 1e-9) * a * b

    def enough(length: Column, mine: str, other: str) -> Column:
        shared = length
        for i in range(MASK_WORDS):
            lacking = F.col(f"mask{i}_{mine}").bitwiseAND(F.bitwise_not(F.col(f"mask{i}_{other}")))
            shared = shared - F.bit_count(lacking)
        return shared * (a + b) >= needed

    return enough(a, left, right) & enough(b, right, left)
