"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A three-letter group is the product of its letters' vectors,
each permuted by its place (a rotation); a text, or a language, is the sum (bundle) of its groups' vectors.
The language whose bundle has the largest cosine with the text's is predicted.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.batches import pieces, texts_of

DIMENSIONS = 1024
SEED = 11
UNKNOWN = "und"
#: Documents whose vectors are built together.
TOGETHER = 64


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=1 << 14)
def letter_vector(code: int, dimensions: int, seed: int) -> np.ndarray:
    """The vector of a letter, or of the border of a word (code 0)."""
    return np.random.default_rng([seed, code]).integers(0, 2, dimensions, np.int8) * 2 - 1


#: Text bytes that are worked on at a time: some fifty bytes of arrays for each of them.
TEXT_BYTES = 3 << 19


@dataclass
class Groups:
    """Three-letter groups of some texts: for each occurrence its text and its number, and the groups by number."""

    owner: np.ndarray
    number: np.ndarray
    codes: np.ndarray

    def vectors(self, numbers: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
        symbols, place = np.unique(self.codes[numbers], return_inverse=True)
        table = np.array([letter_vector(int(c), dimensions, seed) for c in symbols], np.int8).reshape(-1, dimensions)
        first, second, third = place.reshape(-1, 3).T
        return np.roll(table, 2, axis=1)[first] * np.roll(table, 1, axis=1)[second] * table[third]


def groups_of(texts: list[bytes]) -> Groups:
    """Groups of neighbouring letters in lower case; the border of a word counts as a letter at either end."""
    lowered = [t.decode("utf-8", "replace").lower() for t in texts]
    lengths = np.fromiter((len(t) + 1 for t in lowered), np.int64, len(lowered))
    codes = np.frombuffer("\0".join(["", *lowered, ""]).encode("utf-32-le"), np.uint32)
    codes = np.where(_letters()[codes], codes, 0)
    kept = np.flatnonzero((codes != 0) | (np.concatenate([[1], codes[:-1]]) != 0))
    codes = codes[kept]
    centre = np.flatnonzero(codes[1:-1] != 0) + 1
    owner = np.searchsorted(np.cumsum(lengths), kept[centre], "right")
    symbols = np.flatnonzero(np.bincount(codes, minlength=1))
    rank = np.zeros(int(symbols[-1]) + 1 if len(symbols) else 1, np.int64)
    rank[symbols] = np.arange(len(symbols))
    of, n = rank[codes], len(symbols)
    packed = (of[centre - 1] * n + of[centre]) * n + of[centre + 1]
    if n**3 <= 1 << 24:  # a table is quicker than sorting
        present = np.flatnonzero(np.bincount(packed, minlength=1))
        table = np.zeros(int(present[-1]) + 1 if len(present) else 1, np.int64)
        table[present] = np.arange(len(present))
        number = table[packed]
    else:
        present, number = np.unique(packed, return_inverse=True)
    parts = np.stack([present // (n * n), present // n % n, present % n], axis=1)
    return Groups(owner, number, symbols[parts] if len(present) else np.zeros((0, 3), np.int64))


@dataclass(frozen=True)
class Profiles:
    """Bundles of the learned languages, in alphabetical order."""

    languages: list[str]
    bundles: np.ndarray
    seed: int

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        """Language and cosine of each text; without a letter, or before anything is learned, ``und`` and 0.

        Equal cosines go to the first language in alphabetical order.
        """
        n, dimensions = len(texts), self.bundles.shape[1]
        best, score = np.full(n, -1), np.zeros(n)
        if len(self.languages):
            lengths = np.linalg.norm(self.bundles, axis=1)
            units = (self.bundles / np.where(lengths > 0, lengths, 1)[:, None]).astype(np.float32)
            groups = groups_of(texts)
            every = max(1, len(groups.codes))
            keys, counts = _counted(groups.owner * every + groups.number)
            owner, number = keys // every, keys % every
            bounds = np.searchsorted(owner, np.arange(0, n + TOGETHER, TOGETHER))
            for block, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                if a == b:
                    continue
                used = np.flatnonzero(np.bincount(number[a:b], minlength=every))
                place = np.zeros(every, np.int64)
                place[used] = np.arange(len(used))
                table = np.zeros((min(TOGETHER, n - block * TOGETHER), len(used)), np.float32)
                table[owner[a:b] - block * TOGETHER, place[number[a:b]]] = counts[a:b]
                sums = table @ groups.vectors(used, dimensions, self.seed).astype(np.float32)
                size = np.linalg.norm(sums, axis=1)
                cosine = (sums @ units.T) / np.where(size > 0, size, 1)[:, None]
                rows = np.arange(len(table)) + block * TOGETHER
                some = table.any(axis=1)
                best[rows[some]] = cosine.argmax(axis=1)[some]
                score[rows] = np.where(some, np.clip(cosine.max(axis=1), 0, 1), 0)
        return [self.languages[i] if i >= 0 else UNKNOWN for i in best.tolist()], score


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.diff(np.append(first, len(keys)))


def learn(docs: DataFrame, text: str = "text", language: str = "lang", dimensions: int = DIMENSIONS, seed: int = SEED) -> Profiles:
    """Profiles of all languages of the labelled documents; a null text or language teaches nothing.

    Each task bundles its documents to one vector per language, and the vectors are summed by Spark, so the driver
    receives ``dimensions`` numbers per language.
    """

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in pieces(batches, most=TEXT_BYTES):
            names = batch.column("lang").to_pylist()
            order = sorted(set(names))
            rank = np.array([order.index(n) for n in names])
            groups = groups_of(texts_of(batch))
            every = max(1, len(groups.codes))
            table = np.bincount(rank[groups.owner] * every + groups.number, minlength=every * len(order)).reshape(-1, every)
            for i in range(0, len(groups.codes), 1 << 12):  # bounds the vectors in memory
                some = np.arange(i, min(i + (1 << 12), len(groups.codes)))
                part = table[:, some].astype(np.float64) @ groups.vectors(some, dimensions, seed).astype(np.float64)
                for name, values in zip(order, part, strict=True):
                    sums[name] = sums.get(name, 0) + np.rint(values).astype(np.int64)
        for name, values in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([name] * dimensions, pa.string()), "dimension": pa.array(range(dimensions), pa.int32()), "value": values}
            )

    rows = docs.select(docs[language].cast("string").alias("lang"), docs[text].alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    sums = rows.mapInArrow(bundle, "lang string, dimension int, value bigint").groupBy("lang", "dimension").agg(F.sum("value").alias("value"))
    found = sorted((r[0], r[1], r[2]) for r in sums.collect())
    languages = sorted({r[0] for r in found})
    bundles = np.array([r[2] for r in found], np.float64).reshape(len(languages), dimensions)
    return Profiles(languages, bundles, seed)


def predicted(profiles: Profiles, text: Column | str) -> Column:
    """Struct of the predicted language and its cosine."""

    @F.arrow_udf("lang string, score double")
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in texts:
            names, scores = [], []
            for piece in pieces([pa.RecordBatch.from_arrays([array], ["text"])], most=TEXT_BYTES):
                some, cosines = profiles.predict(texts_of(piece))
                names += some
                scores.append(cosines)
            columns = [pa.array(names, pa.string()), pa.array(np.concatenate([*scores, np.zeros(0)]))]
            yield pa.StructArray.from_arrays(columns, ["lang", "score"])

    return predict(text)
