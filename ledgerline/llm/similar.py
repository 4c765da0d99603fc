"""Near-duplicates by the Jaccard similarity of five-word shingles.

A text is its set of shingle hashes. The set's smallest hashes under many permutations are cut into bands; sets that agree
in a band are candidates (at similarity 0.8 all but some 3 in a million pairs do), and a link is a candidate whose exact
similarity reaches the threshold.

Equal sets are one. The sets of a bucket are first compared with its smallest; what this leaves in different
components is then compared with each other, so that a large group of near copies costs its size, not its square,
and every pair of a bucket is either compared or connected already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.batches import pieces, texts_of
from ledgerline.llm.neardup import components, digests
from ledgerline.llm.tables import narrow, only, stored, type_of, version

SHINGLE = 5
#: Least similarity of a link, as a fraction.
OVER, UNDER = 4, 5
BANDS, ROWS = 32, 5
#: Shingles whose permuted hashes are in memory at a time.
CHUNK = 1 << 11

_numbers = np.random.default_rng(42)
FACTORS, SHIFTS = _numbers.integers(0, 1 << 63, (2, BANDS * ROWS, 1), np.uint64) * np.uint64(2) + np.uint64(1)
MIX = _numbers.integers(0, 1 << 63, (BANDS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending."""
    return np.unique(np.array(digests(text, SHINGLE), "<u8"))


def bands(hashes: np.ndarray) -> np.ndarray:
    """A key per band of a set that is not empty."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), CHUNK):
        np.minimum(least, (hashes[i : i + CHUNK] * FACTORS + SHIFTS).min(axis=1), out=least)
    keys = (least.reshape(BANDS, ROWS) * MIX).sum(axis=1, dtype=np.uint64)
    return (keys ^ (keys >> np.uint64(29))) * MIX[:, 0]


def sketches(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, version, a number of the shingle set, its size and band keys of every row; a text without words has the empty set."""
    rows = narrow(docs, key, text).withColumn("version", version(F.col("text")))

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            sets = [shingles(t) for t in texts_of(piece)]
            keys = np.concatenate([bands(s) for s in sets if len(s)] or [np.zeros(0, np.uint64)])
            ends = np.concatenate([[0], np.cumsum([BANDS * (len(s) > 0) for s in sets])])
            numbers = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64)
            columns = {
                "doc_id": piece.column("doc_id"),
                "version": piece.column("version"),
                "same": pa.array(numbers.view(np.int64)),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "keys": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.view(np.int64))),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(sketched, f"doc_id {type_of(rows, 'doc_id')}, version bigint, same bigint, n bigint, keys array<bigint>")


def _arrays(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[np.ndarray]:
    for batch in batches:
        if batch.num_rows:
            yield np.stack([batch.column(c).to_numpy() for c in names])


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each set of a bucket but the first, with the first; rows (band, same, n) arrive sorted."""
    last = np.zeros((3, 0), np.int64)
    for rows in _arrays(batches, ["band", "same", "n"]):
        rows = np.concatenate([last, rows], axis=1)
        starts = np.flatnonzero(np.diff(rows[0], prepend=rows[0, 0] - 1) != 0)
        first = np.repeat(starts, np.diff(np.append(starts, rows.shape[1])))
        others = np.flatnonzero(first != np.arange(rows.shape[1]))
        # The first of the last bucket goes in front of the next batch; it makes no pair of its own.
        last = rows[:, starts[-1] :][:, :1]
        a, b = rows[:, first[others]], rows[:, others]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (b[0], a[1], b[1], a[2], b[2])], ["band", "a", "b", "n_a", "n_b"])


def _rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a bucket's sets in different components; rows (band, same, n, root) arrive sorted by bucket."""

    def pairs(bucket: np.ndarray) -> Iterator[pa.RecordBatch]:
        same, n, root = bucket[1:]
        groups, of, counts = np.unique(root, return_inverse=True, return_counts=True)
        if len(groups) < 2:
            return
        largest = of == counts.argmax()
        for i in np.flatnonzero(~largest):
            after = largest.copy()
            after[i + 1 :] = True
            j = np.flatnonzero(after & (root != root[i]) & (np.minimum(n, n[i]) * UNDER >= np.maximum(n, n[i]) * OVER))
            if len(j):
                other = np.full(len(j), same[i])
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(other, same[j])), pa.array(np.maximum(other, same[j]))], ["a", "b"])

    held: list[np.ndarray] = []
    for rows in _arrays(batches, ["band", "same", "n", "root"]):
        for part in np.split(rows, np.flatnonzero(np.diff(rows[0])) + 1, axis=1):
            if held and held[0][0, 0] != part[0, 0]:
                yield from pairs(np.concatenate(held, axis=1))
                held = []
            held.append(part)
    if held:
        yield from pairs(np.concatenate(held, axis=1))


def _confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """Stored: the pairs whose sets are as similar as the threshold asks; only the texts of pairs are read."""

    @F.arrow_udf("array<bigint>")
    def hashed(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in texts:
            out = []
            for piece in pieces([pa.RecordBatch.from_arrays([array], ["text"])]):
                out += [pa.array(shingles(t).view(np.int64)) for t in texts_of(piece)]
            ends = pa.array(np.concatenate([[0], np.cumsum([len(s) for s in out])]), pa.int32())
            yield pa.ListArray.from_arrays(ends, pa.concat_arrays(out) if out else pa.array([], pa.int64()))

    ids = pairs.select(F.explode(F.array("a", "b")).alias("same")).distinct()
    asked = stored(nodes.join(ids, "same", "left_semi").select("doc_id", "version", "same"), "compared")
    texts = narrow(docs, key, text).withColumn("version", version(F.col("text")))
    found = texts.join(asked.select(F.col("doc_id").alias("id"), F.col("version").alias("v"), "same"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("version") == F.col("v")))
    # Repeated rows have equal texts; one is enough.
    sets = stored(found.dropDuplicates(["same"]).select("same", hashed("text").alias("set")), "shingle-sets")
    with_b = pairs.join(sets.select(F.col("same").alias("b"), F.col("set").alias("set_b")), "b")
    both = with_b.join(sets.select(F.col("same").alias("a"), F.col("set").alias("set_a")), "a")
    common = F.size(F.array_intersect("set_a", "set_b"))
    similar = common * UNDER >= (F.size("set_a") + F.size("set_b") - common) * OVER
    return stored(both.where(similar).select("a", "b"), "similar-sets")


def _alike(n: str, m: str) -> Column:
    """Whether sets of such sizes can reach the threshold."""
    return F.least(n, m) * UNDER >= F.greatest(n, m) * OVER


def links(nodes: DataFrame, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pairs (a, b) of similar sets that connect what all similar pairs of a bucket connect."""
    rows = nodes.select(F.explode("keys").alias("band"), "same", "n")
    dealt = rows.repartition("band").sortWithinPartitions("band", "same")
    stars = stored(dealt.mapInArrow(_stars, "band bigint, a bigint, b bigint, n_a bigint, n_b bigint"), "stars")
    first = stored(stars.where(_alike("n_a", "n_b")).select("a", "b").distinct(), "candidates")
    found = _confirmed(first, nodes, docs, key, text)
    roots = components(found)
    members = stars.select("band", F.col("b").alias("same"), F.col("n_b").alias("n"))
    rooted = members.join(roots.withColumnRenamed("node", "same"), "same", "left").select("band", "same", "n", F.coalesce("root", "same").alias("root"))
    # The first of a bucket was compared with all others; those it is connected to still meet the rest.
    spread = rooted.repartition("band").sortWithinPartitions("band")
    second = stored(spread.mapInArrow(_rest, "a bigint, b bigint").distinct().join(first, ["a", "b"], "left_anti"), "candidates")
    return found if second.isEmpty() else found.unionByName(_confirmed(second, nodes, docs, key, text))


def survivors(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group that links connect, with all its columns: the one with the smallest id, null ids last."""
    hashed = stored(sketches(docs, key, text), "sketches")
    nodes = stored(hashed.dropDuplicates(["same"]), "distinct-sets")
    roots = components(links(nodes, docs, key, text))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("version"))
    least = hashed.groupBy("same").agg(F.min(rank).alias("best"))
    rooted = least.join(roots.withColumnRenamed("node", "same"), "same", "left")
    best = rooted.groupBy(F.coalesce("root", "same").alias("root")).agg(F.min("best").alias("best"))
    return only(docs, best.select("best.doc_id", "best.version"))
