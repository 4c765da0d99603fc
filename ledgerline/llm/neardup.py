"""SimHash near-duplicates by covering locality-sensitive hashing.

Each of the 64 bits gets a non-zero vector of r + 1 bits; table v (v non-zero) keeps the bits whose vector has
an odd product with v. The vectors of r differing bits leave some v orthogonal to all of them, so every pair
within radius r agrees on all bits that this table keeps: it collides, with certainty.

Distinct fingerprints are compared, not documents. A bucket that is too large for comparing inside a task
is dealt out again by covering masks of the bits it does not yet keep, which again loses no pair; after two
such steps at most seven bits are free, and no bucket can be large.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.batches import LOWER, pieces, texts_of
from ledgerline.llm.tables import narrow, only, stored, version

RADIUS = 3
BITS = 64
SHINGLE = 3
SEED = 42
#: Distinct fingerprints of a bucket that are compared in one task.
MOST_IN_BUCKET = 256
#: Times that masks are applied; after the last, seven bits or so are free.
LEVELS = 3


def digests(text: bytes, shingle: int) -> list[int]:
    """64-bit hashes of the shingles of a text's words, in order; a shorter text is one shingle, one without words has none."""
    found = text.translate(LOWER).split()
    if not found:
        return []
    joined = b" ".join(found)
    if len(found) < shingle:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(found) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    return [digest(joined[a:b], SEED) for a, b in spans]


def fingerprint(text: bytes) -> int:
    """64 bits, each set if it is set in over half the hashes of the shingles; zero without words."""
    hashes = digests(text, SHINGLE)
    if not hashes:
        return 0
    raw = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(raw), 1 << 14):  # keeps the unpacked bits of a long text small
        counts += np.unpackbits(raw[i : i + (1 << 14)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (a signed 64-bit number) and version of every row; a null text has fingerprint zero."""

    @F.arrow_udf("bigint")
    def hashed(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in texts:
            out = []
            for piece in pieces([pa.RecordBatch.from_arrays([array], ["text"])]):
                out += [fingerprint(t) for t in texts_of(piece)]
            yield pa.array(np.array(out, np.uint64).view(np.int64))

    return narrow(docs, key, text).select("doc_id", hashed("text").alias("fingerprint"), version(F.col("text")).alias("version"))


def covering(bits: list[int], radius: int) -> list[int]:
    """Masks of the bits that the 2 ** (radius + 1) - 1 tables keep, out of the given ones.

    A multiplicative step spreads neighbouring bits over the vectors.
    """
    vectors = (1 << radius + 1) - 1
    of = {bit: 1 + (i * 7) % vectors for i, bit in enumerate(bits)}
    return [sum(1 << b for b in bits if (of[b] & v).bit_count() % 2) for v in range(1, vectors + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def finer(masks: list[int], radius: int) -> dict[int, list[int]]:
    """Each mask with covering masks of the bits that it leaves free."""
    out = {}
    for mask in masks:
        free = [b for b in range(BITS) if not mask >> b & 1]
        out[mask] = sorted({mask | m for m in covering(free, radius)})
    return out


def linked(values: np.ndarray, buckets: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest that spans the same groups as all pairs of a bucket within the radius; rows are sorted by bucket."""
    left, right = np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = len(values)
    rest = np.arange(n)
    for shift in range(1, n):
        rest = rest[rest + shift < n]
        rest = rest[buckets[rest] == buckets[rest + shift]]
        if not len(rest):
            break
        near = rest[np.bitwise_count(values[rest] ^ values[rest + shift]) <= radius]
        left, right = np.concatenate([left, near]), np.concatenate([right, near + shift])
        if len(left) > 4 * n:
            left, right = spanned(left, right, n)
    return spanned(left, right, n) if len(left) > n else (left, right)


def spanned(left: np.ndarray, right: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each node that has a smaller one in its component, and the smallest one."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, label[left], least)
        np.minimum.at(label, label[right], least)
        label = label[label]
        if (label == before).all() and (label[left] == label[right]).all():
            break
    nodes = np.flatnonzero(label != np.arange(n))
    return nodes, label[nodes]


def _bucket_links(radius: int):
    """Links of rows (mask, kept, fingerprint) that arrive sorted by mask and kept bits."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((3, 0), np.int64)

        def links(rows: np.ndarray) -> pa.RecordBatch:
            change = (np.diff(rows[0], prepend=0) != 0) | (np.diff(rows[1], prepend=0) != 0)
            a, b = linked(rows[2].view(np.uint64), np.cumsum(change), radius)
            return pa.RecordBatch.from_arrays([pa.array(rows[2][a]), pa.array(rows[2][b])], ["a", "b"])

        for batch in batches:
            rows = np.concatenate([held, np.stack([batch.column(c).to_numpy() for c in ("mask", "kept", "fingerprint")])], axis=1)
            if not rows.shape[1]:
                continue
            # The last bucket may go on in the next batch; it has at most MOST_IN_BUCKET rows.
            last = (rows[0] == rows[0, -1]) & (rows[1] == rows[1, -1])
            held = rows[:, last]
            yield links(np.ascontiguousarray(rows[:, ~last]))
        yield links(np.ascontiguousarray(held))

    return link


def near_pairs(nodes: DataFrame, radius: int = RADIUS, most: int = MOST_IN_BUCKET) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that connect exactly those that pairs within the radius connect."""
    masks = covering(list(range(BITS)), radius)
    kept = nodes.select("fingerprint", F.explode(F.array(*(F.lit(_signed(m)) for m in masks))).alias("mask"))
    parts = []
    for level in range(LEVELS):
        keyed = kept.withColumn("kept", F.col("fingerprint").bitwiseAND(F.col("mask")))
        final = level == LEVELS - 1
        if not final:
            hot = stored(keyed.groupBy("mask", "kept").count().where(F.col("count") > most).drop("count"), "hot-buckets")
            final = hot.isEmpty()
        cold = keyed if final else keyed.join(hot, ["mask", "kept"], "left_anti")
        dealt = cold.select("mask", "kept", "fingerprint").repartition("mask", "kept").sortWithinPartitions("mask", "kept")
        parts.append(stored(dealt.mapInArrow(_bucket_links(radius), "a bigint, b bigint"), "links"))
        if final:
            break
        table = finer(masks, radius)
        choices = F.create_map(*(x for m, ms in table.items() for x in (F.lit(_signed(m)), F.array(*(F.lit(_signed(k)) for k in ms)))))
        again = keyed.join(hot, ["mask", "kept"], "left_semi")
        kept = again.select("fingerprint", F.explode(choices[F.col("mask")]).alias("mask"))
        masks = sorted({m for ms in table.values() for m in ms})
    pairs = parts[0]
    for part in parts[1:]:
        pairs = pairs.unionByName(part)
    return pairs


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) for every node of the pairs but the roots; a root is the smallest node of its component.

    Large and small stars alternate: each node hands its larger neighbours, then its smaller ones, to its smallest
    neighbour, until nothing changes. A star centre is grouped by a minimum only, never gathered.
    """

    def stars(edges: DataFrame, large: bool) -> DataFrame:
        pairs = edges if not large else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        joined = pairs.join(least, "u")
        if large:
            return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        moved = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 40)))).first())

    edges = stored(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    before = state(edges)
    while before[0]:
        edges = stored(stars(stars(edges, True), False), "edges")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def grouped(hashed: DataFrame, radius: int = RADIUS, most: int = MOST_IN_BUCKET) -> DataFrame:
    """(fingerprint, root, component_id) of every distinct fingerprint of rows (doc_id, fingerprint)."""
    nodes = stored(hashed.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(near_pairs(nodes, radius, most))
    rooted = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), "least"
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(named, "root").select("fingerprint", "root", "component_id")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, most: int = MOST_IN_BUCKET) -> DataFrame:
    """Every document with its fingerprint and component_id, the smallest doc_id that links reach.

    Rows may repeat; each is returned. Null ids count as no id: a component of null ids alone has a null component_id.
    """
    hashed = stored(fingerprints(docs, key, text), "fingerprints")
    of = grouped(hashed, radius, most).drop("root")
    return hashed.join(of, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def survivors(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, most: int = MOST_IN_BUCKET) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest id, null ids last."""
    hashed = stored(fingerprints(docs, key, text), "fingerprints")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("version"))
    best = hashed.join(grouped(hashed, radius, most), "fingerprint").groupBy("root").agg(F.min(rank).alias("best"))
    return only(docs, best.select("best.doc_id", "best.version"))
