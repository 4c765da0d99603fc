"""Hard negatives by blocks in Hilbert order with zone maps.

Vectors are turned into whole numbers, ordered along a Hilbert curve through all their dimensions, and written to
Parquet as blocks of neighbouring vectors; each block has the least and greatest value of every dimension. For an
anchor, interval arithmetic over these gives bounds of its inner products with a block. A block is read only for
anchors whose windows the bounds can meet, and segments of blocks that no anchor needs are not read at all.

Anchors are the query set and pass in waves of bounded size; each wave goes to all tasks, which keep the best rows per
window while blocks stream by, so a task returns a few rows per anchor, whatever it has read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.native import longs
from ledgerline.llm.tables import stored, with_place
from ledgerline.session import scratch_path

#: Parts of a unit, so that 256 * x is the whole number.
SCALE = 256
#: Whole numbers of this size and beyond: scores of them (times 100) would not fit 64 bits.
LIMIT = 1 << 22
#: Cells of a block, so many vectors as fit; blocks of a segment, which is one file.
BLOCK_CELLS = 1 << 15
SEGMENT_BLOCKS = 64
#: Bytes of anchors that are sent to the tasks at a time.
WAVE_BYTES = 4 << 20
#: Anchors that are scored against a block at a time, and neighbours on the curve that give a first bound.
SLICE = 512
NEIGHBOURS = 64
#: Bits of each dimension that the curve tells apart.
BITS = 4
NO_SCORE = np.iinfo(np.int64).min


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Position on the Hilbert curve of every row of ``cells`` (numbers below 2 ** bits), as bytes in that order.

    Works on all rows at once: from the highest bit down, each dimension's bit says whether the lower bits of the first
    dimension are mirrored or swapped with its own; a Gray code over the dimensions then gives the digits.
    """
    x = [column.astype(np.uint32) for column in cells.T]
    if not x:
        return [b""] * len(cells)
    for bit in range(bits - 1, 0, -1):
        low = np.uint32((1 << bit) - 1)
        for column in x:
            is_set = (column >> bit) & 1 == 1
            swap = np.where(is_set, np.uint32(0), (x[0] ^ column) & low)
            x[0] ^= np.where(is_set, low, np.uint32(0)) ^ swap
            if column is not x[0]:
                column ^= swap
    for before, column in zip(x, x[1:], strict=False):
        column ^= before
    flip = np.zeros(len(cells), np.uint32)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> bit) & 1 == 1, np.uint32((1 << bit) - 1), np.uint32(0))
    digits = [((column ^ flip) >> bit) & 1 for bit in range(bits - 1, -1, -1) for column in x]
    packed = np.packbits(np.stack(digits, axis=1).astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def whole_numbers(vector: Column) -> Column:
    """floor(256 * x) of each component."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("int"))


def candidates(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, v): rows with an id, a label and a vector of finite numbers, as whole numbers.

    Rows with a null in any of these, or a component of 16,384 or more in size, take no part. Of several rows with
    one id the first by label and vector counts.
    """
    named = rows.select(rows[key].cast("bigint").alias("vec_id"), rows[label].cast("bigint").alias("label"), rows[vector].alias("x"))
    usable = F.forall("x", lambda c: c.isNotNull() & (F.abs(c.cast("double")) < LIMIT // SCALE))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(usable, F.lit(False))
    whole = stored(named.where(usable).select("vec_id", "label", whole_numbers(F.col("x")).alias("v")), "vectors")
    # Only ids are shuffled to see whether any comes twice.
    twice = stored(whole.groupBy("vec_id").count().where("count > 1").select("vec_id"), "repeated-ids")
    if twice.isEmpty():
        return whole
    first = whole.join(twice, "vec_id", "left_semi").groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row"))
    return whole.join(twice, "vec_id", "left_anti").unionByName(first.select("vec_id", "row.label", "row.v"))


BLOCK_COLUMNS = "segment bigint, block bigint, n int, lo array<bigint>, hi array<bigint>, ids array<bigint>, labels array<bigint>, v binary"


@dataclass(frozen=True)
class Blocks:
    """Where the blocks lie, and what is the same for all: dimensions, and the type that scores are exact in."""

    path: str
    dims: int
    exact: str

    def read(self, spark, columns: list[str], segments: list[int] | None = None) -> DataFrame:
        blocks = spark.read.schema(BLOCK_COLUMNS).parquet(self.path)
        if segments is not None:
            blocks = blocks.where(F.col("segment").isin(segments) if segments else F.lit(False))
        return blocks.select(*columns)


def write_blocks(rows: DataFrame, block_cells: int = BLOCK_CELLS, segment_blocks: int = SEGMENT_BLOCKS) -> Blocks:
    """Blocks of rows (vec_id, label, v), in Hilbert order. Shorter vectors count as padded with zeros."""
    spark = rows.sparkSession
    rows = stored(rows, "candidates")
    sizes = rows.agg(F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    dims, low, high = sizes[0] or 0, min(sizes[1] or 0, 0), max(sizes[2] or 0, 0)
    span = high - low + 1
    most = max(abs(low), abs(high))
    exact = "float64" if most * most * max(dims, 1) < 1 << 53 else "int64"

    @F.arrow_udf("binary")
    def place(vectors: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in vectors:
            cells = (matrix(array, dims) - low) * (1 << BITS) // span
            yield pa.array(hilbert_keys(cells, BITS), pa.binary())

    height = max(1, block_cells // max(dims, 1))
    placed = rows.withColumn("place", place("v"))
    ordered = placed.repartitionByRange("place", "vec_id").sortWithinPartitions("place", "vec_id")
    path = scratch_path(spark, "hilbert-blocks")
    numbered = ordered.select("vec_id", "label", "v", F.spark_partition_id().cast("bigint").alias("part"))
    # A segment's blocks come one after another, so its folder gets one file.
    numbered.mapInArrow(_blocks(dims, height, segment_blocks), BLOCK_COLUMNS).write.partitionBy("segment").parquet(path)
    return Blocks(path, dims, exact)


def matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    """Vectors as rows of an int64 matrix, filled up with zeros."""
    lengths = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == dims).all():
        return values.astype(np.int64).reshape(len(lengths), dims)
    out = np.zeros((len(lengths), dims), np.int64)
    out[np.arange(dims) < lengths[:, None]] = values
    return out


def _blocks(dims: int, height: int, segment_blocks: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, done = None, 0

        def block(rows: tuple, part: int) -> pa.RecordBatch:
            order = np.argsort(rows[0])  # ties go to the smaller id, which then comes first
            ids, labels, v = (x[order] for x in rows)
            number = (part << 33) + done
            values = [(part << 33) + done // segment_blocks, number, len(ids), v.min(0).tolist(), v.max(0).tolist(), ids.tolist(), labels.tolist(), v.astype("<i4").tobytes()]
            names = [f.split()[0] for f in BLOCK_COLUMNS.split(", ")]
            types = [pa.int64(), pa.int64(), pa.int32(), *[pa.list_(pa.int64())] * 4, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, types, strict=True)], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            came = (batch.column("vec_id").to_numpy(), batch.column("label").to_numpy(), matrix(batch.column("v"), dims))
            held = came if held is None else tuple(np.concatenate(x) for x in zip(held, came, strict=True))
            while len(held[0]) >= height:
                yield block(tuple(x[:height] for x in held), part)
                done += 1
                held = tuple(x[height:] for x in held)
        if held is not None and len(held[0]):
            yield block(held, part)

    return cut


@dataclass
class Windows:
    """Search windows of a wave of anchors: which rows of which labels, between which scores.

    ``anchor``, ``label`` and ``v`` have a row per anchor, the others one per window: ``of`` is the window's anchor, ``window``
    a name. ``same`` tells whether rows of the anchor's label or of all others are wanted, and a row is
    wanted if 100 * score lies in [low, high]. ``least`` is a score that the k-th wanted row is known to reach.
    """

    anchor: np.ndarray
    label: np.ndarray
    v: np.ndarray
    of: np.ndarray
    window: np.ndarray
    low: np.ndarray
    high: np.ndarray
    least: np.ndarray
    same: bool
    k: int

    def needs(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Windows that a block with these bounds of its dimensions may have rows for."""
        positive, negative = np.maximum(self.v, 0), np.minimum(self.v, 0)
        above, below = (positive @ hi + negative @ lo)[self.of], (positive @ lo + negative @ hi)[self.of]
        return (100 * above >= self.low) & (above >= self.least) & (100 * below <= self.high)

    def best(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, v: np.ndarray, exact: str) -> tuple[np.ndarray, np.ndarray]:
        """The first k wanted of the given vectors (ascending by id) for some windows: scores and ids, NO_SCORE where there are none."""
        n, k = len(ids), self.k
        anchors, at = np.unique(self.of[rows], return_inverse=True)
        scores = products(self.v[anchors], v, exact)[at]
        wanted = (labels == self.label[anchors][at][:, None]) == self.same
        wanted &= (ids != self.anchor[anchors][at][:, None]) & (100 * scores >= self.low[rows][:, None]) & (100 * scores <= self.high[rows][:, None])
        if n <= k:
            place = np.broadcast_to(np.arange(n), scores.shape)
        else:
            # Distinct numbers in the wanted order: higher scores first, then smaller ids.
            ranks = np.where(wanted, scores * n + (n - 1 - np.arange(n)), NO_SCORE)
            place = np.argpartition(ranks, n - k, axis=1)[:, n - k :]
        found = np.where(np.take_along_axis(wanted, place, 1), np.take_along_axis(scores, place, 1), NO_SCORE)
        return found, ids[place]


def products(v: np.ndarray, block: np.ndarray, exact: str) -> np.ndarray:
    return (v.astype(exact) @ block.astype(exact).T).astype(np.int64)


FOUND = "anchor bigint, window bigint, id bigint, score bigint"


def _search(windows: Windows, exact: str):
    """Reads blocks and keeps, per window, the first k rows so far; what they reach raises the bar for later blocks."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, k = len(windows.of), windows.k
        scores, ids = np.full((n, k), NO_SCORE), np.zeros((n, k), np.int64)
        mine = replace(windows, least=windows.least.copy())
        for batch in batches:
            for b in range(batch.num_rows):
                lo, hi, theirs, labels = (batch.column(c)[b].values.to_numpy() for c in ("lo", "hi", "ids", "labels"))
                block = np.frombuffer(batch.column("v")[b].as_py(), "<i4").reshape(len(theirs), len(lo))
                needed = np.flatnonzero(mine.needs(lo, hi))
                for i in range(0, len(needed), SLICE):
                    rows = needed[i : i + SLICE]
                    found, of = mine.best(rows, theirs, labels, block, exact)
                    scores[rows], ids[rows] = merged(scores[rows], ids[rows], found, of, k)
                    mine.least[rows] = np.maximum(mine.least[rows], scores[rows, -1])
        at = np.nonzero(scores != NO_SCORE)
        columns = [mine.anchor[mine.of[at[0]]], mine.window[at[0]], ids[at], scores[at]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "window", "id", "score"])

    return search


def merged(scores: np.ndarray, ids: np.ndarray, more: np.ndarray, of: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first k of both, by score and then id, in that order."""
    scores, ids = np.concatenate([scores, more], axis=1), np.concatenate([ids, of], axis=1)
    order = np.lexsort((ids, -np.maximum(scores, -(1 << 62))), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def seeded(windows: Windows, exact: str) -> Windows:
    """``windows`` with a first bound from the anchors near theirs in the wave, which are rows like any other."""
    for i in range(0, len(windows.of), SLICE):
        rows = np.arange(i, min(i + SLICE, len(windows.of)))
        # Windows are ordered as the anchors are.
        near = slice(max(0, windows.of[rows[0]] - NEIGHBOURS), windows.of[rows[-1]] + NEIGHBOURS)
        order = np.argsort(windows.anchor[near])
        found, _ = windows.best(rows, windows.anchor[near][order], windows.label[near][order], windows.v[near][order], exact)
        if found.shape[1] == windows.k:
            windows.least[rows] = np.maximum(windows.least[rows], found.min(axis=1))
    return windows


def searched(spark, blocks: Blocks, windows: Windows) -> DataFrame:
    """(anchor, window, id, score, place): the first k rows of every window, place from 1."""
    wave = spark.sparkContext.broadcast(windows)
    exact = blocks.exact

    def meets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            zones = zip(*(batch.column(c).to_pylist() for c in ("segment", "lo", "hi")), strict=True)
            met = {s for s, lo, hi in zones if wave.value.needs(np.array(lo), np.array(hi)).any()}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(met), pa.int64())], ["segment"])

    # One number per file at most, of which the driver has a list already.
    segments = [r[0] for r in blocks.read(spark, ["segment", "lo", "hi"]).mapInArrow(meets, "segment bigint").distinct().collect()]
    chosen = blocks.read(spark, ["lo", "hi", "ids", "labels", "v"], segments)
    found = chosen.mapInArrow(lambda batches: _search(wave.value, exact)(batches), FOUND)
    first = Window.partitionBy("anchor", "window").orderBy(F.col("score").desc(), "id")
    return found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= windows.k)


def mined(
    rows: DataFrame,
    is_anchor: Callable[[Column], Column],
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 5,
    least_percent: int = 80,
    block_cells: int = BLOCK_CELLS,
    segment_blocks: int = SEGMENT_BLOCKS,
    wave_bytes: int = WAVE_BYTES,
) -> DataFrame:
    """Per anchor and positive, the first negatives whose score is between ``least_percent`` per cent of the positive's and the positive's.

    Scores are inner products of whole numbers; ties go to the smaller vec_id. See ``candidates`` for rows that take no
    part. A positive with a negative score has no window, one with score zero has the score zero as its window. Returns anchor_id,
    positive_id, rank, negative_id, positive_score and negative_score.
    """
    spark = rows.sparkSession
    blocks = write_blocks(candidates(rows, key, vector, label), block_cells, segment_blocks)
    every = max(1, wave_bytes // (8 * max(blocks.dims, 1)))
    # Anchors in the order of the blocks, so that neighbours need the same ones.
    own = blocks.read(spark, ["block", "ids", "labels", "v"]).mapInArrow(_unpacked(blocks.dims), "block bigint, vec_id bigint, label bigint, v array<int>")
    ordered = own.where(is_anchor(F.col("vec_id"))).repartitionByRange("block", "vec_id").sortWithinPartitions("block", "vec_id")
    placed = with_place(ordered).withColumn("wave", F.floor(F.col("place") / every).cast("bigint"))
    waves, path = scratch_path(spark, "anchors"), scratch_path(spark, "hard-negatives")
    placed.repartition("wave").write.partitionBy("wave").parquet(waves)
    wanted = spark.read.schema("block bigint, vec_id bigint, label bigint, v array<int>, place bigint, wave bigint").parquet(waves)
    n = wanted.agg(F.max("wave")).first()[0]
    if n is None:
        return spark.createDataFrame([], MINED)
    for i in range(n + 1):
        table = wanted.where(F.col("wave") == i).toArrow().sort_by("place").combine_chunks()
        _one_wave(spark, blocks, table, positives, negatives, least_percent).write.parquet(f"{path}/{i}")
    return spark.read.schema(MINED).parquet(*(f"{path}/{i}" for i in range(n + 1)))


MINED = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def _unpacked(dims: int):
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in range(batch.num_rows):
                ids, labels = (batch.column(c)[b].values for c in ("ids", "labels"))
                v = np.frombuffer(batch.column("v")[b].as_py(), "<i4")
                vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * dims, pa.int32()), pa.array(v))
                block = pa.array(np.full(len(ids), batch.column("block")[b].as_py()))
                yield pa.RecordBatch.from_arrays([block, ids, labels, vectors], ["block", "vec_id", "label", "v"])

    return unpack


def _one_wave(spark, blocks: Blocks, table: pa.Table, positives: int, negatives: int, least_percent: int) -> DataFrame:
    anchors, labels = (table.column(c).to_numpy() for c in ("vec_id", "label"))
    v = matrix(table.column("v").chunk(0), blocks.dims)
    n = len(anchors)
    every = np.full(n, np.iinfo(np.int64).max)
    wave = Windows(anchors, labels, v, np.arange(n), np.zeros(n, np.int64), -every, every, np.full(n, NO_SCORE), True, positives)
    found = searched(spark, blocks, seeded(wave, blocks.exact)).where("score >= 0").toArrow()
    # At most ``positives`` rows per anchor of the wave.
    of = {int(a): i for i, a in enumerate(anchors)}
    chosen = sorted((of[a], p, s, i) for a, p, s, i in zip(*(found.column(c).to_pylist() for c in ("anchor", "place", "score", "id")), strict=True))
    at, scores, ids = (np.array([c[j] for c in chosen], np.int64) for j in (0, 2, 3))
    windows = Windows(anchors, labels, v, at, ids, least_percent * scores, 100 * scores, np.full(len(at), NO_SCORE), False, negatives)
    hard = searched(spark, blocks, seeded(windows, blocks.exact))
    known = spark.createDataFrame(pa.table({"anchor": anchors[at], "window": ids, "positive_score": scores}), "anchor bigint, window bigint, positive_score bigint")
    return hard.join(F.broadcast(known), ["anchor", "window"]).select(
        F.col("anchor").alias("anchor_id"),
        F.col("window").alias("positive_id"),
        F.col("place").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def mislabelled(rows: DataFrame, key: str = "vec_id", label: str = "label") -> DataFrame:
    """Rows whose label is moved on by one, modulo ten, where the id is divisible by seven."""
    return rows.withColumn(label, F.when(rows[key] % 7 == 0, (rows[label] + 1) % 10).otherwise(rows[label]))


def every_hundredth(vec_id: Column) -> Column:
    return vec_id % 100 == longs(0)
