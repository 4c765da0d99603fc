"""Packing of token ids into sequences whose windows hold every source in its target proportion.

Deficit round-robin in closed form. Each source is a queue of its documents. A window of W tokens takes
from source s its share of W; the share is a fraction, so what a source is owed after w windows (its
deficit) is carried: up to window w it has given floor(C(s) * W * w / C) - floor(C(s-1) * W * w / C) tokens,
where C(s) sums the weights of the sources up to s. These quotas add up to W in every window, the carried
deficit stays under one token, and each position follows from sums of token counts alone, so every
partition computes its own pieces without seeing the others.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.batches import pieces, texts_of
from ledgerline.llm.encoder import encoder, with_end
from ledgerline.llm.tables import narrow, stored, type_of

SEQUENCE = 4096
#: Sequences in a window.
WINDOW = 16
#: Distinct words that a worker remembers while it encodes, beside what earlier stages left in it; more words cost time only.
MOST_WORDS = 200_000


@dataclass(frozen=True)
class Stretch:
    """Equal windows, or one window with quotas of its own: ``upto[s]`` are cumulative weights of the sources."""

    position: int
    windows: int
    window: int
    upto: tuple[int, ...]
    given: tuple[int, ...]

    def cumulative(self, rank: int, windows: int) -> int:
        """Tokens that the sources before ``rank`` give together in the first ``windows`` windows."""
        return self.upto[rank] * self.window * windows // self.upto[-1]

    def quota(self, rank: int, windows: int) -> int:
        return self.cumulative(rank + 1, windows) - self.cumulative(rank, windows)


def _stretch(position: int, windows: int, window: int, weights: list[int], given: list[int]) -> Stretch:
    upto = [0]
    for w in weights:
        upto.append(upto[-1] + w)
    return Stretch(position, windows, window, tuple(upto), tuple(given))


def schedule(totals: list[int], weights: list[int], window: int) -> list[Stretch]:
    """Stretches of windows until every source has given all its tokens.

    While all open sources can fill their quotas, windows are equal. In the window in which one runs
    out, it gives its rest and the others share the room by weight; then it leaves the round. There are
    at most two stretches per source.
    """
    left, given, position, out = list(totals), [0] * len(totals), 0, []
    while any(left):
        live = [w if rest else 0 for w, rest in zip(weights, left, strict=True)]
        if not any(live):  # the rest has no weight: by its size
            live = list(left)
        trial = _stretch(position, 0, window, live, given)
        low, high = 0, sum(left) // window
        while low < high:  # a source's cumulative quota only grows
            middle = (low + high + 1) // 2
            if all(trial.quota(s, middle) <= rest for s, rest in enumerate(left)):
                low = middle
            else:
                high = middle - 1
        if low:
            out.append(_stretch(position, low, window, live, given))
            taken = [trial.quota(s, low) for s in range(len(left))]
            position += low * window
        else:
            taken, room = [0] * len(left), min(window, sum(left))
            while room:
                rest = [a - b for a, b in zip(left, taken, strict=True)]
                open_ = [w if r else 0 for w, r in zip(live, rest, strict=True)]
                open_ = open_ if any(open_) else rest
                share = _stretch(0, 1, room, open_, taken)
                for s, r in enumerate(rest):
                    taken[s] += min(r, share.quota(s, 1))
                room = min(window, sum(left)) - sum(taken)
            out.append(_stretch(position, 1, sum(taken), taken, given))
            position += sum(taken)
        given = [a + b for a, b in zip(given, taken, strict=True)]
        left = [a - b for a, b in zip(left, taken, strict=True)]
    return out


def placed(stretches: list[Stretch], rank: int, start: int, stop: int) -> Iterator[tuple[int, int, int]]:
    """(offset in the source, length, position) of the runs that tokens ``start``..``stop`` of a source fall into."""
    for s in stretches:
        share = s.upto[rank + 1] - s.upto[rank]
        first, last = s.given[rank], s.given[rank] + s.quota(rank, s.windows)
        if not share or stop <= first or start >= last:
            continue
        at, end = max(start, first), min(stop, last)
        w = min(s.windows - 1, (at - first) * s.upto[-1] // (share * s.window))
        while s.quota(rank, w) > at - first:
            w -= 1
        while at < end:
            while s.quota(rank, w + 1) <= at - first:
                w += 1
            opened, closed = first + s.quota(rank, w), first + s.quota(rank, w + 1)
            before = s.cumulative(rank, w + 1) - s.cumulative(rank, w)
            n = min(end, closed) - at
            yield at, n, s.position + w * s.window + before + (at - opened)
            at += n


def encode_queues(docs: DataFrame, tokenizer: str, end: int, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Token ids of every whole text with ``end`` after it, and where each document starts in its task's part of its source.

    Stored once. The order of a queue is the order of the input's partitions.
    """
    rows = narrow(docs, key, text, source=source)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, given = TaskContext.get().partitionId(), {}
        for batch in pieces(batches):
            ids, counts = with_end(*encoder(tokenizer, MOST_WORDS).encode(texts_of(batch)), end)
            starts = np.zeros(batch.num_rows, np.int64)
            for i, (name, n) in enumerate(zip(batch.column("source").to_pylist(), counts.tolist(), strict=True)):
                starts[i] = given.get(name, 0)
                given[name] = int(starts[i]) + n
            offsets = np.concatenate([[0], np.cumsum(counts)]) * 4
            data = pa.BinaryArray.from_buffers(
                pa.binary(), batch.num_rows, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(ids.astype("<u4"))]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(batch.num_rows, part), pa.int32()),
                    batch.column("source"),
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(starts, pa.int64()),
                    data,
                ],
                ["part", "source", "doc_id", "n_tokens", "start_in_part", "ids"],
            )

    schema = f"part int, source {type_of(rows, 'source')}, doc_id {type_of(rows, 'doc_id')}, n_tokens bigint, start_in_part bigint, ids binary"
    return stored(rows.mapInArrow(encode, schema), "queues")


def pack(queues: DataFrame, mixture: Mapping[str | None, int] | None = None, sequence: int = SEQUENCE, window: int = WINDOW) -> DataFrame:
    """Pieces of the documents of ``encode_queues`` in sequences of ``sequence`` tokens.

    ``mixture`` has a whole-number weight per source; without it each source has its share of all
    tokens, and every window has the mixture of the corpus. Each id is in one piece. All sequences are full
    but the last one. A null source is a source of its own; an empty table has no pieces. What the
    driver gathers is one sum per source.
    """
    sums = queues.groupBy("part", "source").agg(F.sum("n_tokens").alias("n"))
    totals = sorted(((r[0], r[1]) for r in sums.groupBy("source").agg(F.sum("n")).collect()), key=lambda x: (x[0] is not None, str(x[0])))
    ranks = {name: i for i, (name, _) in enumerate(totals)}
    amounts = [n for _, n in totals]
    weights = amounts if mixture is None else [int(mixture.get(name, 0)) for name, _ in totals]
    stretches = schedule(amounts, weights, sequence * window)
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per part and source: stored, so that Spark knows its size before it plans the join with the ids.
    bases = sums.select(F.col("part").alias("of_part"), F.col("source").alias("of"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    rows = queues.join(stored(bases, "queue-bases"), (F.col("part") == F.col("of_part")) & F.col("source").eqNullSafe(F.col("of")))
    rows = rows.select("doc_id", "source", "n_tokens", (F.col("base") + F.col("start_in_part")).alias("start"), "ids")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        for batch in pieces(batches, "ids"):
            of, out = [], {n: [] for n in names}
            columns = (batch.column(c).to_pylist() for c in ("source", "n_tokens", "start", "ids"))
            for i, (source, n, start, ids) in enumerate(zip(*columns, strict=True)):
                for at, length, position in placed(stretches, ranks[source], start, start + n):
                    while length:
                        size = min(length, sequence - position % sequence)
                        begin = at - start
                        row = (begin, size, zlib.crc32(ids[4 * begin : 4 * (begin + size)]), n, position // sequence, position % sequence)
                        of.append(i)
                        for name, value in zip(names, row, strict=True):
                            out[name].append(value)
                        at, length, position = at + size, length - size, position + size
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(of, pa.int64())), *(pa.array(out[n], pa.int64()) for n in names)],
                ["doc_id", *names],
            )

    schema = f"doc_id {type_of(queues, 'doc_id')}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return rows.mapInArrow(cut, schema)
