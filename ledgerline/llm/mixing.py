"""Language-model scores by online logistic context mixing over the bits of a word stream.

A text is a sequence of tokens (lower-cased words, then one end). A token is coded as a class of six bits, a
hash of its ending, and as a member of its class. Each bit is predicted by several contexts: counters
of the training texts by (a) the bits before it, (b) the class of the token before,
(c) the two classes before, (d) the word before itself, whatever their number; and (e) an adaptive counter of the text itself. A mixer adds the
predictions in the logistic domain; its weights are chosen by a gate (the bit's place) and follow every bit of
the text online. An adaptive table refines what the mixer says. The member is coded by
its count within its class, where one further member stands for all unknown words.

Words are numbered within segments of some megabytes of text. Only a segment's distinct words meet
the counts of the corpus, and the classes that follow it there, so a word that is everywhere costs one row per segment.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerline.llm.batches import LOWER, pieces, texts_of
from ledgerline.llm.tables import narrow, stored, type_of

CLASS_BITS = 6
CLASSES = 1 << CLASS_BITS
#: Where the counters of each context of classes begin, in slots of one bit's node.
BEGINS = np.cumsum([0, CLASSES, CLASSES**2])
SLOTS = int(BEGINS[2]) + CLASSES**3
#: Words whose counters are worked out at a time.
WORDS_AT_ONCE = 1 << 14
#: Text bytes of a segment at most; a longer text is a segment of its own.
SEGMENT_BYTES = 24 << 20

RATE, LOCAL_RATE, TABLE_RATE = 0.02, 0.05, 0.02
STEPS = 9
LEAST = 1e-4


def code_of(word: bytes) -> int:
    """Class of a word."""
    return zlib.crc32(word[-3:]) % CLASSES


def nodes_of(classes: np.ndarray) -> np.ndarray:
    """For each of a class's bits, the bits before it, as a node of a binary tree."""
    return np.stack([(1 << i) + (classes >> (CLASS_BITS - i)) for i in range(CLASS_BITS)], axis=-1)


def bits_of(classes: np.ndarray) -> np.ndarray:
    return np.stack([classes >> (CLASS_BITS - 1 - i) & 1 for i in range(CLASS_BITS)], axis=-1)


def slots_of(before: np.ndarray, second: np.ndarray) -> np.ndarray:
    """First counter of each context of classes: nothing, the class before, two classes."""
    zero = np.zeros_like(before)
    return np.stack([zero + BEGINS[0], BEGINS[1] + before * CLASSES, BEGINS[2] + (second * CLASSES + before) * CLASSES], axis=-1)


def packed(values: np.ndarray, ends: np.ndarray) -> pa.BinaryArray:
    """Lists of numbers (``ends`` has where each list begins and ends) as bytes: seven bits a byte, lowest first, the last below 128."""
    sizes = 1 + np.sum([values >> (7 * k) > 0 for k in range(1, 9)], axis=0, dtype=np.int64) if len(values) else np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    raw = np.zeros(int(starts[-1]), np.uint8)
    for k in range(int(sizes.max(initial=0))):
        at = np.flatnonzero(sizes > k)
        raw[starts[at] + k] = (values[at] >> (7 * k) & 127) | np.where(sizes[at] > k + 1, 128, 0)
    offsets = pa.py_buffer(starts[ends].astype(np.int32))
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, offsets, pa.py_buffer(raw)])


def unpacked(lists: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of packed lists one after another, and the list of each."""
    offsets = np.frombuffer(lists.buffers()[1], np.int32)[lists.offset : lists.offset + len(lists) + 1] if len(lists) else np.zeros(1, np.int32)
    raw = np.frombuffer(lists.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(lists) else np.zeros(0, np.uint8)
    lasts = np.flatnonzero(raw < 128)
    starts = np.concatenate([[0], lasts[:-1] + 1]) if len(lasts) else np.zeros(0, np.int64)
    place = np.arange(len(raw)) - np.repeat(starts, lasts + 1 - starts)
    values = np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), starts) if len(lasts) else np.zeros(0, np.int64)
    return values, np.searchsorted(offsets[1:] - offsets[0], starts, "right")


def following(lists: pa.BinaryArray) -> np.ndarray:
    """Log-odds of the bits after each word, by node, from its packed (count, class) pairs; in front a row of a word without any."""
    out = np.zeros((len(lists) + 1, CLASSES), np.float32)
    for begin in range(0, len(lists), WORDS_AT_ONCE):
        part = lists.slice(begin, WORDS_AT_ONCE)
        values, owner = unpacked(part)
        counts = np.bincount(owner * CLASSES + values % CLASSES, values >> CLASS_BITS, len(part) * CLASSES)
        for i in range(CLASS_BITS):
            seen = counts.reshape(len(part), 2 << i, -1).sum(axis=2) + 0.4
            out[begin + 1 : begin + 1 + len(part), 1 << i : 2 << i] = np.log(seen[:, 1::2] / seen[:, ::2])
    return out


def _previous(codes: np.ndarray, firsts: np.ndarray, back: int) -> np.ndarray:
    """Codes ``back`` tokens earlier in the same text; 0 before its start."""
    out = np.concatenate([np.zeros(back, codes.dtype), codes[:-back]])[: len(codes)]
    for i in range(back):
        at = firsts + i
        out[at[at < len(out)]] = 0
    return out


def held_out(doc_id: object, folds: int, fold: int) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == fold


def segments(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 7, fold: int = 2) -> DataFrame:
    """Stored: rows of segments' words (with their training counts, and the classes after them, packed as count * CLASSES + class), of their documents, and of the tasks' bit counters.

    A null text is empty: an end alone. The documents whose crc32(key) mod ``folds`` is ``fold`` are held out; a null key counts as
    an empty text.
    """
    rows = narrow(docs, key, text)
    documents = f"array<struct<doc_id:{type_of(rows, 'doc_id')},held_out:boolean,n_tokens:bigint,n_bytes:bigint>>"
    fields = [("doc_id", to_arrow_type(rows.schema["doc_id"].dataType)), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64())]
    types = {
        "kind": pa.string(), "segment": pa.int64(), "number": pa.int64(), "term": pa.binary(), "code": pa.int32(), "n": pa.int64(),
        "n1": pa.int64(), "next": pa.binary(), "documents": pa.list_(pa.struct(fields)), "tokens": pa.binary(), "codes": pa.binary(),
    }

    def rows_of(kind: str, size: int, **columns: pa.Array) -> pa.RecordBatch:
        out = {c: columns.get(c, pa.nulls(size, t)) for c, t in types.items()}
        return pa.RecordBatch.from_pydict(out | {"kind": pa.array([kind] * size, pa.string())})

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, counters, open_ = TaskContext.get().partitionId() << 32, np.zeros((2, SLOTS), np.int64), Segment()
        for batch in pieces(batches):
            size = int(pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0)
            if open_.n_bytes and open_.n_bytes + size > SEGMENT_BYTES:
                yield from closed(open_, number)
                number, open_ = number + 1, Segment()
            out = np.array([held_out(d, folds, fold) for d in batch.column("doc_id").to_pylist()])
            open_.add(batch.column("doc_id"), texts_of(batch), out, counters)
        if open_.lengths:
            yield from closed(open_, number)
        used = np.flatnonzero(counters.sum(axis=0))
        if len(used):
            yield rows_of("counter", len(used), number=pa.array(used), n=pa.array(counters[0, used]), n1=pa.array(counters[1, used]))

    def closed(part: Segment, number: int) -> Iterator[pa.RecordBatch]:
        lengths, out, tokens = np.concatenate(part.lengths), np.concatenate(part.out), np.concatenate(part.tokens)
        counts = np.bincount(tokens[np.repeat(~out, lengths)], minlength=len(part.numbers))
        same = pa.array(np.full(len(counts), number), pa.int64())
        columns = [pa.concat_arrays(part.ids), pa.array(out, pa.bool_()), pa.array(lengths), pa.array(np.concatenate(part.sizes))]
        directory = pa.StructArray.from_arrays(columns, names=[name for name, _ in fields])
        yield rows_of(
            "documents",
            1,
            segment=same[:1],
            documents=pa.ListArray.from_arrays(pa.array([0, len(lengths)], pa.int32()), directory),
            tokens=pa.array([tokens.astype("<u4").tobytes()], pa.binary()),
            codes=pa.array([np.array(part.codes, "<u4").tobytes()], pa.binary()),
        )
        # The end of a text is also what stands before its first word.
        before = np.concatenate([[0], tokens[:-1]])
        before[np.cumsum(lengths) - lengths] = part.numbers[b""]
        trained = np.repeat(~out, lengths)
        pairs, n = np.unique(before[trained].astype(np.int64) * CLASSES + np.array(part.codes)[tokens[trained]], return_counts=True)
        ends = np.searchsorted(pairs, np.arange(len(counts) + 1) * CLASSES)
        after = packed(n.astype(np.int64) << CLASS_BITS | pairs % CLASSES, ends)
        words = {"next": after, "term": pa.array(list(part.numbers), pa.binary()), "code": pa.array(part.codes, pa.int32()), "n": pa.array(counts, pa.int64())}
        yield rows_of("word", len(counts), segment=same, number=pa.array(np.arange(len(counts))), **words)

    schema = f"kind string, segment bigint, number bigint, term binary, code int, n bigint, n1 bigint, next binary, documents {documents}, tokens binary, codes binary"
    return stored(rows.mapInArrow(build, schema), "lm-segments")


class Segment:
    """Documents of a segment as numbers of its words."""

    def __init__(self) -> None:
        self.numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.codes: list[int] = []
        self.ids, self.lengths, self.sizes, self.out, self.tokens, self.n_bytes = [], [], [], [], [], 0

    def add(self, ids: pa.Array, texts: list[bytes], out: np.ndarray, counters: np.ndarray) -> None:
        """Append documents, and count the bits of those that are not held out."""
        words = [[*t.translate(LOWER).split(), b""] for t in texts]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        known = len(self.numbers)
        tokens = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(words)), np.int32, int(lengths.sum()))
        self.codes += map(code_of, islice(self.numbers, known, None))
        self.ids.append(ids)
        for held, new in ((self.lengths, lengths), (self.sizes, sizes), (self.out, out), (self.tokens, tokens)):
            held.append(new)
        self.n_bytes += int(sizes.sum())
        coded = np.array(self.codes, np.int64)[tokens]
        firsts = np.cumsum(lengths) - lengths
        before, second = _previous(coded, firsts, 1), _previous(coded, firsts, 2)
        trained = np.repeat(~out, lengths)
        for i in range(0, len(tokens), 1 << 18):  # bounds the slots in memory
            use = trained[i : i + (1 << 18)]
            now, last, last2 = (x[i : i + (1 << 18)][use] for x in (coded, before, second))
            context = slots_of(last, last2)
            nodes, bits = nodes_of(now), bits_of(now)
            for c in range(context.shape[1]):
                at = context[:, c, None] + nodes
                first, stop = int(BEGINS[c]), int(BEGINS[c + 1]) if c + 1 < len(BEGINS) else SLOTS
                both = np.bincount(((at - first) * 2 + bits).ravel(), minlength=2 * (stop - first)).reshape(-1, 2)
                counters[:, first:stop] += both.T


@dataclass(frozen=True)
class Model:
    """What every text is scored with, besides the counts and counters of its segment's words: one number per context of classes.

    ``stretched`` has the log-odds of each counter, ``members`` the tokens and distinct words of each class in training.
    """

    stretched: np.ndarray
    members: np.ndarray
    tokens: int
    words: int

    def class_scores(self, codes: np.ndarray, lengths: np.ndarray, rows: np.ndarray | None = None, after: np.ndarray | None = None) -> np.ndarray:
        """Log10 probability of the classes of each text's tokens; every text starts from the same mixer.

        ``rows`` has each token's row in ``after``, the log-odds that ``following`` gives; without them no word is known.

        Texts advance side by side, a token at a time, so that a step is a few operations on arrays. The six bits of a token use
        weights and table rows of their own, and can be taken together.
        """
        n = len(lengths)
        order = np.argsort(-lengths, kind="stable")
        sizes, firsts = lengths[order], (np.cumsum(lengths) - lengths)[order]
        alive = np.searchsorted(-sizes, -np.arange(1, int(sizes[0]) + 1 if n else 1), "right")
        total, fixed = np.zeros(n), len(BEGINS)
        if rows is None or after is None:
            rows, after = np.zeros(len(codes), np.int64), np.zeros((1, CLASSES), np.float32)
        word = rows[firsts + lengths[order] - 1]
        weights = np.full((n, CLASS_BITS, fixed + 3), 0.3, np.float32)
        x = np.ones((n, CLASS_BITS, fixed + 3), np.float32)
        local = np.full(n * CLASSES, 0.5, np.float32)
        centres = np.arange(STEPS, dtype=np.float32) - STEPS // 2
        table = np.tile((1 / (1 + np.exp(-centres))).astype(np.float32), n * CLASS_BITS)
        own_rows = (np.arange(n) * CLASSES)[:, None]
        table_rows = (np.arange(n) * CLASS_BITS)[:, None] * STEPS + np.arange(CLASS_BITS) * STEPS + STEPS // 2
        nodes_by, bits_by = nodes_of(np.arange(CLASSES)), bits_of(np.arange(CLASSES)).astype(np.float32)
        before, second = np.zeros(n, np.int64), np.zeros(n, np.int64)
        one, edge, least, most = np.float32(1), np.float32(STEPS // 2), np.float32(LEAST), np.float32(1 - LEAST)
        rate, local_rate, table_rate = np.float32(RATE), np.float32(LOCAL_RATE), np.float32(TABLE_RATE)
        for step, k in enumerate(alive.tolist()):
            classes = codes[firsts[:k] + step] % CLASSES
            nodes, bits = nodes_by[classes], bits_by[classes]
            inputs, w = x[:k], weights[:k]
            last = before[:k]
            context = slots_of(last, second[:k])
            inputs[:, :, :fixed] = self.stretched.take(context[:, None, :] + nodes[:, :, None])
            at_own = own_rows[:k] + nodes
            own = local.take(at_own)
            inputs[:, :, fixed] = np.log(own / (one - own))
            inputs[:, :, fixed + 1] = after.take(word[:k, None] * CLASSES + nodes)
            dot = np.einsum("kbi,kbi->kb", w, inputs)
            mixed = np.minimum(np.maximum(one / (one + np.exp(-dot)), least), most)
            at_table = table_rows[:k] + np.rint(np.minimum(np.maximum(dot, -edge), edge)).astype(np.int64)
            refined = table.take(at_table)
            p = (mixed + refined) * np.float32(0.5)
            total[:k] += np.log10(np.where(bits > 0, p, one - p).astype(np.float64).prod(axis=1))
            w += (rate * (bits - mixed))[:, :, None] * inputs
            local[at_own] = np.minimum(np.maximum(own + local_rate * (bits - own), np.float32(0.01)), np.float32(0.99))
            table[at_table] = refined + table_rate * (bits - refined)
            second[:k], before[:k], word[:k] = last, classes, rows[firsts[:k] + step]
        out = np.zeros(n)
        out[order] = total
        return out

    def score(self, tokens: np.ndarray, counts: np.ndarray, codes: np.ndarray, lengths: np.ndarray, rows: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, ...]:
        """Known tokens, base score and score of each text, given the counts, codes and rows of the segment's words."""
        owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        sums = lambda values: np.bincount(owner, values[tokens], minlength=len(lengths))
        base = sums(np.log10((counts + 1) / (self.tokens + self.words + 1)))
        members = sums(np.log10((counts + 1) / (self.members[codes] + 1)))
        known = sums(counts > 0).astype(np.int64)
        return known, base, members + self.class_scores(codes[tokens], lengths, rows[tokens], after)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of words known in training, with what their words have in the whole corpus; rows arrive sorted by term."""

    def begins(rows: pa.RecordBatch) -> np.ndarray:
        term = rows.column("term")
        return np.concatenate([[True], pc.not_equal(term.slice(1), term.slice(0, len(term) - 1)).to_numpy(zero_copy_only=False)])

    def counted(rows: pa.RecordBatch) -> pa.RecordBatch:
        first = begins(rows)
        of, starts, lists = np.cumsum(first) - 1, np.flatnonzero(first), rows.column("next")
        c = np.add.reduceat(rows.column("n").to_numpy(), starts)
        values, owner = unpacked(lists)
        owner = of[owner]
        pairs, at = np.unique(owner * CLASSES + values % CLASSES, return_inverse=True)
        sums = np.bincount(at, values >> CLASS_BITS, len(pairs)).astype(np.int64)
        ends = np.searchsorted(pairs, np.arange(len(starts) + 1) * CLASSES)
        totals = packed(sums << CLASS_BITS | pairs % CLASSES, ends)
        known = np.flatnonzero(c[of] > 0)
        kept = rows.select(["segment", "number", "code"]).take(pa.array(known))
        more = {"c": pa.array(c[of[known]]), "first": pa.array(first[known]), "next": totals.take(pa.array(of[known]))}
        return pa.RecordBatch.from_pydict({**dict(zip(kept.schema.names, kept.columns, strict=True)), **more})

    held = None
    for batch in batches:
        rows = batch if held is None else pa.concat_batches([held, batch])
        if not rows.num_rows:
            continue
        # The last term may go on in the next batch; it has a row per segment at most.
        stop = int(np.flatnonzero(begins(rows))[-1])
        if stop:
            yield counted(rows.slice(0, stop))
        held = rows.slice(stop)
    if held is not None:
        yield counted(held)


def known_words(parts: DataFrame) -> DataFrame:
    """Stored: rows (segment, number, code, c, first, next) of all words that training has; one row of each word is its first.

    One shuffle of the segments' words gives each its count in the corpus and those of the classes after it.
    """
    words = parts.where("kind = 'word'").select("term", "segment", "number", "code", "n", "next")
    dealt = words.repartition("term").sortWithinPartitions("term", F.desc("n"), "segment")
    return stored(dealt.mapInArrow(_totals, "segment bigint, number bigint, code int, c bigint, first boolean, next binary"), "lm-words")


def train(parts: DataFrame, known: DataFrame) -> Model:
    """Counters of all training texts and the sizes of the classes; the driver gets at most SLOTS and CLASSES rows."""
    slots = parts.where("kind = 'counter'").groupBy("number").agg(F.sum("n").alias("n0"), F.sum("n1").alias("n1")).toPandas()
    seen = np.full((2, SLOTS), 0.4)
    seen[0, slots["number"]] += slots["n0"]
    seen[1, slots["number"]] += slots["n1"]
    firsts = known.where("first").groupBy(F.col("code").alias("class"))
    per_class = firsts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    members = np.zeros(CLASSES)
    for r in per_class:
        members[r["class"]] = r["n"] + r["v"]
    return Model(np.log(seen[1] / seen[0]).astype(np.float32), members, sum(r["n"] for r in per_class), sum(r["v"] for r in per_class))


def _scorer(sent: Broadcast) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def score(documents: pa.Table, known: pa.Table) -> pa.Table:
        model = sent.value
        codes = np.frombuffer(documents.column("codes")[0].as_py(), "<u4").astype(np.int64)
        counts = np.zeros(len(codes), np.int64)
        counts[known.column("number").to_numpy()] = known.column("c").to_numpy()
        tokens = np.frombuffer(documents.column("tokens")[0].as_py(), "<u4").astype(np.int32)
        listed = documents.column("documents").combine_chunks().values
        lengths, n_bytes = listed.field("n_tokens").to_numpy(), listed.field("n_bytes").to_numpy()
        rows = np.zeros(len(codes), np.int64)
        rows[known.column("number").to_numpy()] = np.arange(1, known.num_rows + 1)
        after = following(known.column("next").combine_chunks())
        n_known, base, total = model.score(tokens, counts, codes, lengths, rows, after)
        return pa.table(
            {
                "doc_id": listed.field("doc_id"),
                "held_out": listed.field("held_out"),
                "n_tokens": lengths,
                "n_known": n_known,
                "train_tokens": np.full(len(lengths), model.tokens, np.int64),
                "base_score": base,
                "score": total,
                "bits_per_byte": -total * math.log2(10) / np.maximum(1, n_bytes),
            }
        )

    return score


def scores(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 7, fold: int = 2) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10), bits_per_byte.

    Rows may repeat, each is scored. Without training documents every token is unknown.
    """
    parts = segments(docs, key, text, folds, fold)
    known = known_words(parts)
    sent = docs.sparkSession.sparkContext.broadcast(train(parts, known))
    documents = parts.where("kind = 'documents'").select("segment", "documents", "tokens", "codes")
    schema = f"doc_id {type_of(docs, key)}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, bits_per_byte double"
    both = documents.groupBy("segment").cogroup(known.select("segment", "number", "c", "next").groupBy("segment"))
    return both.applyInArrow(_scorer(sent), schema)
