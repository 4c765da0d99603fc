"""Benchmark decontamination with a distributed positional inverted index.

The corpus is indexed in segments of a few megabytes of text. A segment stores, for each of its terms, the
positions of the term (postings), and one directory row with its documents. A search reads the postings of
the test items' terms, brings each segment's together, and intersects a window's lists from the rarest
term on, every list shifted by the term's offset in the window.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerline.llm.batches import LOWER, pieces, ragged, texts_of
from ledgerline.llm.tables import narrow, stored, type_of

WINDOW = 10
#: Positions left free between two documents of a segment; no window or tolerance may reach across.
GAP = 64
#: Bytes of item texts that are searched in one pass; more items take more passes.
BLOCK_BYTES = 8 << 20

WORDS = bytes(c if chr(c) in "0123456789abcdefghijklmnopqrstuvwxyz" or c >= 128 else 32 for c in LOWER)


def terms_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and all characters beyond ASCII."""
    return text.translate(WORDS).split()


def pack_numbers(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers of up to 35 bits as bytes, seven bits each, and the end of each number."""
    sizes = 1 + sum((values >= 1 << s).astype(np.int64) for s in (7, 14, 21, 28))
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(int(sizes.max(initial=0))):
        some = np.flatnonzero(sizes > k)
        more = np.where(sizes[some] > k + 1, 0x80, 0)
        out[ends[some] - sizes[some] + k] = (values[some] >> (7 * k)) & 0x7F | more
    return out, ends


def unpack_numbers(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64)
    ends = np.flatnonzero(raw < 0x80)
    starts = np.concatenate([[0], ends[:-1] + 1])
    shift = 7 * (np.arange(len(raw)) - np.repeat(starts, ends - starts + 1))
    return np.add.reduceat((raw & 0x7F).astype(np.int64) << shift, starts)


def index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index: rows (segment, term, n, postings) and, with a null term, the segment's documents.

    A null text has no words; its document is in the directory. A very long text is a segment of its own.
    """
    rows = narrow(docs, key, text)
    schema = f"segment bigint, term binary, n bigint, postings binary, documents array<struct<doc_id:{type_of(rows, 'doc_id')},n_words:bigint>>"

    def segment(number: int, batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [terms_of(t) for t in texts_of(batch)]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        every = np.fromiter(map(numbers.__getitem__, chain.from_iterable(texts)), np.int64, int(lengths.sum()))
        positions = np.arange(len(every)) + np.repeat(np.arange(len(texts)) * GAP, lengths)
        both = np.sort(every << 32 | positions)
        every, positions = both >> 32, both & 0xFFFFFFFF
        first = np.flatnonzero(np.diff(every, prepend=-1))
        gaps = np.diff(positions, prepend=0)
        gaps[first] = positions[first]
        data, ends = pack_numbers(gaps)
        upto = np.concatenate([first, [len(every)]])
        offsets = np.concatenate([[0], ends])[upto].astype(np.int32)
        n = len(first)
        listed = pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        ids = batch.column("doc_id")
        directory = pa.StructArray.from_arrays([ids, pa.array(lengths)], ["doc_id", "n_words"])
        documents = pa.ListArray.from_arrays(pa.array([0] * (n + 1) + [len(texts)], pa.int32()), directory)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n + 1, number), pa.int64()),
                pa.array([*numbers, None], pa.binary()),
                pa.array([*np.diff(upto).tolist(), len(texts)], pa.int64()),
                pa.concat_arrays([listed, pa.nulls(1, pa.binary())]),
                documents,
            ],
            ["segment", "term", "n", "postings", "documents"],
        )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in pieces(batches):
            yield segment(number, batch)
            number += 1

    return stored(rows.mapInArrow(build, schema), "postings")


class Queries:
    """Items as one row of term numbers, and the windows of ``size`` of them; an item with fewer words is one window."""

    def __init__(self, items: Iterable[tuple[object, bytes]], size: int):
        self.terms: dict[bytes, int] = {}
        self.items: list[object] = []
        numbers, lengths = [], []
        for item, text in items:
            words = terms_of(text)
            if words:
                self.items.append(item)
                lengths.append(len(words))
                numbers += [self.terms.setdefault(w, len(self.terms)) for w in words]
        self.numbers, n = np.array(numbers, np.int32), np.array(lengths, np.int64)
        each = np.maximum(1, n - size + 1)
        self.owners = np.repeat(np.arange(len(n), dtype=np.int32), each)
        self.firsts = ragged(np.cumsum(n) - n, each).astype(np.int32)
        self.lasts = self.firsts + np.minimum(n, size).astype(np.int32)[self.owners]

    def runs(self, found: dict[int, tuple[int, bytes]], starts: np.ndarray, ends: np.ndarray, slop: int) -> dict[int, dict[object, list]]:
        """Per document number and item, the runs [first, last] of word numbers that the item's windows cover."""
        sizes = np.zeros(len(self.terms), np.int64)
        for term, (n, _) in found.items():
            sizes[term] = n
        missing = np.concatenate([[0], np.cumsum(sizes[self.numbers] == 0)])
        lists: dict[int, np.ndarray] = {}

        def listed(term: int) -> np.ndarray:
            if term not in lists:
                lists[term] = np.cumsum(unpack_numbers(found[term][1]))
            return lists[term]

        hits: dict[object, list[np.ndarray]] = defaultdict(list)
        for w in np.flatnonzero(missing[self.firsts] == missing[self.lasts]):
            window = self.numbers[self.firsts[w] : self.lasts[w]]
            length = len(window)
            rarest, *others = sorted(range(length), key=lambda i: sizes[window[i]])
            at = listed(window[rarest]) - rarest
            for offset in others:
                places = listed(window[offset])
                near = np.minimum(np.searchsorted(places, at + offset - slop), len(places) - 1)
                at = at[np.abs(places[near] - at - offset) <= slop]
                if not len(at):
                    break
            else:
                # The rarest term itself is exact, so its document is the window's.
                owner = np.searchsorted(starts, at + rarest, "right") - 1
                first = np.maximum(at - slop, starts[owner])
                last = np.minimum(at + length - 1 + slop, ends[owner] - 1)
                hits[self.items[self.owners[w]]].append(np.stack([owner, first - starts[owner], last - starts[owner]]))
        out: dict[int, dict[object, list]] = defaultdict(dict)
        for item, parts in hits.items():
            owner, first, last = np.concatenate(parts, axis=1)[:, :]
            order = np.lexsort((first, owner))
            for d, a, b in zip(owner[order].tolist(), first[order].tolist(), last[order].tolist(), strict=True):
                runs = out[d].setdefault(item, [])
                if runs and a <= runs[-1][1] + 1:
                    runs[-1][1] = max(runs[-1][1], b)
                else:
                    runs.append([a, b])
        return out


def _blocks(items: DataFrame, item: str, text: str, window: int, most: int) -> DataFrame:
    """Stored: a row (block, terms, queries) for each stretch of ``most`` bytes of item texts; the last item of one may reach beyond it.

    Texts stay in tasks. The driver sees one sum per task that read items.
    """
    rows, kind = narrow(items, item, text), type_of(items, item)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            starts = start + np.cumsum(sizes) - sizes
            start += int(sizes.sum())
            columns = {"part": np.full(len(sizes), part, np.int64), "start": starts, "size": sizes}
            yield pa.RecordBatch.from_pydict({"item": batch.column("doc_id"), "text": texts} | columns)

    def build(block: pa.Table) -> pa.Table:
        both = zip(block.column("item").to_pylist(), block.column("text").to_pylist(), strict=True)
        queries = Queries(both, window)
        data = {"block": block.column("block")[:1], "terms": pa.array([list(queries.terms)], pa.list_(pa.binary()))}
        return pa.table(data | {"queries": pa.array([pickle.dumps(queries)], pa.binary())})

    measured = rows.where("text IS NOT NULL").mapInArrow(measure, f"item {kind}, text binary, part bigint, start bigint, size bigint")
    kept = stored(measured, "items")
    sums = sorted(tuple(r) for r in kept.groupBy("part").agg(F.sum("size")).collect())
    befores = np.cumsum([0, *(n for _, n in sums)]).tolist()
    bases = [(part, before) for (part, _), before in zip(sums, befores, strict=False)]
    based = kept.join(F.broadcast(items.sparkSession.createDataFrame(bases, "part bigint, base bigint")), "part")
    block = F.floor((F.col("base") + F.col("start")) / F.lit(most)).cast("bigint").alias("block")
    dealt = based.select(block, "item", "text").groupBy("block")
    return stored(dealt.applyInArrow(build, "block bigint, terms array<binary>, queries binary"), "item-blocks")


def _matcher(sent: Broadcast, item_type: pa.DataType, slop: int) -> Callable[[pa.Table], pa.Table]:
    """Matches of the sent queries in one segment, given the postings of their terms and the directory."""

    def match(table: pa.Table) -> pa.Table:
        queries, found, documents, segment = sent.value, {}, None, None
        for batch in table.to_batches():
            columns = (batch.column(c).to_pylist() for c in ("segment", "term", "n", "postings"))
            for i, (segment, term, n, data) in enumerate(zip(*columns, strict=True)):
                if term is None:
                    documents = batch.column("documents")[i].values
                else:
                    found[queries.terms[term]] = (n, data)
        lengths = documents.field("n_words").to_numpy()
        starts = np.cumsum(lengths + GAP) - lengths - GAP
        runs = queries.runs(found, starts, starts + lengths, slop)
        matches = [[{"item_id": k, "first": a, "last": b} for k, v in runs.get(d, {}).items() for a, b in v] for d in range(len(lengths))]
        listed = pa.list_(pa.struct([("item_id", item_type), ("first", pa.int64()), ("last", pa.int64())]))
        return pa.table(
            {
                "segment": pa.array(np.full(len(lengths), segment), pa.int64()),
                "number": pa.array(np.arange(len(lengths))),
                "doc_id": documents.field("doc_id"),
                "n_words": documents.field("n_words"),
                "matches": pa.array(matches, listed),
            }
        )

    return match


def search(
    postings: DataFrame, items: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW, slop: int = 0, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """All documents with the matches of the items' windows of ``window`` words: doc_id, n_words, matches.

    ``matches`` lists (item_id, first, last): word numbers of a run that windows of the item cover. An item
    with fewer words is one window; one without words (or null) has none. ``slop`` 0 finds exact phrases; more
    finds each word within so many words of its place (proximity). Items are searched in blocks of bounded size, all
    of them; documents and items may repeat. Repeated documents are separate rows.
    """
    if window + 2 * slop >= GAP:
        raise ValueError(f"a window of {window} words with tolerance {slop} reaches over {GAP} places")
    spark, id_type = postings.sparkSession, type_of(items, item)
    directory = postings.schema["documents"].dataType.elementType["doc_id"].dataType.simpleString()
    schema = f"segment bigint, number bigint, doc_id {directory}, n_words bigint, matches array<struct<item_id:{id_type},first:bigint,last:bigint>>"
    item_type = to_arrow_type(items.schema[item].dataType)
    blocks = _blocks(items, item, text, window, block_bytes)
    numbers = sorted(r[0] for r in blocks.select("block").collect())
    parts = []
    for number in numbers:
        block = blocks.where(F.col("block") == number)
        sent = spark.sparkContext.broadcast(pickle.loads(block.select("queries").first()[0]))
        # At most BLOCK_BYTES of item texts, and one item, have made these terms.
        terms = F.broadcast(block.select(F.explode("terms").alias("term")))
        needed = postings.where("term IS NULL").unionByName(postings.where("term IS NOT NULL").join(terms, "term", "left_semi"))
        part = needed.groupBy("segment").applyInArrow(_matcher(sent, item_type, slop), schema)
        if len(numbers) > 1:  # one block at a time: its matches are kept, what was sent for it is not
            part = stored(part, "matches")
            sent.destroy()
        parts.append(part)
    if not parts:
        none = f"cast(array() as array<struct<item_id:{id_type},first:bigint,last:bigint>>)"
        return postings.where("term IS NULL").selectExpr("inline(documents)").withColumn("matches", F.expr(none))
    if len(parts) == 1:
        return parts[0].select("doc_id", "n_words", "matches")
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    merged = every.groupBy("segment", "number").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("matches")).alias("matches")
    )
    return merged.select("doc_id", "n_words", "matches")


def covered(matches: Column | str) -> Column:
    """Number of words inside at least one run."""
    runs = F.sort_array(F.transform(matches, lambda m: F.struct(m["first"], m["last"])))
    empty = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-1).cast("bigint").alias("upto"))

    def add(seen: Column, run: Column) -> Column:
        upto = F.greatest(seen["upto"], run["last"])
        new = F.greatest(F.lit(0), run["last"] - F.greatest(run["first"] - 1, seen["upto"]))
        return F.struct((seen["n"] + new).alias("n"), upto.alias("upto"))

    return F.aggregate(runs, empty, add, lambda seen: seen["n"])


def contamination(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit (words inside matches), n_items, items_sha256, contaminated."""
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"].cast("string"))))
    return (
        found.withColumn("n_hit", covered("matches"))
        .withColumn("items", items)
        .select(
            "doc_id",
            "n_words",
            "n_hit",
            F.size("items").cast("bigint").alias("n_items"),
            F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
            (F.col("n_hit") > 0).alias("contaminated"),
        )
    )
