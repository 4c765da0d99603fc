"""The prefix trie of conversations, and what sharing its prefixes saves.

A node is a distinct sequence of first turns; its fingerprint is the exclusive or of 128-bit hashes of
(position, role, text), so prefixes of one conversation follow from running sums, and a node's parent from taking
its last turn out again. Equal prefixes meet in one partial aggregation, however many conversations share them.

Subtree totals are passed up by time-forward processing: nodes are sorted by reverse level order, and each sends its
totals to its parent through a priority queue that spills, from which the parent takes them when its turn comes.
The trie is cut where at most ``most`` conversations remain below a node. The parts below the cuts are shards,
each within one task; nodes above are few by construction (rows / most), get the totals of the shard roots added
up by parent, and are passed through once more, on their own.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.native import longs
from ledgerline.llm.tables import stored, with_place, words

#: Turns of a conversation over which a running sum is formed at once; longer ones are summed chunk by chunk.
CHUNK = 4096
#: Nodes above the shards at most, and the least bound of a shard in conversations.
MOST_ABOVE = 100_000
LEAST_SHARD = 64
#: Messages that a queue holds in memory, and how many it writes or reads at a time.
MOST_QUEUED = 200_000
BLOCK = 1000
#: Ids that are joined into one piece of text before hashing.
IDS_A_PIECE = 50_000

NODE, PARENT = ["x1", "x2"], ["p1", "p2"]


def numbered(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, ordinal (from 0, by turn, nulls first, then role and text), role and text; nulls of these are empty.

    Rows are dealt out by ranges of their order, so that one long conversation is spread over tasks; a row's place
    is then its place in the whole order less that of its conversation's first row. A row without conv_id belongs to no
    conversation and is left out. Equal rows are turns of their own.
    """
    named = rows.select(
        rows[conv].cast("bigint").alias("conv_id"),
        rows[turn].alias("turn"),
        F.coalesce(rows[role], F.lit("")).alias("role"),
        F.coalesce(rows[text], F.lit("")).alias("text"),
    ).where("conv_id IS NOT NULL")
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role"]
    dealt = named.repartitionByRange(*order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
    placed = with_place(dealt.select("conv_id", "role", "text"))
    first = placed.groupBy("conv_id").agg(F.min("place").alias("first"))
    return placed.join(first, "conv_id").select("conv_id", (F.col("place") - F.col("first")).alias("ordinal"), "role", "text")


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and n_turns."""
    return turns.groupBy("conv_id").agg(F.count("*").alias("n_turns"))


def regrown(turns: DataFrame, stem: Callable[[Column], Column], shared: Callable[[Column], Column], most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are replaced by those of another one.

    Conversation c begins with the first ``shared(c)`` turns of conversation ``stem(c)`` (all if fewer, none if there is no
    such conversation), and goes on with its own turns after as many. ``shared`` is at most ``most``. Returns turns, and
    conversations (conv_id, n_turns), of which some may have no turn left.
    """
    turns = stored(turns, "turns")
    known = conversations(turns).select("conv_id", "n_turns", stem(F.col("conv_id")).alias("stem"), shared(F.col("conv_id")).alias("h"))
    known = stored(known, "conversations")
    stems = known.select(F.col("conv_id").alias("stem"), F.col("n_turns").alias("n_stem"))
    planned = known.join(stems, "stem", "left").select(
        "conv_id", "stem", "h", F.least("h", F.coalesce("n_stem", longs(0))).alias("taken"), F.greatest(F.col("n_turns") - F.col("h"), longs(0)).alias("rest")
    )
    planned = stored(planned, "planned")
    own = turns.join(planned.select("conv_id", "h", "taken"), "conv_id").where("ordinal >= h")
    own = own.select("conv_id", (F.col("ordinal") - F.col("h") + F.col("taken")).alias("ordinal"), "role", "text")
    heads = turns.where(F.col("ordinal") < most).select(F.col("conv_id").alias("stem"), "ordinal", "role", "text")
    lent = heads.join(planned.where("taken > 0").select("conv_id", "stem", "taken"), "stem").where("ordinal < taken")
    return own.unionByName(lent.select("conv_id", "ordinal", "role", "text")), planned.select("conv_id", (F.col("taken") + F.col("rest")).alias("n_turns"))


def prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per conversation and depth, from 0: conv_id, depth, node (x1, x2), its parent (p1, p2), n_words, ends.

    ``ends`` marks a conversation's last prefix. The root is (0, 0) and has no parent.
    """
    of = lambda seed: F.xxhash64(F.lit(seed), "ordinal", "role", "text")
    chunk = F.floor(F.col("ordinal") / CHUNK).cast("bigint")
    hashed = turns.select(
        "conv_id", "ordinal", chunk.alias("chunk"), of("first").alias("a"), of("second").alias("b"), F.size(words("text")).cast("bigint").alias("n_words")
    )
    so_far = Window.partitionBy("conv_id", "chunk").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, 0)
    summed = hashed.withColumns({"x1": F.bit_xor("a").over(so_far), "x2": F.bit_xor("b").over(so_far)})
    longest = convs.agg(F.max("n_turns")).first()[0] or 0
    if longest > CHUNK:
        totals = hashed.groupBy("conv_id", "chunk").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
        earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
        carried = totals.select("conv_id", "chunk", F.bit_xor("a").over(earlier).alias("c1"), F.bit_xor("b").over(earlier).alias("c2"))
        summed = summed.join(carried.where("c1 IS NOT NULL"), ["conv_id", "chunk"], "left")
        more = {x: F.col(x).bitwiseXOR(F.coalesce(c, longs(0))) for x, c in (("x1", "c1"), ("x2", "c2"))}
        summed = summed.withColumns(more)
    below = summed.select(
        "conv_id",
        (F.col("ordinal") + 1).alias("depth"),
        *NODE,
        F.col("x1").bitwiseXOR(F.col("a")).alias("p1"),
        F.col("x2").bitwiseXOR(F.col("b")).alias("p2"),
        "n_words",
    )
    below = below.join(convs, "conv_id").select(*below.columns, (F.col("depth") == F.col("n_turns")).alias("ends"))
    none = F.lit(None).cast("bigint")
    root = convs.select(
        "conv_id", longs(0).alias("depth"), longs(0).alias("x1"), longs(0).alias("x2"), none.alias("p1"), none.alias("p2"), longs(0).alias("n_words"), (F.col("n_turns") == 0).alias("ends")
    )
    return root.unionByName(below)


def ends_digests(rows: DataFrame) -> DataFrame:
    """Per node at which conversations end: (x1, x2), ends_sha256 of their ids, ascending and comma-joined.

    Ids are joined into pieces of text by as many tasks as there are, also those of one node; a hash is one stream,
    so the pieces of a node then pass through one task, in order, without being gathered.
    """
    ids = rows.where("ends").select(*NODE, "conv_id")
    dealt = ids.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    pieces = dealt.mapInArrow(_joined, "x1 bigint, x2 bigint, first bigint, ids string")
    streamed = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return streamed.mapInArrow(_digested, "x1 bigint, x2 bigint, ends_sha256 string")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, ids = None, []

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"x1": node[0], "x2": node[1], "first": ids[0], "ids": ",".join(map(str, ids))}])

    for batch in batches:
        for x1, x2, i in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv_id")), strict=True):
            if node != (x1, x2) or len(ids) == IDS_A_PIECE:
                if ids:
                    yield piece()
                node, ids = (x1, x2), []
            ids.append(i)
    if ids:
        yield piece()


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, digest = None, None
    for batch in batches:
        done = []
        for x1, x2, text in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids")), strict=True):
            if node == (x1, x2):
                digest.update(b",")
            else:
                if node:
                    done.append({"x1": node[0], "x2": node[1], "ends_sha256": digest.hexdigest()})
                node, digest = (x1, x2), hashlib.sha256()
            digest.update(text.encode())
        if done:
            yield pa.RecordBatch.from_pylist(done)
    if node:
        yield pa.RecordBatch.from_pylist([{"x1": node[0], "x2": node[1], "ends_sha256": digest.hexdigest()}])


class SpillingQueue:
    """A priority queue that keeps at most ``most`` items in memory; the others lie in sorted runs, read block by block.

    Runs are nameless files of the running task, like Spark's own spill; nothing outside the task reads them.
    """

    def __init__(self, most: int = MOST_QUEUED):
        self.most, self.heap, self.runs = most, [], []

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.most:
            file = tempfile.TemporaryFile()
            items = sorted(self.heap)
            for i in range(0, len(items), BLOCK):
                pickle.dump(items[i : i + BLOCK], file)
            file.seek(0)
            self.heap = []
            self._next(iter(self._read(file)))

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def _next(self, run: Iterator[tuple]) -> None:
        first = next(run, None)
        if first is not None:
            heapq.heappush(self.runs, (first, id(run), run))

    def least(self) -> tuple | None:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            return self.runs[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            item, _, run = heapq.heappop(self.runs)
            self._next(run)
            return item
        return heapq.heappop(self.heap)


FACTS = ["conv_id", "depth", "n_convs", "ends_sha256", *NODE, *PARENT]
TOTALS = ["n_children", "n_leaves", "saved_tokens"]
CLIMBED = (
    "conv_id bigint, depth bigint, n_convs bigint, ends_sha256 string, x1 bigint, x2 bigint, p1 bigint, p2 bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, parent_conv_id bigint, top boolean"
)


def climbed(most: int = MOST_QUEUED):
    """Function for nodes sorted by depth (deepest first) and fingerprint that passes totals to parents, and parents' ids back.

    Nodes come with what they have of their own: n_children and n_leaves (from other shards), saved_tokens, top.
    """

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, sent = SpillingQueue(most), 0
        for batch in batches:
            out = []
            for node in batch.to_pylist():
                at = (-node["depth"], node["x1"], node["x2"])
                while (waiting := queue.least()) and waiting[:3] == at:
                    child = queue.pop()[4]
                    node["n_children"] += 1
                    node["n_leaves"] += child["n_leaves"]
                    node["saved_tokens"] += child["saved_tokens"]
                    out.append(child | {"parent_conv_id": node["conv_id"]})
                node["n_leaves"] = node["n_leaves"] if node["n_children"] else 1
                if node["top"]:
                    out.append(node | {"parent_conv_id": None})
                else:
                    sent += 1
                    queue.push((1 - node["depth"], node["p1"], node["p2"], sent, node))
            if out:
                yield pa.RecordBatch.from_pylist(out, CLIMBED_SCHEMA)

    return climb


CLIMBED_SCHEMA = pa.schema(
    [(f.split()[0], {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}[f.split()[1]]) for f in CLIMBED.split(", ")]
)


def _climb(nodes: DataFrame, queued: int) -> DataFrame:
    return nodes.sortWithinPartitions(F.col("depth").desc(), *NODE).select(*FACTS, *TOTALS, "top").mapInArrow(climbed(queued), CLIMBED)


def trie(turns: DataFrame, convs: DataFrame, most: int | None = None, queued: int = MOST_QUEUED) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, ordinal from 0, role, text) over all ``convs`` (conv_id, n_turns).

    conv_id is the smallest member and, with depth, names a node; parent_conv_id, n_convs, n_children, n_leaves (childless
    nodes in its subtree), saved_tokens (words of last turns times members but one, over its subtree) and ends_sha256
    (ids of the members that end there). Without conversations there is no node; otherwise the root (depth 0) is one.

    ``most`` bounds the conversations of a shard; by default it grows with the table, so that no more than MOST_ABOVE
    nodes lie above the shards.
    """
    rows = stored(prefixes(turns, convs), "prefixes")
    most = most or max(LEAST_SHARD, -(-rows.count() // MOST_ABOVE))
    facts = rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.max("n_words").alias("n_words"), F.count("*").alias("n_convs")
    )
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    nodes = facts.join(ends_digests(rows), NODE, "left").select(
        "conv_id",
        "depth",
        "n_convs",
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
        *NODE,
        *PARENT,
        longs(0).alias("n_children"),
        longs(0).alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved_tokens"),
    )
    nodes = stored(nodes, "trie-nodes")

    # At most rows / most nodes have more than ``most`` members.
    above = nodes.where(F.col("n_convs") > most)
    cut = F.broadcast(above.select(*NODE))
    # Members never grow along a path, so a conversation enters its shard at its first node below the cut.
    entered = rows.join(cut, NODE, "left_anti").groupBy("conv_id").agg(F.min_by(F.struct(*NODE), "depth").alias("entry"))
    sharded = nodes.where(F.col("n_convs") <= most).join(entered, "conv_id")
    is_top = (F.col("entry.x1") == F.col("x1")) & (F.col("entry.x2") == F.col("x2"))
    within = sharded.withColumn("top", is_top).repartition("entry")
    passed = stored(_climb(within, queued), "shards")

    roots = passed.where("top AND depth > 0")
    sums = roots.groupBy(*PARENT).agg(F.count("*").alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
    sums = sums.select(F.col("p1").alias("x1"), F.col("p2").alias("x2"), "c", "l", "s")
    upper = above.join(sums, NODE, "left").select(
        *FACTS,
        F.coalesce("c", longs(0)).alias("n_children"),
        F.coalesce("l", longs(0)).alias("n_leaves"),
        (F.col("saved_tokens") + F.coalesce("s", longs(0))).alias("saved_tokens"),
        (F.col("depth") == 0).alias("top"),
    )
    across = _climb(upper.repartition(1), queued)
    names = F.broadcast(above.select(F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("parent_conv_id")))
    linked = roots.drop("parent_conv_id").join(names, PARENT)
    shown = ["conv_id", "depth", "parent_conv_id", "n_convs", *TOTALS, "ends_sha256"]
    inner = passed.where("NOT top OR depth = 0")
    return inner.select(shown).unionByName(linked.select(shown)).unionByName(across.select(shown))


#: Conversations of a family begin alike: with up to three turns of the one whose id is a multiple of 20.
FAMILY, SHARED_BELOW = 20, 4


def families(rows: DataFrame, **columns: str) -> tuple[DataFrame, DataFrame]:
    """Turns and conversations of ``rows``, rebuilt so that the members of a family share beginnings."""
    drawn = lambda c: F.pmod(F.crc32(c.cast("string").cast("binary")), longs(SHARED_BELOW))
    return regrown(numbered(rows, **columns), lambda c: c - c % FAMILY, drawn, SHARED_BELOW)
