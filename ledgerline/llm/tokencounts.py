"""Token counts that follow edits: a segment tree of counts per document.

The leaves of a tree are stretches of a few hundred characters that begin after white space, where the
tokenizer always cuts; inner nodes hold the sums of their children. An edit re-encodes the leaves that it
touches, and the next leaf too if the white space before it is gone, and renews the sums above them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.batches import pieces, texts_of
from ledgerline.llm.encoder import WordEncoder, encoder
from ledgerline.llm.native import longs
from ledgerline.llm.tables import narrow, stored, type_of, version

LEAF_CHARS = 512
#: Distinct words that a worker remembers here, where two kinds of work share an executor's memory.
MOST_WORDS = 150_000
#: ASCII white space; what a leaf begins after.
SPACE = re.compile(r"[ \t\n\x0b\x0c\r]+")
SPACES = " \t\n\x0b\x0c\r"


def leaves_of(text: str, size: int = LEAF_CHARS) -> list[str]:
    """The text in stretches of at least ``size`` characters that end with white space, but for the last."""
    out, start = [], 0
    while m := SPACE.search(text, start + size):
        out.append(text[start : m.end()])
        start = m.end()
    return [*out, text[start:]]


class Tree:
    """Characters and tokens of the leaves at ``size`` and after, and sums above; the root is node 1."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.chars, self.tokens, self.size = chars, tokens, len(chars) // 2

    @classmethod
    def of(cls, chars: list[int], tokens: list[int]) -> Tree:
        size = 1 << max(0, len(chars) - 1).bit_length()
        tree = cls(np.zeros(2 * size, np.int64), np.zeros(2 * size, np.int64))
        tree.chars[size : size + len(chars)], tree.tokens[size : size + len(chars)] = chars, tokens
        level = size
        while level > 1:
            for sums in (tree.chars, tree.tokens):
                sums[level // 2 : level] = sums[level : 2 * level].reshape(-1, 2).sum(axis=1)
            level //= 2
        return tree

    def find(self, char: int) -> tuple[int, int]:
        """The leaf that holds a character, and the leaf's first character; past the end, the last leaf with any."""
        char, node, before = min(char, max(0, int(self.chars[1]) - 1)), 1, 0
        while node < self.size:
            node *= 2
            if char - before >= self.chars[node]:
                before += int(self.chars[node])
                node += 1
        return node - self.size, before

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        """New numbers of a leaf, and the sums on its way to the root."""
        node = leaf + self.size
        more = chars - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += more[0]
            self.tokens[node] += more[1]
            node //= 2


def edited(text: str, edits: list[tuple[int, int, str]]) -> str:
    """The text after edits (start, length, replacement), which are sorted and do not overlap."""
    out, at = [], 0
    for start, length, replacement in edits:
        out += [text[at:start], replacement]
        at = start + length
    return "".join([*out, text[at:]])


def ordered(edits: list[tuple[int, int, str]], size: int) -> list[tuple[int, int, str]]:
    """Edits within a text of ``size`` characters, in order; one that overlaps an earlier one is left out."""
    out, end = [], 0
    for start, length, replacement in sorted((max(0, s), max(0, n), r or "") for s, n, r in edits):
        start = min(start, size)
        if start >= end:
            out.append((start, min(length, size - start), replacement))
            end = start + out[-1][1]
    return out


def recount(tree: Tree, text: str, edits: list[tuple[int, int, str]], encode: WordEncoder) -> int:
    """Bring a text's tree up to date with its edits; returns the number of characters that were encoded again."""
    regions: list[list] = []  # first leaf, last leaf, its first character, its end, edits
    for edit in edits:
        first, begin = tree.find(edit[0])
        last, other = tree.find(max(edit[0], edit[0] + edit[1] - 1))
        end = other + int(tree.chars[tree.size + last])
        if regions and first <= regions[-1][1]:
            regions[-1][1], regions[-1][3] = max(last, regions[-1][1]), max(end, regions[-1][3])
            regions[-1][4].append(edit)
        else:
            regions.append([first, last, begin, end, [edit]])
    merged: list[tuple] = []
    i = 0
    while i < len(regions):
        first, last, begin, end, mine = regions[i]
        i += 1
        while True:
            new = edited(text[begin:end], [(s - begin, n, r) for s, n, r in mine])
            if end >= len(text) or not new or new[-1] in SPACES:
                break
            if i < len(regions) and regions[i][0] == last + 1:
                _, last, _, end, more = regions[i]
                mine, i = mine + more, i + 1
            else:  # the word at the end goes on in the next leaf
                last, end = last + 1, end + int(tree.chars[tree.size + last + 1])
        merged.append((first, last, new))
    counted = 0
    for first, last, new in merged:
        parts = leaves_of(new)
        room = last - first + 1
        parts = [*parts[: room - 1], "".join(parts[room - 1 :])] if len(parts) > room else parts
        _, counts = encode.encode([p.encode() for p in parts])
        for i in range(room):
            tree.put(first + i, len(parts[i]) if i < len(parts) else 0, int(counts[i]) if i < len(parts) else 0)
        counted += len(new)
    return counted


def count_tokens(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored: doc_id, version, n_tokens and the tree (chars, tokens) of every distinct (doc_id, text).

    Rows that repeat both count once; other texts of the same id are documents of their own. A null text is empty.
    """
    rows = narrow(docs, key, text).withColumn("version", version(F.col("text")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            split = [leaves_of(t.decode("utf-8", "replace")) for t in texts_of(batch)]
            _, counts = encoder(tokenizer, MOST_WORDS).encode([leaf.encode() for leaves in split for leaf in leaves])
            trees, at = [], 0
            for leaves in split:
                trees.append(Tree.of([len(leaf) for leaf in leaves], counts[at : at + len(leaves)].tolist()))
                at += len(leaves)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("version"),
                    pa.array([int(t.tokens[1]) for t in trees], pa.int64()),
                    pa.array([t.chars for t in trees], pa.list_(pa.int64())),
                    pa.array([t.tokens for t in trees], pa.list_(pa.int64())),
                ],
                ["doc_id", "version", "n_tokens", "chars", "tokens"],
            )

    schema = f"doc_id {type_of(rows, 'doc_id')}, version bigint, n_tokens bigint, chars array<bigint>, tokens array<bigint>"
    # Only ids and hashes are shuffled to see whether any row comes twice.
    names = ["doc_id", "version"]
    twice = not rows.groupBy(*names).count().where("count > 1").isEmpty()
    return stored((rows.dropDuplicates(names) if twice else rows).mapInArrow(count, schema), "token-trees")


def apply_edits(trees: DataFrame, edits: DataFrame, tokenizer: str) -> DataFrame:
    """The trees after edits: doc_id, n_tokens (before), n_edits, n_edited (after), n_recounted, n_chars, chars, tokens, text.

    ``edits`` has doc_id, text and edits, an array of (start, length, replacement) in characters of the text. Edits are
    put in order; one that overlaps an earlier one, or lies behind the end, is cut or left out. Only the texts of
    edited documents are moved, and ``text`` is their new text (null for others).
    """
    changed = edits.where(F.size("edits") > 0).select(
        F.col("doc_id").alias("of"), version(F.col("text")).alias("of_version"), F.coalesce("text", F.lit("")).alias("text"), "edits"
    ).dropDuplicates(["of", "of_version"])
    same = trees["doc_id"].eqNullSafe(changed["of"]) & (trees["version"] == changed["of_version"])
    joined = trees.join(changed, same).select("doc_id", "n_tokens", "chars", "tokens", "text", "edits")

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out = {c: [] for c in ("n_edits", "n_edited", "n_recounted", "n_chars", "chars", "tokens", "text")}
            columns = (batch.column(c).to_pylist() for c in ("chars", "tokens", "text", "edits"))
            for chars, tokens, text, listed in zip(*columns, strict=True):
                tree = Tree(np.array(chars, np.int64), np.array(tokens, np.int64))
                done = ordered([(e["start"], e["length"], e["replacement"]) for e in listed], len(text))
                recounted = recount(tree, text, done, encoder(tokenizer, MOST_WORDS))
                row = (len(done), int(tree.tokens[1]), recounted, int(tree.chars[1]), tree.chars, tree.tokens, edited(text, done))
                for name, value in zip(out, row, strict=True):
                    out[name].append(value)
            types = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 2 + [pa.string()]
            arrays = [pa.array(v, t) for v, t in zip(out.values(), types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_tokens"), *arrays], ["doc_id", "n_tokens", *out])

    schema = (
        f"doc_id {type_of(trees, 'doc_id')}, n_tokens bigint, n_edits bigint, n_edited bigint, n_recounted bigint, n_chars bigint, "
        "chars array<bigint>, tokens array<bigint>, text string"
    )
    # Documents without edits stay as they are, and where they are: no task of Python sees them.
    none = longs(0)
    kept = trees.join(changed.select("of", "of_version"), same, "left_anti").select(
        "doc_id",
        "n_tokens",
        none.alias("n_edits"),
        F.col("n_tokens").alias("n_edited"),
        none.alias("n_recounted"),
        F.get("chars", F.lit(1)).alias("n_chars"),
        "chars",
        "tokens",
        F.lit(None).cast("string").alias("text"),
    )
    return joined.mapInArrow(update, schema).unionByName(kept)


EMAIL = re.compile(r"[A-Za-z0-9._+-]{1,64}@[A-Za-z0-9.-]{1,255}")
EDITS = "array<struct<start:bigint,length:bigint,replacement:string>>"


def cleaning_edits(text: str) -> list[tuple[int, int, str]]:
    """Edits that mask e-mail addresses and delete lines that the text has had before."""
    out, seen, at = [], set(), 0
    for line in text.split("\n"):
        if line.strip() and line in seen:
            out.append((at, min(len(line) + 1, len(text) - at), ""))
        elif "@" in line:
            out += [(at + m.start(), m.end() - m.start(), "<EMAIL>") for m in EMAIL.finditer(line)]
        seen.add(line)
        at += len(line) + 1
    return out


def cleaned(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text and the cleaning edits of every document."""

    @F.arrow_udf(EDITS)
    def edits(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("replacement", pa.string())]))
        for array in texts:
            found = []
            for piece in pieces([pa.RecordBatch.from_arrays([array], ["text"])]):
                for t in piece.column("text").to_pylist():
                    found.append([{"start": s, "length": n, "replacement": r} for s, n, r in cleaning_edits(t or "")])
            yield pa.array(found, kind)

    return narrow(docs, key, text).withColumn("edits", edits("text"))
