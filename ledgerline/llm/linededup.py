"""Lines that many documents share, kept only in the largest of them, as a keep bitmap per document.

Line keys are hashed, dealt out by ranges of the hash and sorted by hash, then document (largest first), then
position. In that order the first document of a key is the one that keeps it, and every later one follows while
the stream passes; nothing is gathered. What comes back is one bitmap per document, in runs of kept lines, never text.

A key that a large share of all lines has would be one task's work. Such keys are found by a sketch of bounded
size while the hashes are read; each of them is reduced to its largest document and its number of documents by a
partial aggregation, and its lines are decided in place against that short table instead of being sorted.

Everything is a column expression or a SQL function: nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.native import longs
from ledgerline.llm.tables import free_name, narrow, stored, version

#: A key counts as shared with so many code points and documents at least.
LEAST_CHARS = 20
LEAST_DOCUMENTS = 3
#: Hot keys at most; also the share of all lines (one in so many) from which on a key is hot.
MOST_HOT = 1000
#: Keys that the sketch tracks. It misses none that has over 4 / TRACKED of all lines.
TRACKED = 16_384

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """A line without ASCII white space at its ends, A-Z lower-cased."""
    return F.translate(F.trim(line, F.lit(" \t\n\x0b\x0c\r")), UPPER, LOWER)


def line_hashes(docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """doc_id, version, position and the 128-bit hash (h1, h2) of every line whose key is long enough to be shared."""
    rows = narrow(docs, key, text).select("doc_id", version(F.col("text")).alias("version"), F.col("text"))
    lines = rows.select("doc_id", "version", F.posexplode(F.split("text", "\n")).alias("position", "line"))
    keyed = lines.select("doc_id", "version", "position", line_key(F.col("line")).alias("key")).where(F.length("key") >= least_chars)
    # Different first values make two independent hashes.
    return keyed.select("doc_id", "version", "position", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"))


def hot_keys(hashes: DataFrame, most: int = MOST_HOT) -> list[int]:
    """h1 of the keys that more than one line in ``most`` has; fewer than ``most``, however many lines there are."""
    sketch = hashes.agg(F.expr(f"approx_top_k(h1, {most}, {max(TRACKED, 4 * most)})").alias("top"), F.count("*").alias("n"))
    found = sketch.select(F.expr("transform(filter(top, x -> x.count * %d > n), x -> x.item)" % most)).first()[0]
    return sorted(found or [])


def _document(df: DataFrame) -> Column:
    """A document for comparing: null ids are below all others."""
    return F.struct(df["doc_id"].isNotNull().alias("known"), df["doc_id"].alias("id"))


def _hot_lines(hashes: DataFrame, least_documents: int) -> DataFrame:
    """Dropped lines of hot keys: each key's facts are aggregated, and are fewer than MOST_HOT rows (by h1)."""
    one = hashes.select(*HASH, _document(hashes).alias("document"))
    facts = one.groupBy(*HASH).agg(F.max("document").alias("keeper"), F.count_distinct("document").alias("n"))
    facts = facts.where(F.col("n") >= least_documents).select(*HASH, "keeper")
    name = hashes.withColumn("document", _document(hashes)).join(F.broadcast(facts), HASH)
    return name.where(F.col("document") < F.col("keeper")).select("doc_id", "version", "position")


def _sorted_lines(hashes: DataFrame, least_documents: int) -> DataFrame:
    """Dropped lines of all other keys: ranges of hashes, sorted by document and position, passed once."""
    dealt = hashes.withColumn("document", _document(hashes)).repartitionByRange("h1")
    passing = Window.partitionBy(*HASH).orderBy(F.col("document").desc())
    # Equal documents have equal ranks, so the rank of the last row is the number of documents.
    ranked = dealt.withColumn("rank", F.dense_rank().over(passing))
    whole = passing.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counted = ranked.withColumn("n", F.max("rank").over(whole))
    return counted.where((F.col("rank") > 1) & (F.col("n") >= least_documents)).select("doc_id", "version", "position")


def dropped_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_chars: int = LEAST_CHARS,
    least_documents: int = LEAST_DOCUMENTS,
    most_hot: int = MOST_HOT,
) -> DataFrame:
    """(doc_id, version, position) of every line to drop.

    A row's version is a hash of its text and tells rows of one id apart; they count as one document. Rows with a null
    id are one document too, below all ids. Null and empty texts have one empty line, which is too short to be shared.
    """
    hashes = stored(line_hashes(docs, key, text, least_chars), "line-hashes")
    hot = hot_keys(hashes, most_hot)
    if not hot:
        return _sorted_lines(hashes, least_documents)
    is_hot = F.col("h1").isin(hot)
    return _hot_lines(hashes.where(is_hot), least_documents).unionByName(_sorted_lines(hashes.where(~is_hot), least_documents))


def kept_runs(dropped: Column, n_lines: Column) -> Column:
    """Runs (start, length) of kept lines, given the sorted positions of the dropped ones: a bitmap run by run."""
    gaps = F.sequence(F.lit(0), F.size(dropped))

    def gap(i: Column) -> Column:
        start = F.coalesce(F.get(dropped, i - 1) + 1, F.lit(0))
        return F.struct(start.alias("start"), (F.coalesce(F.get(dropped, i), n_lines) - start).alias("length"))

    return F.filter(F.transform(gaps, gap), lambda run: run["length"] > 0)


def bitmaps(lines: DataFrame) -> DataFrame:
    """One row per document that loses lines: doc_id, version, dropped, the sorted positions of what it loses."""
    # Equal rows of one id list a position several times.
    return lines.groupBy("doc_id", "version").agg(F.array_sort(F.collect_set("position")).alias("dropped"))


def keep_bitmaps(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """Keep bitmap of every document row: doc_id, version, n_lines, n_dropped, and ``kept``, its runs (start, length) of lines that stay.

    Rows may repeat; each is returned. A document that loses all its lines has no run.
    """
    rows = narrow(docs, key, text).select("doc_id", version(F.col("text")).alias("version"), _lines("text").alias("n_lines"))
    return _with_dropped(rows, dropped_lines(docs, key, text, **settings)).select("doc_id", "version", *_measures(F.col("n_lines")))


def _lines(text: str) -> Column:
    return F.size(F.split(F.coalesce(F.col(text), F.lit("")), "\n"))


def _measures(n_lines: Column) -> list[Column]:
    none = F.array().cast("array<int>")
    dropped = F.coalesce("_dropped", none)
    return [
        n_lines.cast("bigint").alias("n_lines"),
        F.size(dropped).cast("bigint").alias("n_dropped"),
        kept_runs(dropped, n_lines).alias("kept"),
    ]


def _with_dropped(rows: DataFrame, lines: DataFrame, key: str = "doc_id", same: str = "version") -> DataFrame:
    """``rows`` with ``_dropped``, null where nothing is; ids are compared null-safely."""
    lost = bitmaps(lines).select(F.col("doc_id").alias("_lost_id"), F.col("version").alias("_lost_version"), F.col("dropped").alias("_dropped"))
    return rows.join(lost, rows[key].eqNullSafe(lost["_lost_id"]) & (rows[same] == lost["_lost_version"]), "left").drop("_lost_id", "_lost_version")


def applied(text: Column, kept: Column) -> Column:
    """The kept lines of a text, joined by \\n; the empty text if none stays."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    pieces = F.transform(kept, lambda run: F.array_join(F.slice(lines, run["start"] + 1, run["length"]), "\n"))
    return F.array_join(pieces, "\n")


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs`` with all its columns, the text reduced to the lines that stay. Texts that lose nothing, nulls too, stay as they are."""
    kept = keep_bitmaps(docs, key, text, **settings).where("n_dropped > 0").dropDuplicates(["doc_id", "version"])
    a, b, runs = (free_name(docs, n) for n in ("_id", "_version", "_kept"))
    other = kept.select(F.col("doc_id").alias(a), F.col("version").alias(b), F.col("kept").alias(runs))
    joined = docs.join(other, docs[key].eqNullSafe(other[a]) & (version(docs[text]) == other[b]), "left")
    return joined.withColumn(text, F.when(F.col(runs).isNull(), F.col(text)).otherwise(applied(F.col(text), F.col(runs)))).select(docs.columns)


def line_digest(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """Per document row: doc_id, n_lines, n_dropped, and the SHA-256 of its kept text."""
    rows = narrow(docs, key, text).withColumn("version", version(F.col("text")))
    joined = _with_dropped(rows, dropped_lines(docs, key, text, **settings))
    measured = joined.select("doc_id", "text", *_measures(_lines("text")))
    whole = F.when(F.col("n_dropped") == longs(0), F.coalesce("text", F.lit(""))).otherwise(applied(F.col("text"), F.col("kept")))
    return measured.select("doc_id", "n_lines", "n_dropped", F.sha2(whole, 256).alias("kept_sha256"))
