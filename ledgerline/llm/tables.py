"""Intermediate tables of the operators, in the folder that the executors share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.session import scratch_path


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once, compactly, and read it back; later jobs do not depend on lost executors."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_place(ordered: DataFrame, name: str = "place") -> DataFrame:
    """Rows that are dealt out and sorted in their order, with their place in the whole of it, from 0.

    The rows are stored; a place is the rows of earlier partitions (one sum each) plus those before it in its own.
    """
    marked = stored(ordered.withColumn("_mark", F.monotonically_increasing_id()), "ordered")
    part = F.shiftrightunsigned("_mark", 33)
    sizes = marked.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(sizes.select("_part", before.alias("_before")))
    within = F.col("_mark").bitwiseAND(F.lit((1 << 33) - 1))
    placed = marked.withColumn("_part", part).join(offsets, "_part")
    return placed.select(*ordered.columns, (F.col("_before") + within).alias(name))


def narrow(df: DataFrame, key: str = "doc_id", text: str = "text", **more: str) -> DataFrame:
    """Only the columns an operator reads, under fixed names, so that others cannot clash with its own."""
    return df.select(df[key].alias("doc_id"), df[text].alias("text"), *(df[c].alias(n) for n, c in more.items()))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def words(text: Column | str) -> Column:
    """Words between ASCII white space, in order; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def version(text: Column) -> Column:
    """What tells texts of the same id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _same(docs: DataFrame, rows: DataFrame) -> tuple[DataFrame, Column]:
    """``rows`` (doc_id, version) under names that ``docs`` does not have, and the condition that both are equal."""
    a, b = free_name(docs, "_id"), free_name(docs, "_version")
    other = rows.select(F.col("doc_id").alias(a), F.col("version").alias(b))
    return other, docs["doc_id"].eqNullSafe(other[a]) & (version(docs["text"]) == other[b])


def only(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Documents whose (doc_id, version) is in ``rows``; of repeated rows one."""
    kept = docs.join(*_same(docs, rows), "left_semi")
    name = free_name(docs, "_version")
    return kept.withColumn(name, version(docs["text"])).dropDuplicates(["doc_id", name]).drop(name)


def without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Documents whose (doc_id, version) is not in ``rows``."""
    return docs.join(*_same(docs, rows), "left_anti")
