"""Helpers shared by the operators: deduplication, NULL-safe keys, lookups that survive hot keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import settle

# A key is hot if more than one in so many rows has it; there are fewer hot keys than that.
HOT_SHARE = 500
# Parts that the rows of one key are spread over before they meet.
PARTS = 64
# Repeated keys up to this number are broadcast, as counted.
FEW_REPEATED = 100_000


def total_order(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns]


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order.

    Written as a filter on ``row_number`` because Spark then drops all but the first row of each key
    before the shuffle, so a key that holds a third of the rows costs one row per input partition.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def _preference(df: DataFrame, keys: Sequence[str], latest: Sequence[str]) -> list[Column]:
    rest = [c for c in df.columns if c not in keys and c not in latest]
    return [F.col(c).desc_nulls_last() for c in latest] + total_order(rest)


def dedup(df: DataFrame, keys: Sequence[str], latest: Sequence[str] = ()) -> DataFrame:
    """One row per key, the same on every run: greatest ``latest`` columns, then smallest row."""
    return first_by(df, keys, _preference(df, keys, latest))


def duplicates(df: DataFrame, keys: Sequence[str], latest: Sequence[str] = ()) -> DataFrame:
    """The rows that ``dedup`` leaves out: together they are all rows of ``df``.

    Keys are counted first, and unless very many are repeated only their rows are put in order at all. Keys are
    spread over tasks by all their rows' columns first, so that only rows that are not the
    first of their part are known to be left out early; the firsts of the parts meet by key.
    """
    names = list(df.columns)
    counts = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    repeated = settle(counts.filter("_rows > 1").drop("_rows"))
    few = repeated.count()
    if not few:
        return df.filter(F.lit(False))
    if few <= FEW_REPEATED:
        met = [F.col(f"d.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
        df = df.alias("d").join(F.broadcast(repeated.alias("r")), reduce(lambda a, b: a & b, met), "left_semi")
        df = df.select(names)
    part = F.pmod(F.xxhash64(*names), F.lit(PARTS))
    place = F.row_number().over(
        Window.partitionBy(*keys, "_part").orderBy(*_preference(df, keys, latest))
    )
    placed = df.withColumn("_part", part).withColumn("_place", place)
    firsts = placed.filter("_place = 1").drop("_place", "_part")
    final = F.row_number().over(
        Window.partitionBy(*keys).orderBy(*_preference(firsts, keys, latest))
    )
    lost = firsts.withColumn("_place", final).filter("_place > 1").select(names)
    return placed.filter("_place > 1").select(names).unionByName(lost)


def all_equal(left: str, right: str, columns: Sequence[str]) -> Column:
    """NULL-safe equality of all ``columns`` between two aliased frames."""
    pairs = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    return reduce(lambda a, b: a & b, pairs, F.lit(True))


def key_columns(keys: Sequence[str]) -> list[str]:
    """Columns that ``with_key`` adds: never NULL, equal where all of ``keys`` are NULL-safely equal."""
    return [*[f"_key{i}" for i in range(len(keys))], "_missing"]


def with_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key columns to group and join on alike, so that one shuffle serves both.

    A NULL-safe comparison would be turned into expressions of its own, which a partitioning by the
    plain columns does not satisfy.
    """
    flags = [F.when(F.col(k).isNull(), 1 << i).otherwise(0) for i, k in enumerate(keys)]
    values = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    missing = reduce(lambda a, b: a + b, flags)
    return df.withColumns(dict(zip(key_columns(keys), [*values, missing], strict=True)))


def same_key(left: str, right: str, keys: Sequence[str]) -> Column:
    pairs = [F.col(f"{left}.{c}") == F.col(f"{right}.{c}") for c in key_columns(keys)]
    return reduce(lambda a, b: a & b, pairs)


def hot_keys(facts: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keys that more than one in ``HOT_SHARE`` rows has, NULL keys aside; fewer than ``HOT_SHARE``."""
    counts = facts.select(*names).dropna().groupBy(*names).count()
    total = counts.agg(F.sum("count")).scalar()
    return counts.filter(F.col("count") * HOT_SHARE > total).drop("count")


def lookup(
    facts: DataFrame, entries: DataFrame, on: Mapping[str, str], spread_by: str, few: int = 0
) -> DataFrame:
    """Left join of ``facts`` to ``entries`` (unique per key), every fact kept exactly once.

    ``on`` maps fact columns to entry columns; the entry's key columns are dropped. Hot fact keys,
    fewer than ``HOT_SHARE`` by definition, find their entry in a broadcast table of that many rows;
    they and the facts with a NULL key are spread by ``spread_by`` in the shuffle that serves the
    rest. No task therefore gets a hot key whole, and nothing is broadcast because of an estimate.

    Entries that are counted to be ``few`` at most are broadcast whole, and facts are not shuffled at all.
    """
    columns, taken = list(facts.columns), [c for c in entries.columns if c not in on.values()]
    keyed = entries.select(
        *[F.col(e).alias(f"_k{i}") for i, e in enumerate(on.values())],
        F.struct(*[F.col(c) for c in taken]).alias("_entry"),
    )
    key_names = [f"_k{i}" for i in range(len(on))]
    if few and entries.count() <= few:
        met = reduce(
            lambda a, b: a & b,
            [F.col(f"f.{c}") == F.col(f"e.{k}") for c, k in zip(on, key_names, strict=True)],
        )
        found = facts.alias("f").join(F.broadcast(keyed.alias("e")), met, "left")
        return found.select(
            *[F.col(f"f.{c}") for c in columns], *[F.col("e._entry")[c].alias(c) for c in taken]
        )
    fact_keys = [F.col(c).alias(k) for c, k in zip(on, key_names, strict=True)]
    hot = hot_keys(facts.select(*fact_keys), key_names)
    hot_entries = F.broadcast(
        keyed.join(F.broadcast(hot), key_names).select(
            *key_names, F.col("_entry").alias("_hot_entry"), F.lit(True).alias("_hot")
        )
    )
    marked = facts.select("*", *fact_keys).join(hot_entries, key_names, "left")
    elsewhere = F.col("_hot").isNotNull() | reduce(
        lambda a, b: a | b, [F.col(k).isNull() for k in key_names]
    )
    scattered = marked.withColumn(
        "_spread", F.when(elsewhere, F.xxhash64(F.col(spread_by)))
    )
    cold = keyed.withColumn("_spread", F.lit(None).cast("long"))
    matched = scattered.alias("f").join(
        cold.hint("merge").alias("e"),
        reduce(
            lambda a, b: a & b,
            [F.col(f"f.{k}") == F.col(f"e.{k}") for k in key_names],
            F.col("f._spread").eqNullSafe(F.col("e._spread")),
        ),
        "left",
    )
    found = F.coalesce(F.col("f._hot_entry"), F.col("e._entry"))
    return matched.select(
        *[F.col(f"f.{c}") for c in columns], *[found[c].alias(c) for c in taken]
    )
