"""Assertions on versioned tables. Each returns the offending rows, none when the data is sound."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_current(gold: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one current version (keys without any are not looked at)."""
    counts = gold.filter("is_current").groupBy(*keys).agg(F.count("*").alias("current_count"))
    return counts.filter("current_count <> 1")


def unique_version(gold: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Versions of one key that start on the same day."""
    counts = gold.groupBy(*keys, "valid_from").agg(F.count("*").alias("version_count"))
    return counts.filter("version_count > 1")


def flag_matches_valid_to(gold: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose ``is_current`` and ``valid_to`` contradict each other."""
    return gold.filter(F.col("is_current") == F.col("valid_to").isNotNull()).select(
        *keys, "valid_from", "valid_to", "is_current"
    )


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column that holds NULLs, with their number; one pass over the data."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns])
    return counts.select(F.inline(pairs)).filter("nulls > 0")


def accepted_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside the accepted ones, with their number. NULL is the business of ``not_null``."""
    return (
        df.filter(~F.col(column).isin(list(accepted)))
        .groupBy(column)
        .agg(F.count("*").alias("row_count"))
    )


def violations(gold: DataFrame, keys: Sequence[str], required: Sequence[str]) -> dict[str, int]:
    """What breaks the invariants of a versioned table, by name, with the number of offenders: one pass over ``gold``.

    Keys are grouped with their start days first, which is one row per version where all is well, so a key
    that holds many rows is no task's work.
    """
    flag = F.col("is_current") == F.col("valid_to").isNotNull()
    missing = [F.count_if(F.col(c).isNull()) for c in required]
    versions = gold.groupBy(*keys, "valid_from").agg(
        F.count("*").alias("_rows"),
        F.count_if(F.col("is_current")).alias("_current"),
        F.count_if(flag).alias("_flags"),
        sum(missing, F.lit(0).cast("long")).alias("_missing"),
    )
    per_key = versions.groupBy(*keys).agg(
        F.sum("_current").alias("_current"),
        F.count_if(F.col("_rows") > 1).alias("_twice"),
        F.sum("_flags").alias("_flags"),
        F.sum("_missing").alias("_missing"),
    )
    counts = per_key.agg(
        F.count_if(F.col("_current") > 1).alias("one current version per key"),
        F.coalesce(F.sum("_twice"), F.lit(0)).alias("unique start day per key"),
        F.coalesce(F.sum("_flags"), F.lit(0)).alias("is_current agrees with valid_to"),
        F.coalesce(F.sum("_missing"), F.lit(0)).alias("required columns"),
    )
    return {name: n for name, n in counts.first().asDict().items() if n}


def audit(gold: DataFrame, keys: Sequence[str], required: Sequence[str]) -> None:
    """Raise when rows break an invariant of versioned tables; meant for rows that are not yet published."""
    found = violations(gold, keys, required)
    if found:
        raise ValueError("unsound versions: " + "; ".join(f"{k} ({n})" for k, n in found.items()))


def assert_sound(gold: DataFrame, keys: Sequence[str], required: Sequence[str]) -> None:
    """Raise when a versioned table breaks one of its invariants."""
    failures = [
        name
        for name, rows in {
            "one current version per key": one_current(gold, keys),
            "unique start day per key": unique_version(gold, keys),
            "is_current agrees with valid_to": flag_matches_valid_to(gold, keys),
            "required columns": not_null(gold, required),
        }.items()
        if not rows.isEmpty()
    ]
    if failures:
        raise ValueError("unsound versions: " + "; ".join(failures))
