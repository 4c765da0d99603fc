"""Slowly changing dimensions, type 2: one validity interval per version of a key.

A version is valid from its ``valid_from`` up to, but not including, its ``valid_to``; the current one
has no ``valid_to``. An incoming row opens a version when its key has no current one or when a tracked
column differs (NULL equals NULL). Keys absent from the input stay open.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.keys import (
    all_equal,
    dedup,
    duplicates,
    key_columns,
    same_key,
    with_key,
)

VALIDITY = ["valid_from", "valid_to", "is_current"]


def payload_columns(gold: DataFrame) -> list[str]:
    return [c for c in gold.columns if c not in VALIDITY]


def as_of(gold: DataFrame, day: dt.date) -> DataFrame:
    """Versions valid on ``day``."""
    still_open = F.col("valid_to").isNull() | (F.col("valid_to") > F.lit(day))
    return gold.filter((F.col("valid_from") <= F.lit(day)) & still_open)


def is_open() -> Column:
    """Whether a version is current. The test of ``valid_to`` lets a table partitioned by it skip the rest."""
    return F.col("valid_to").isNull() & F.coalesce("is_current", F.lit(False))


def current(gold: DataFrame) -> DataFrame:
    return gold.filter(is_open())


def rejected(
    incoming: DataFrame, keys: Sequence[str], columns: Sequence[str], reason: str
) -> DataFrame:
    """Input rows that ``scd2_apply`` passes over because another row of their key came with them."""
    rows = with_key(incoming.select(*columns), keys)
    lost = duplicates(rows, key_columns(keys)).select(*columns)
    return lost.withColumn("reject_reason", F.lit(reason))


def scd2_apply(
    gold: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    run_date: dt.date,
    *,
    same_day: str = "strict",
    touched_only: bool = False,
) -> DataFrame:
    """Gold after one run.

    ``same_day="strict"`` closes a version opened earlier the same day like any other;
    ``"replace"`` drops it in favour of the new one, which keeps ``(key, valid_from)`` unique.

    One full outer join between the current versions and the input, each shuffled once. Input rows
    that share a key give one version; ``rejected`` has the others.

    ``touched_only`` leaves out versions closed before ``run_date``: what remains is all that a table
    partitioned by ``valid_to`` has to rewrite.
    """
    payload = payload_columns(gold)
    rows = dedup(with_key(incoming.select(payload), keys), key_columns(keys))
    past = gold.filter(~is_open())
    if touched_only:
        # Rows that contradict themselves (closed, without an end) lie with the current ones.
        past = past.filter((F.col("valid_to") == F.lit(run_date)) | F.col("valid_to").isNull())
    stored = with_key(current(gold), keys).withColumn("_stored", F.lit(True)).alias("g")
    came = rows.withColumn("_came", F.lit(True)).alias("i")
    # Both sides are keyed alike, and the input already lies where its deduplication put it.
    both = stored.join(came, same_key("g", "i", keys), "full_outer")
    versions = _versions(payload, tracked, run_date, same_day == "replace")
    return past.unionByName(both.select(F.inline(versions)))


def _versions(
    payload: Sequence[str], tracked: Sequence[str], run_date: dt.date, replace: bool
) -> Column:
    """Versions that come out of one matched pair: ``g`` is the stored row, ``i`` the incoming one."""
    stored, came = F.col("g._stored").isNotNull(), F.col("i._came").isNotNull()
    changed = stored & came & ~all_equal("g", "i", tracked)
    today = F.lit(run_date)
    old = F.struct(
        *[F.col(f"g.{c}").alias(c) for c in payload],
        F.col("g.valid_from").alias("valid_from"),
        F.when(changed, today).otherwise(F.col("g.valid_to")).alias("valid_to"),
        (~changed).alias("is_current"),
    )
    new = F.struct(
        *[F.col(f"i.{c}").alias(c) for c in payload],
        today.alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    keep_old = stored
    if replace:
        keep_old = stored & ~(changed & (F.col("g.valid_from") == today))
    return F.array_compact(
        F.array(F.when(keep_old, old), F.when(came & (~stored | changed), new))
    )


def undo_day(gold: DataFrame, day: dt.date) -> DataFrame:
    """Gold as it was before the run of ``day``, which is the last one: its versions are gone, what it closed is open."""
    closed = F.col("valid_to") == F.lit(day)
    columns = {
        "valid_to": F.when(closed, None).otherwise(F.col("valid_to")),
        "is_current": F.coalesce(closed, F.lit(False)) | F.col("is_current"),
    }
    before = gold.filter(F.col("valid_from").isNull() | (F.col("valid_from") != F.lit(day)))
    return before.select([columns.get(c, F.col(c)).alias(c) for c in gold.columns])


def scd2_replay(
    gold: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    day: str,
) -> DataFrame:
    """Gold after applying several days of input in order, in one pass.

    Equal to one strict ``scd2_apply`` per value of ``day``, with one shuffle for all of them: each
    incoming row is compared with the row of its key before it, which suffices because a row that
    opens no version equals its predecessor in every tracked column. Rows older than the current
    version of their key are passed over (``late_rows`` has them), so repeating a batch changes
    nothing.
    """
    payload = payload_columns(gold)
    rows = dedup(incoming.select(*payload, F.col(day).alias("_day")), [*keys, "_day"])
    stored = current(gold).select(
        *payload, F.lit(None).cast("date").alias("_day"), F.struct(*VALIDITY).alias("_kept")
    )
    came = rows.select("*", F.lit(None).cast(stored.schema["_kept"].dataType).alias("_kept"))
    timeline = Window.partitionBy(*keys).orderBy(F.col("_day").asc_nulls_first())
    previous = F.lag(F.struct(*[F.col(c) for c in tracked])).over(timeline)
    state = F.struct(*[F.col(c) for c in tracked])
    since = F.max("_kept.valid_from").over(Window.partitionBy(*keys))
    opens = (
        stored.unionByName(came)
        .withColumn("_since", since)
        .filter("_kept IS NOT NULL OR _since IS NULL OR _day >= _since")
        .withColumn("_first", F.row_number().over(timeline) == 1)
        .withColumn("_same", previous.eqNullSafe(state))
        .filter(F.col("_kept").isNotNull() | F.col("_first") | ~F.col("_same"))
        # Whatever opens next ends a version; stored current versions of a key end together.
        .withColumn(
            "_until",
            F.when(F.col("_kept").isNotNull(), F.min("_day").over(Window.partitionBy(*keys)))
            .otherwise(F.lead("_day").over(timeline)),
        )
    )
    ended = F.col("_until").isNotNull()
    versions = opens.select(
        *payload,
        F.coalesce("_kept.valid_from", "_day").alias("valid_from"),
        F.when(ended, F.col("_until")).otherwise(F.col("_kept.valid_to")).alias("valid_to"),
        (~ended).alias("is_current"),
    )
    return gold.filter(~is_open()).unionByName(versions)


def late_rows(gold: DataFrame, incoming: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Input rows that ``scd2_replay`` passes over: older than the current version of their key.

    A row that says what a stored version of its day says is no news, and not late: a batch that is
    offered again has none.
    """
    names = key_columns(keys)
    since = with_key(current(gold), keys).groupBy(*names).agg(F.max("valid_from").alias("_since"))
    rows = with_key(incoming, keys).join(since, names)
    late = rows.filter(F.col(day) < F.col("_since"))
    return _news(gold, late, keys, day).select(*incoming.columns)


def disordered_rows(
    gold: DataFrame, incoming: DataFrame, keys: Sequence[str], day: str, last: dt.date
) -> DataFrame:
    """Input rows of days before ``last``, the latest day applied, that say what the timeline does not.

    Applied in order they might have opened a version, also where their key's current one began earlier: days
    that said the same again have left no trace.
    """
    late = with_key(incoming.filter(F.col(day) < F.lit(last)), keys)
    return _news(gold, late, keys, day).select(*incoming.columns)


def _news(gold: DataFrame, rows: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Keyed rows that differ from the version of their key and day."""
    told = with_key(gold, keys).alias("g")
    covers = (F.col("g.valid_from") <= F.col(f"i.{day}")) & (
        F.col("g.valid_to").isNull() | (F.col("g.valid_to") > F.col(f"i.{day}"))
    )
    same = same_key("g", "i", keys) & covers & all_equal("g", "i", payload_columns(gold))
    return rows.alias("i").join(told, same, "left_anti")


def scd2_rebuild(
    gold: DataFrame,
    observed: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    day: str,
) -> DataFrame:
    """Versions of the keys of ``observed``, built anew from all their rows, in the order of their days.

    ``observed`` is complete from its first day on; versions in ``gold`` that began earlier count as rows of the day
    they began. ``gold`` holds these keys only.
    """
    payload = payload_columns(gold)
    first = observed.agg(F.min(day).alias("_first"))
    older = gold.join(F.broadcast(first), F.col("valid_from") < F.col("_first"))
    told = older.select(*payload, F.col("valid_from").alias(day))
    rows = observed.select(*payload, day).unionByName(told)
    return scd2_replay(gold.limit(0), rows, keys, tracked, day)


def new_rows(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is not stored yet, one per key. Reads only the keys of ``existing``."""
    names = key_columns(keys)
    rows = dedup(with_key(incoming, keys), names)
    known = with_key(existing.select(*keys), keys).select(*names)
    return rows.join(known, names, "left_anti").select(incoming.columns)


def insert_if_absent(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows, never changed, and the incoming rows with unseen keys."""
    return existing.unionByName(new_rows(existing, incoming.select(existing.columns), keys))
