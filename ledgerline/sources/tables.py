"""Catalog tables of the silver and gold layers.

Gold tables are partitioned by ``valid_to``: the current versions are one partition, the versions
closed on a day another. A run rewrites the current partition and adds the one of its day; versions
closed earlier are neither read nor written again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.operators.scd2 import current, is_open, new_rows, scd2_apply, scd2_replay
from ledgerline.session import discard, scratch_path


def ensure_table(
    spark: SparkSession,
    table: str,
    layout: StructType,
    *,
    provider: str = "parquet",
    partition_by: Sequence[str] = (),
    location: str | None = None,
) -> None:
    """Create an empty table of the given layout unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in layout.fields)
    statement = f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {provider}"
    if partition_by:
        if provider == "parquet":
            # An overwrite replaces the partitions it has rows for, not the table.
            statement += " OPTIONS (partitionOverwriteMode 'dynamic')"
        statement += f" PARTITIONED BY ({', '.join(partition_by)})"
    if location:
        statement += f" LOCATION '{location}'"
    spark.sql(statement)


def ensure_gold(spark: SparkSession, table: str, layout: StructType, **options) -> None:
    ensure_table(spark, table, layout, partition_by=["valid_to"], **options)


def read_table(spark: SparkSession, table: str, layout: StructType | None = None) -> DataFrame:
    """Table by name, in the column order of ``layout`` (partition columns are stored last)."""
    df = spark.table(table)
    return df.select(layout.fieldNames()) if layout else df


def replace_table(df: DataFrame, table: str, provider: str = "parquet") -> None:
    """Full overwrite. Plain files are replaced in place, so ``df`` must not read the same table."""
    if provider == "parquet":
        df.write.mode("overwrite").format(provider).saveAsTable(table)
    else:
        df.writeTo(table).using(provider).createOrReplace()


def append_rows(df: DataFrame, table: str) -> None:
    """Add rows, columns matched by name."""
    df.select(df.sparkSession.table(table).columns).write.insertInto(table)


def replace_partitions(df: DataFrame, table: str, provider: str = "parquet") -> None:
    """Replace the partitions that ``df`` has rows for; all others stay as they are.

    ``df`` may read the table it replaces partitions of. The table is one made by ``ensure_table``
    with partitions.
    """
    rows = df.select(df.sparkSession.table(table).columns)
    if provider == "parquet":
        # Plain files are not swapped atomically: a finished copy in the shared folder means that a
        # failure while writing loses nothing. It goes once the table has the rows.
        path = scratch_path(rows.sparkSession, "swap")
        rows.write.parquet(path)
        copy = rows.sparkSession.read.schema(rows.schema).parquet(path)
        copy.write.insertInto(table, overwrite=True)
        discard(rows.sparkSession, path)
    else:
        rows.writeTo(table).overwritePartitions()


def insert_if_absent_into(table: str, incoming: DataFrame, keys: Sequence[str]) -> None:
    """Append the incoming rows whose key the table lacks. Running it again adds nothing."""
    stored = incoming.sparkSession.table(table)
    append_rows(new_rows(stored, incoming.select(stored.columns), keys), table)


def historize(
    table: str,
    layout: StructType,
    incoming: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    run_date: dt.date,
    *,
    same_day: str = "strict",
    provider: str = "parquet",
) -> None:
    """Apply one run to a gold table."""
    gold = read_table(incoming.sparkSession, table, layout)
    after = scd2_apply(
        gold, incoming, keys, tracked, run_date, same_day=same_day, touched_only=True
    )
    replace_partitions(after, table, provider)


def historize_days(
    table: str,
    layout: StructType,
    incoming: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    day: str,
    provider: str = "parquet",
) -> None:
    """Apply several days of input to a gold table in one pass."""
    spark = incoming.sparkSession
    gold = read_table(spark, table, layout)
    after = scd2_replay(current(gold), incoming, keys, tracked, day)
    # Versions closed earlier on one of these days share their partition with the new ones. There are
    # no more such days than bronze partitions in the batch.
    days = F.broadcast(incoming.select(F.col(day).alias("valid_to")).distinct())
    past = gold.filter(~is_open()).join(days, "valid_to", "left_semi")
    replace_partitions(after.unionByName(past.select(after.columns)), table, provider)
