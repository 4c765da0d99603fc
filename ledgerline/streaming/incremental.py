"""Incremental runs: pick up new bronze files once, apply them, remember where the run ended."""

from __future__ import annotations

import datetime as dt
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline import schemas
from ledgerline.operators.clean import clean_establishments
from ledgerline.operators.model import LinkageModel
from ledgerline.operators.scd2 import disordered_rows, late_rows
from ledgerline.plans import daily
from ledgerline.session import settle
from ledgerline.sources import tables, versions
from ledgerline.sources.files import bronze_schema, read_bronze


def run_available_now(
    spark: SparkSession,
    path: str,
    columns: StructType,
    checkpoint: str,
    apply: Callable[[DataFrame, int], None],
    *,
    max_files: int | None = None,
) -> None:
    """Feed every bronze file not seen by an earlier run to ``apply``, with the number of its batch, then stop.

    A batch that fails is offered again by the next run, with the same number.
    """
    reader = spark.readStream.schema(bronze_schema(columns))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        reader.parquet(path)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def mark_of(checkpoint: str) -> str:
    """Name under which a versioned table records the last batch of a stream."""
    return f"batch-{zlib.crc32(checkpoint.rstrip('/').encode()):08x}"


def is_applied(spark: SparkSession, table: str, checkpoint: str, number: int) -> bool:
    """Whether the table has a batch already: its number is published together with its rows."""
    if not versions.is_versioned(spark, table):
        return False
    return number <= int(versions.state(spark, table).marks.get(mark_of(checkpoint), -1))


def establishments_stream(
    spark: SparkSession,
    bronze_path: str,
    checkpoint: str,
    gold_table: str,
    rejects_root: str | None = None,
    *,
    late: str = "reject",
    max_files: int | None = None,
) -> None:
    """New establishment files to versioned gold; a batch of several days is applied in the order of its days.

    ``late="reject"`` passes over rows of a day before their key's current version, into the ``rejects`` folder;
    ``late="insert"`` builds the timelines of keys whose days come late anew, from all their landed rows, so that days
    may come in any order. In a versioned table a batch and its number appear together, so
    a batch that is offered again changes nothing; its rejects have a folder of their own.
    """
    layout, keys = schemas.GOLD_ESTABLISHMENT, schemas.ESTABLISHMENT_KEYS
    tracked, day = schemas.ESTABLISHMENT_TRACKED, "ingestion_date"
    required = ["siret", "valid_from", "is_current"]
    versions.create(spark, gold_table, layout, keys)

    def reject(late_ones: DataFrame, last: dt.date, number: int) -> None:
        marked = late_ones.withColumn("reject_reason", F.lit("older than the current version"))
        daily.keep_rejects(marked, rejects_root, "establishments", f"late/batch={number}", last)

    def apply(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        if is_applied(own, gold_table, checkpoint, number):
            return
        # Read by every step below, also after a part was taken out of it.
        rows = settle(clean_establishments(batch, per=[day]))
        last = batch.agg(F.max(day)).first()[0]
        if last is None:
            return
        gold = tables.read_table(own, gold_table, layout)
        if rejects_root and late == "reject":
            reject(late_rows(gold, rows, keys, day), last, number)
        if not versions.is_versioned(own, gold_table):
            tables.historize_days(gold_table, layout, rows, keys, tracked, day)
            return
        before = versions.state(own, gold_table).marks.get("last-day")
        if late == "insert" and before:
            upto = dt.date.fromisoformat(before)
            last = max(last, upto)
            affected = disordered_rows(gold, rows, keys, day, upto).select(*keys).distinct()
            affected = settle(affected)
            if not affected.isEmpty():
                # Landed rows that no batch had yet only come early: offered again, they are no news.
                landed = read_bronze(own, bronze_path, schemas.BRONZE_ESTABLISHMENT)
                landed = landed.join(affected, keys, "left_semi")
                observed = settle(clean_establishments(landed, per=[day]))
                versions.insert_days(
                    gold_table, layout, observed, tracked, day, required=required
                )
                rows = rows.join(affected, keys, "left_anti")
        marks = {mark_of(checkpoint): str(number), "last-day": last.isoformat()}
        versions.historize_days(
            gold_table, layout, rows, tracked, day, required=required, marks=marks
        )

    run_available_now(
        spark, bronze_path, schemas.BRONZE_ESTABLISHMENT, checkpoint, apply, max_files=max_files
    )
    spark.catalog.refreshTable(gold_table)


def announcements_stream(
    spark: SparkSession,
    bronze_path: str,
    checkpoint: str,
    silver_table: str,
    links_table: str,
    candidates: DataFrame,
    model: LinkageModel | None = None,
) -> None:
    """New announcement files to silver, and whatever has no current link to versioned links.

    The backlog is the whole silver table, so announcements of a batch whose matching failed are
    matched by the next one.
    """

    def apply(batch: DataFrame, number: int) -> None:
        last = batch.agg(F.max("ingestion_date")).first()[0]
        if last is None:
            return
        daily.announcements_to_silver(batch.drop("ingestion_date"), silver_table)
        # The batch has a session of its own, the one that knows what was just written.
        own = batch.sparkSession
        daily.link_backlog(own, silver_table, candidates, links_table, last, model)

    run_available_now(spark, bronze_path, schemas.BRONZE_ANNOUNCEMENT, checkpoint, apply)
    for table in (silver_table, links_table):
        if spark.catalog.tableExists(table):
            spark.catalog.refreshTable(table)
