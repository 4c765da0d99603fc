"""The recurring jobs, each a composition of operators between landed files and gold tables.

Windows and run dates are always arguments, so a run can be repeated for a past day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline import schemas
from ledgerline.operators import clean, normalize, quality, resolve, scd2, scope, serve
from ledgerline.operators.match import ID, backlog
from ledgerline.operators.model import LinkageModel
from ledgerline.plans.cascade import MATCHED_BY, run_cascade
from ledgerline.session import settle
from ledgerline.sources import files, jdbc, tables, versions

MARKET_WINDOW = dt.timedelta(days=365)


# --- landing ---------------------------------------------------------------------------------------


def bootstrap_establishments(
    spark: SparkSession, csv_path: str, root: str, ingestion_date: dt.date
) -> str:
    """Full stock file to bronze; lines that are no rows of it go to the ``rejects`` folder."""
    columns = files.csv_header(spark, csv_path)
    stock, broken = files.split_csv(spark, csv_path, columns)
    keep_rejects(broken, root, "establishments", "lines", ingestion_date)
    return files.write_bronze(
        stock, root, "establishments", ingestion_date, run_type="stock", columns=columns
    )


def land_establishments(
    raw: DataFrame, root: str, since: dt.date, until: dt.date, ingestion_date: dt.date
) -> str:
    """Records processed from ``since`` to ``until`` to bronze."""
    flat = normalize.flatten_establishments(scope.updated_between(raw, since, until))
    return files.write_bronze(
        flat,
        root,
        "establishments",
        ingestion_date,
        run_type="diff",
        columns=schemas.BRONZE_ESTABLISHMENT_COLUMNS,
    )


def land_announcements(
    raw: DataFrame,
    root: str,
    since: dt.date,
    until: dt.date,
    ingestion_date: dt.date,
    run_type: str = "diff",
    department: str | None = None,
) -> str:
    """Announcements published in ``[since, until)`` to bronze."""
    rows = normalize.normalize_announcements(
        scope.window_announcements(raw, since, until, department)
    )
    return files.write_bronze(
        rows,
        root,
        "announcements",
        ingestion_date,
        run_type=run_type,
        columns=schemas.BRONZE_ANNOUNCEMENT_COLUMNS,
    )


def land_candidates(raw: DataFrame, root: str, department: str, ingestion_date: dt.date) -> str:
    """Active head offices of a department to bronze."""
    rows = normalize.normalize_candidates(scope.scope_candidates(raw, department))
    return files.write_bronze(
        rows,
        root,
        "candidates",
        ingestion_date,
        department=department,
        columns=schemas.BRONZE_CANDIDATE_COLUMNS,
    )


def land_all_candidates(raw: DataFrame, root: str, ingestion_date: dt.date) -> str:
    """Active head offices of all departments to bronze, in one pass; a rerun replaces its day of each department.

    A record without a postal code belongs to no department and is not landed, as in ``land_candidates``.
    """
    rows = normalize.normalize_candidates(scope.active_offices(raw))
    department = scope.department_of(F.col("code_postal"))
    return files.write_by_department(
        rows, root, "candidates", ingestion_date, department, schemas.BRONZE_CANDIDATE_COLUMNS
    )


def land_markets(
    national: DataFrame, root: str, department: str, since: dt.date, ingestion_date: dt.date
) -> str:
    """Current markets of a department's buyers to bronze, with the types they come with."""
    rows = scope.scope_markets(national, department, since)
    return files.write_bronze(rows, root, "markets", ingestion_date)


def quarantine(
    bronze: DataFrame, root: str, source: str, key: str, days: list[str], ingestion_date: dt.date
) -> DataFrame:
    """The well-formed rows; malformed ones go to the source's ``rejects`` folder with a reason."""
    good, rejects = clean.split_rejects(bronze, key, days)
    keep_rejects(rejects, root, source, "malformed", ingestion_date)
    return good


def keep_rejects(
    rejects: DataFrame, root: str, source: str, kind: str, run_date: dt.date
) -> None:
    """Rows with a ``reject_reason``, as JSON, to the source's ``rejects`` folder; a rerun replaces its day."""
    row = F.to_json(F.struct(*[c for c in rejects.columns if c != "reject_reason"]))
    kept = rejects.select("reject_reason", row.alias("row"))
    files.write_bronze(kept, root, source, run_date, run_type=f"rejects/{kind}")


# --- daily jobs ------------------------------------------------------------------------------------


def apply_run(
    table: str,
    layout: StructType,
    rows: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    run_date: dt.date,
    required: Sequence[str],
    same_day: str,
    provider: str,
) -> None:
    """One run into a gold table, published only if it is sound.

    Tables of plain files are versioned (see ``sources.versions``). One that was made otherwise, such as in a
    catalog with row-level writes, is written as its provider does and checked afterwards.
    """
    spark = rows.sparkSession
    if provider == "parquet":
        versions.create(spark, table, layout, keys)
    if versions.is_versioned(spark, table):
        versions.historize(
            table, layout, rows, tracked, run_date, same_day=same_day, required=required
        )
        return
    tables.ensure_gold(spark, table, layout, provider=provider)
    rule = "replace" if same_day == "redo" else same_day
    tables.historize(
        table, layout, rows, keys, tracked, run_date, same_day=rule, provider=provider
    )
    quality.assert_sound(spark.table(table), keys, required)


def establishments_daily(
    bronze: DataFrame,
    silver_table: str,
    gold_table: str,
    run_date: dt.date,
    *,
    rejects_root: str | None = None,
    provider: str = "parquet",
    same_day: str = "redo",
) -> None:
    """Bronze establishments to silver, then to versioned gold, which has to be sound.

    Running a day again replaces what its first run did. With a ``rejects_root``, every row is applied or kept
    with a reason: as malformed, or as repeated if cleaning leaves it out. Rows that are applied without a day
    that cannot be read are kept besides, as unreadable.
    """
    spark = bronze.sparkSession
    if rejects_root:
        bronze = quarantine(bronze, rejects_root, "establishments", "siret", [], run_date)
        twice = clean.repeated_establishments(bronze)
        keep_rejects(twice, rejects_root, "establishments", "repeated", run_date)
        lost = clean.unreadable_days(bronze, clean.ESTABLISHMENT_DAYS)
        keep_rejects(lost, rejects_root, "establishments", "unreadable", run_date)
    tables.replace_table(clean.clean_establishments(bronze), silver_table, provider)
    apply_run(
        gold_table,
        schemas.GOLD_ESTABLISHMENT,
        spark.table(silver_table),
        schemas.ESTABLISHMENT_KEYS,
        schemas.ESTABLISHMENT_TRACKED,
        run_date,
        ["siret", "valid_from", "is_current"],
        same_day,
        provider,
    )


def announcements_to_silver(bronze: DataFrame, silver_table: str) -> None:
    """Unseen announcements to silver; stored ones never change.

    Cleaned rows lie by ``id``, one row each and none NULL, so they meet the stored ones where they are.
    """
    tables.ensure_table(bronze.sparkSession, silver_table, schemas.SILVER_ANNOUNCEMENT)
    known = bronze.sparkSession.table(silver_table).select("id")
    new = clean.clean_announcements(bronze).join(known.hint("merge"), "id", "left_anti")
    tables.append_rows(new, silver_table)


def link_backlog(
    spark: SparkSession,
    silver_table: str,
    candidates: DataFrame,
    links_table: str,
    run_date: dt.date,
    model: LinkageModel | None = None,
    *,
    matches_table: str | None = None,
    provider: str = "parquet",
    same_day: str = "replace",
) -> None:
    """Match every announcement that has no current link, not only those of the last run.

    ``matches_table`` keeps the match records of the run as they were before they became versions. A second
    run of a day matches what the first one left, so it adds to it.
    """
    layout = schemas.GOLD_ANNOUNCEMENT_LINK
    if provider == "parquet":
        versions.create(spark, links_table, layout, schemas.LINK_KEYS)
    else:
        tables.ensure_gold(spark, links_table, layout, provider=provider)
    stored = spark.table(silver_table).select(MATCHED_BY)
    waiting = settle(backlog(stored, spark.table(links_table)))
    if waiting.isEmpty():
        return
    matches = run_cascade(waiting, candidates, model)
    if matches_table:
        tables.replace_table(matches, matches_table, provider)
        matches = spark.table(matches_table)
    else:
        matches = settle(matches)
    apply_run(
        links_table,
        layout,
        matches,
        schemas.LINK_KEYS,
        schemas.LINK_TRACKED,
        run_date,
        [ID, "match_method", "valid_from"],
        same_day,
        provider,
    )


def announcements_daily(
    bronze: DataFrame,
    candidates: DataFrame,
    silver_table: str,
    links_table: str,
    run_date: dt.date,
    model: LinkageModel | None = None,
    *,
    matches_table: str | None = None,
    rejects_root: str | None = None,
    provider: str = "parquet",
) -> None:
    """Bronze announcements to silver, and the backlog to versioned links, which have to be sound.

    With a ``rejects_root``, rows are applied, known already, or kept with a reason.
    """
    spark = bronze.sparkSession
    if rejects_root:
        bronze = quarantine(bronze, rejects_root, "announcements", "id", [], run_date)
        twice = clean.repeated_announcements(bronze)
        keep_rejects(twice, rejects_root, "announcements", "repeated", run_date)
        lost = clean.unreadable_days(bronze, clean.ANNOUNCEMENT_DAYS)
        keep_rejects(lost, rejects_root, "announcements", "unreadable", run_date)
    announcements_to_silver(bronze, silver_table)
    link_backlog(
        spark, silver_table, candidates, links_table, run_date, model,
        matches_table=matches_table, provider=provider,
    )


def markets_daily(
    national: DataFrame,
    registry: DataFrame,
    silver_table: str,
    links_table: str,
    run_date: dt.date,
    department: str = "08",
    *,
    matches_table: str | None = None,
    rejects_root: str | None = None,
    provider: str = "parquet",
    same_day: str = "redo",
) -> None:
    """A year of one department's markets, resolved and checked against the registry, to gold.

    The whole scope is redone on every run, since amounts get revised. Links that share a key with another
    one go to the ``rejects`` folder, malformed markets too.
    """
    scoped = scope.scope_markets(national, department, run_date - MARKET_WINDOW)
    if rejects_root:
        scoped = quarantine(scoped, rejects_root, "markets", "uid", [], run_date)
    tables.replace_table(clean.clean_markets(scoped), silver_table, provider)
    spark = national.sparkSession
    resolved = resolve.resolve_markets(spark.table(silver_table))
    validated = resolve.validate_against_registry(resolved, registry)
    if matches_table:
        tables.replace_table(validated, matches_table, provider)
        validated = spark.table(matches_table)
    else:
        validated = settle(validated)
    if rejects_root:
        keys = schemas.MARKET_KEYS
        twice = scd2.rejected(validated, keys, validated.columns, f"repeated {', '.join(keys)}")
        keep_rejects(twice, rejects_root, "markets", "repeated", run_date)
    apply_run(
        links_table,
        schemas.GOLD_MARKET_LINK,
        validated,
        schemas.MARKET_KEYS,
        schemas.MARKET_TRACKED,
        run_date,
        ["uid", "match_method"],
        same_day,
        provider,
    )


# --- serving ---------------------------------------------------------------------------------------


def sync_establishments(gold: DataFrame, url: str, table: str, properties: dict) -> int:
    """All versions of all establishments to the serving store."""
    rows = serve.check_contract(gold, schemas.GOLD_ESTABLISHMENT)
    return jdbc.replace_served(
        rows,
        url,
        table,
        properties,
        schemas.ESTABLISHMENT_KEYS,
        schemas.REQUIRED_ESTABLISHMENT,
    )


def sync_announcements(
    links: DataFrame, announcements: DataFrame, url: str, table: str, properties: dict
) -> int:
    """Linked announcements with their content to the serving store."""
    rows = serve.announcements_view(links, announcements)
    return jdbc.replace_served(
        rows, url, table, properties, schemas.LINK_KEYS, schemas.REQUIRED_ANNOUNCEMENT
    )


def sync_markets(market_links: DataFrame, url: str, table: str, properties: dict) -> int:
    """Market links with an establishment to the serving store."""
    rows = market_links.filter("siret_titulaire IS NOT NULL")
    return jdbc.replace_served(rows, url, table, properties, schemas.MARKET_KEYS)
