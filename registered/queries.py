"""One query per operator, over whole tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ledgerline import schemas
from ledgerline.functions.text import siren_in_text
from ledgerline.operators import (
    clean,
    evaluate,
    linkage,
    match,
    normalize,
    quality,
    resolve,
    scd2,
    scope,
    serve,
)
from ledgerline.plans import daily, serving
from ledgerline.plans.cascade import run_cascade
from ledgerline.session import scratch_path, settle
from ledgerline.sources import files, tables, versions
from ledgerline.streaming import incremental
from registered import inputs
from registered.inputs import DAY_1, DAY_2, DAY_3, MODEL, table

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}

SOME_SIRET = "000000007" + "00019"
MARKET_DAY = dt.date(1998, 6, 1)
CHANGED_SIRET = "000000003" + "00019"
SOME_SUPPLIER = "000000007" + "00027"


def register(query: Query) -> Query:
    REGISTERED[query.__name__] = query
    return query


def empty(spark: SparkSession, layout) -> DataFrame:
    return spark.createDataFrame([], layout)


# --- landing and bronze ----------------------------------------------------------------------------


@register
def csv_bootstrap(spark, sf_dir):
    """Stock file written as CSV, read back as text, landed in bronze, read from there."""
    root = scratch_path(spark, "bootstrap")
    bronze = inputs.stock(spark, sf_dir)
    filled = bronze.select([F.coalesce(c, F.lit("")).alias(c) for c in bronze.columns])
    filled.write.option("header", True).option("emptyValue", "").csv(f"{root}/stock")
    path = daily.bootstrap_establishments(spark, f"{root}/stock", root, DAY_1)
    return files.read_bronze(spark, path, schemas.BRONZE_ESTABLISHMENT)


@register
def bronze_by_department(spark, sf_dir):
    """Candidates landed per department and read back; departments keep their leading zero."""
    root = scratch_path(spark, "bronze")
    raw = normalize.parse_json(
        inputs.raw_establishments(spark, sf_dir), "json", schemas.RAW_ESTABLISHMENT
    )
    paths = [daily.land_candidates(raw, root, d, DAY_1) for d in ("02", "17")]
    landed = files.read_bronze(spark, paths[0], schemas.BRONZE_CANDIDATE, by_department=True)
    return landed.select(
        "siren", "siret", "denomination", "code_postal", "department", "ingestion_date"
    )


@register
def bronze_all_departments(spark, sf_dir):
    """Candidates of every department landed in one pass and read back, after a first run with wrong postal codes."""
    root = scratch_path(spark, "bronze")
    raw = normalize.parse_json(
        inputs.raw_establishments(spark, sf_dir), "json", schemas.RAW_ESTABLISHMENT
    )
    postal = F.concat(F.lit("97"), F.col("adresseEtablissement.codePostalEtablissement"))
    wrong = F.col("adresseEtablissement").withField("codePostalEtablissement", postal)
    daily.land_all_candidates(raw.withColumn("adresseEtablissement", wrong), root, DAY_1)
    path = daily.land_all_candidates(raw, root, DAY_1)
    landed = files.read_bronze(spark, path, schemas.BRONZE_CANDIDATE, by_department=True)
    return landed.select(
        "siren", "siret", "denomination", "code_postal", "department", "ingestion_date"
    )


@register
def rejected_lines(spark, sf_dir):
    """Customers as CSV and as JSON lines, some of them broken: rows that are kept, and lines that are not."""
    root = scratch_path(spark, "lines")
    lines = inputs.broken_lines(spark, sf_dir)
    columns = ["key", "name", "nation", "segment"]
    # Text written as a single unquoted CSV column is the line itself; every file gets the header.
    csv = lines.select(F.col("csv_line").alias(",".join(columns))).write.option("header", True)
    csv.option("sep", "\x01").option("quote", "").csv(f"{root}/csv")
    lines.select("json_line").write.text(f"{root}/json")
    good_csv, bad_csv = files.split_csv(spark, f"{root}/csv", columns)
    layout = StructType([StructField("key", LongType()), StructField("name", StringType())])
    good_json, bad_json = files.split_json(spark, f"{root}/json", layout)

    def kept(df, source):
        none = F.lit(None).cast("string")
        key = F.col("key").cast("string")
        return df.select(F.lit(source).alias("source"), key.alias("key"), "name", none.alias("row"), none.alias("reject_reason"))

    def lost(df, source):
        none = F.lit(None).cast("string")
        return df.select(F.lit(source).alias("source"), none.alias("key"), none.alias("name"), "row", "reject_reason")

    parts = [kept(good_csv, "csv"), kept(good_json, "json"), lost(bad_csv, "csv"), lost(bad_json, "json")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@register
def flatten_establishments(spark, sf_dir):
    raw = inputs.raw_establishments(spark, sf_dir)
    return normalize.flatten_establishments(
        normalize.parse_json(raw, "json", schemas.RAW_ESTABLISHMENT)
    )


@register
def normalize_announcements(spark, sf_dir):
    return inputs.bronze_announcements(spark, sf_dir)


@register
def normalize_candidates(spark, sf_dir):
    return inputs.candidates_from_json(spark, sf_dir)


@register
def extract_siren(spark, sf_dir):
    """First digit run where it is an identifier: of every document's whole text, of the text after a
    spelled identifier, and of a JSON array that lists one before the text."""
    key = F.lpad(F.col("doc_id").cast("string"), 9, "0")
    spelled = F.regexp_replace(key, "(\\d{3})(?=\\d)", "$1 ")
    kind = F.col("doc_id") % 3
    text = (
        F.when(kind == 0, F.concat(F.lit("RCS "), spelled, F.lit(", "), F.coalesce("text", F.lit(""))))
        .when(kind == 1, F.to_json(F.array(F.concat(F.lit("SIREN "), key), F.coalesce("text", F.lit("")))))
        .otherwise(F.col("text"))
    )
    return table(spark, sf_dir, "documents").select("doc_id", siren_in_text(text).alias("siren"))


@register
def scope_markets(spark, sf_dir):
    return scope.scope_markets(inputs.bronze_markets(spark, sf_dir), "03", dt.date(1998, 1, 1))


@register
def window_announcements(spark, sf_dir):
    raw = inputs.parsed_announcements(spark, sf_dir)
    return scope.window_announcements(
        raw, dt.date(1997, 1, 1), dt.date(1998, 1, 1), department="08"
    ).select("id", "dateparution", "numerodepartement")


@register
def updated_between(spark, sf_dir):
    return scope.updated_between(
        inputs.bronze_establishments(spark, sf_dir), DAY_1 + dt.timedelta(days=1), DAY_2
    ).select("siret", "dateDernierTraitementEtablissement")


@register
def scope_candidates(spark, sf_dir):
    raw = inputs.raw_establishments(spark, sf_dir)
    parsed = normalize.parse_json(raw, "json", schemas.RAW_ESTABLISHMENT)
    return normalize.normalize_candidates(scope.scope_candidates(parsed, "08"))


# --- silver ----------------------------------------------------------------------------------------


@register
def clean_establishments(spark, sf_dir):
    return clean.clean_establishments(inputs.bronze_establishments(spark, sf_dir))


@register
def clean_announcements(spark, sf_dir):
    return clean.clean_announcements(settle(inputs.bronze_announcements(spark, sf_dir)))


@register
def clean_markets(spark, sf_dir):
    return inputs.markets(spark, sf_dir)


@register
def reject_quarantine(spark, sf_dir):
    _, rejects = clean.split_rejects(
        inputs.bronze_establishments(spark, sf_dir),
        "siret",
        ["dateCreationEtablissement", "dateDernierTraitementEtablissement"],
    )
    return rejects.select("siren", "siret", "dateCreationEtablissement", "reject_reason")


@register
def insert_if_absent(spark, sf_dir):
    """Stock first, then the diff: known establishments keep the row of the stock."""
    stored = clean.clean_establishments(inputs.stock(spark, sf_dir))
    incoming = clean.clean_establishments(inputs.diff(spark, sf_dir))
    return scd2.insert_if_absent(stored, incoming, ["siret"])


# --- versions --------------------------------------------------------------------------------------


def establishment_gold(spark, sf_dir) -> DataFrame:
    """Establishments after the stock and the diff."""
    gold = empty(spark, schemas.GOLD_ESTABLISHMENT)
    for bronze, day in ((inputs.stock, DAY_1), (inputs.diff, DAY_2)):
        gold = settle(
            scd2.scd2_apply(
                gold,
                clean.clean_establishments(bronze(spark, sf_dir)),
                schemas.ESTABLISHMENT_KEYS,
                schemas.ESTABLISHMENT_TRACKED,
                day,
            )
        )
    return gold


@register
def scd2_establishments(spark, sf_dir):
    return establishment_gold(spark, sf_dir)


@register
def scd2_as_of(spark, sf_dir):
    gold = establishment_gold(spark, sf_dir)
    return scd2.as_of(gold, dt.date(2024, 1, 15)).select(
        "siret", "activite_principale", "etablissement_siege", "valid_from", "valid_to"
    )


def link_matches(announced: DataFrame, candidates: DataFrame) -> DataFrame:
    """Match records of all announcements by declared company only."""
    exact = match.exact_matches(announced, candidates)
    return match.complete_unresolved(announced, exact)


def offices(spark, sf_dir) -> DataFrame:
    return settle(inputs.candidates(spark, sf_dir))


def silver_announcements(spark, sf_dir) -> DataFrame:
    return settle(inputs.announcements(spark, sf_dir))


def link_gold(announced: DataFrame, candidates: DataFrame) -> DataFrame:
    """Links after two runs: in the second, resolved links of sales are lost and others drift."""
    first = settle(link_matches(announced, candidates))
    kind = announced.select(F.col("id").alias(match.ID), F.col("famille_avis").alias("kind"))
    lost = F.coalesce(F.col("kind") == "Ventes", F.lit(False))
    second = first.join(kind, match.ID).withColumns(
        {
            "siret_siege": F.when(~lost, F.col("siret_siege")),
            "match_method": F.when(lost, schemas.UNRESOLVED).otherwise(F.col("match_method")),
            "match_confidence": F.when(~lost, F.col("match_confidence") * 0.5),
        }
    )
    gold = empty(announced.sparkSession, schemas.GOLD_ANNOUNCEMENT_LINK)
    for matches, day in ((first, DAY_1), (second, DAY_2)):
        gold = settle(
            scd2.scd2_apply(gold, matches, schemas.LINK_KEYS, schemas.LINK_TRACKED, day)
        )
    return gold


@register
def scd2_links(spark, sf_dir):
    return link_gold(silver_announcements(spark, sf_dir), offices(spark, sf_dir))


def validated_markets(spark, sf_dir) -> DataFrame:
    return resolve.validate_against_registry(
        resolve.resolve_markets(inputs.markets(spark, sf_dir)), inputs.registry(spark, sf_dir)
    )


def market_gold(spark, sf_dir) -> DataFrame:
    """Market links after two runs; the second revises the amounts of first lots.

    What the first run leaves is stored. The links are worked out twice, and the result is handed on: to store either
    would be more bytes than to do so.
    """
    links = validated_markets(spark, sf_dir)
    revised = F.when(F.col("objet") == "Lot 1", F.col("montant") + 1000.0).otherwise(
        F.col("montant")
    )
    keys, tracked = schemas.MARKET_KEYS, schemas.MARKET_TRACKED
    gold = empty(spark, schemas.GOLD_MARKET_LINK)
    first = settle(scd2.scd2_apply(gold, links, keys, tracked, DAY_1))
    return scd2.scd2_apply(first, links.withColumn("montant", revised), keys, tracked, DAY_2)


@register
def scd2_markets_nullsafe(spark, sf_dir):
    return market_gold(spark, sf_dir)


@register
def market_duplicates(spark, sf_dir):
    """Market links passed over because another one has their key; with the applied ones, all rows."""
    links = validated_markets(spark, sf_dir)
    return scd2.rejected(links, schemas.MARKET_KEYS, links.columns, "repeated key")


@register
def late_days(spark, sf_dir):
    """The diff offered again, and as of a day between: what then contradicts the current versions."""
    rows = clean.clean_establishments(inputs.diff(spark, sf_dir))
    offered = rows.withColumn("day", F.lit(DAY_2)).unionByName(
        rows.withColumn("day", F.lit(dt.date(2024, 1, 15)))
    )
    gold = establishment_gold(spark, sf_dir)
    return scd2.late_rows(gold, offered, schemas.ESTABLISHMENT_KEYS, "day").select(
        "siret", "activite_principale", "day"
    )


def three_days(spark, sf_dir) -> DataFrame:
    """Cleaned establishments of three days, one column ``day``: stock, diff, stock again."""
    days = [(inputs.stock, DAY_1), (inputs.diff, DAY_2), (inputs.stock, DAY_3)]
    rows = [
        clean.clean_establishments(bronze(spark, sf_dir)).withColumn("day", F.lit(day))
        for bronze, day in days
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@register
def scd2_replay(spark, sf_dir):
    return scd2.scd2_replay(
        empty(spark, schemas.GOLD_ESTABLISHMENT),
        three_days(spark, sf_dir),
        schemas.ESTABLISHMENT_KEYS,
        schemas.ESTABLISHMENT_TRACKED,
        "day",
    )


@register
def incremental_scd2(spark, sf_dir):
    """Stock and diff landed in bronze, picked up by two streaming runs into a gold table."""
    root = scratch_path(spark, "stream")
    gold = f"gold_{uuid.uuid4().hex}"
    tables.ensure_gold(
        spark, gold, schemas.GOLD_ESTABLISHMENT, location=f"{root}/gold"
    )
    for bronze, day in ((inputs.stock, DAY_1), (inputs.diff, DAY_2)):
        path = files.write_bronze(
            bronze(spark, sf_dir),
            root,
            "establishments",
            day,
            columns=schemas.BRONZE_ESTABLISHMENT_COLUMNS,
        )
        incremental.establishments_stream(spark, path, f"{root}/checkpoint", gold)
    after = settle(tables.read_table(spark, gold, schemas.GOLD_ESTABLISHMENT))
    spark.sql(f"DROP TABLE {gold}")
    return after


# --- matching --------------------------------------------------------------------------------------


@register
def exact_match(spark, sf_dir):
    return match.exact_matches(inputs.announcements(spark, sf_dir), offices(spark, sf_dir))


@register
def unmatched(spark, sf_dir):
    announced = silver_announcements(spark, sf_dir)
    exact = match.exact_matches(announced, offices(spark, sf_dir))
    return match.unmatched(announced, exact).select("id", "siren_declared", "commercant")


@register
def backlog(spark, sf_dir):
    """Announcements without a current link, where unresolved links have been closed."""
    announced = silver_announcements(spark, sf_dir)
    closed = F.coalesce(F.col("match_method") == schemas.UNRESOLVED, F.lit(True))
    links = link_matches(announced, offices(spark, sf_dir)).withColumns(
        {"is_current": ~closed, "valid_to": F.when(closed, F.lit(DAY_1))}
    )
    return match.backlog(announced, links).select("id", "famille_avis")


@register
def unresolved_completion(spark, sf_dir):
    return link_matches(silver_announcements(spark, sf_dir), offices(spark, sf_dir))


@register
def prepare_left(spark, sf_dir):
    return linkage.prepare_announcements(inputs.announcements(spark, sf_dir))


@register
def prepare_right(spark, sf_dir):
    return linkage.prepare_candidates(inputs.candidates(spark, sf_dir))


def linkage_sides(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Prepared announcements without a declared company, and prepared candidates."""
    announced = inputs.announcements(spark, sf_dir).filter("siren_declared IS NULL")
    return (
        settle(linkage.prepare_announcements(announced)),
        settle(linkage.prepare_candidates(inputs.candidates(spark, sf_dir))),
    )


@register
def block_counts(spark, sf_dir):
    """Pairs of each block of the pairing rule, from counts."""
    left, right = linkage_sides(spark, sf_dir)
    counts = linkage.block_counts(linkage.values(left), linkage.values(right))
    return counts.withColumn("pairs", F.col("pairs").cast("long"))


@register
def near_addresses(spark, sf_dir):
    left, right = linkage_sides(spark, sf_dir)
    return linkage.near_addresses(linkage.values(left), linkage.values(right), MODEL)


@register
def gamma_histogram(spark, sf_dir):
    """Pairs of the pairing rule by address level, the counts that EM runs on."""
    left, right = linkage_sides(spark, sf_dir)
    vl, vr = linkage.values(left), linkage.values(right)
    near = linkage.near_addresses(vl, vr, MODEL)
    counts = linkage.block_address_counts(vl, vr, near, MODEL)
    return counts.withColumn("pairs", F.col("pairs").cast("long")).filter("pairs > 0")


def unmatched_sides(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """What the fuzzy stage of the cascade takes: announcements that the exact stage left over, and all candidates."""
    announced = silver_announcements(spark, sf_dir)
    left_over = match.unmatched(announced, match.exact_matches(announced, offices(spark, sf_dir)))
    return (
        settle(linkage.prepare_announcements(left_over)),
        settle(linkage.prepare_candidates(inputs.candidates(spark, sf_dir))),
    )


@register
def unmatched_block_counts(spark, sf_dir):
    left, right = unmatched_sides(spark, sf_dir)
    counts = linkage.block_counts(linkage.values(left), linkage.values(right))
    return counts.withColumn("pairs", F.col("pairs").cast("long"))


@register
def unmatched_near_addresses(spark, sf_dir):
    left, right = unmatched_sides(spark, sf_dir)
    return linkage.near_addresses(linkage.values(left), linkage.values(right), MODEL)


@register
def unmatched_gamma_histogram(spark, sf_dir):
    left, right = unmatched_sides(spark, sf_dir)
    vl, vr = linkage.values(left), linkage.values(right)
    near = linkage.near_addresses(vl, vr, MODEL)
    counts = linkage.block_address_counts(vl, vr, near, MODEL)
    return counts.withColumn("pairs", F.col("pairs").cast("long")).filter("pairs > 0")


def declared_pairs(spark, sf_dir) -> DataFrame:
    """Names and addresses of every announcement and the candidate it declares."""
    announced, candidates = silver_announcements(spark, sf_dir), offices(spark, sf_dir)
    exact = match.exact_matches(announced, candidates)
    left = linkage.prepare_announcements(announced).select(
        F.col("uid").alias(match.ID),
        F.col("denomination_clean").alias("name_l"),
        F.col("adresse_clean").alias("address_l"),
    )
    right = linkage.prepare_candidates(candidates).select(
        F.col("uid").alias("siret_siege"),
        F.col("denomination_clean").alias("name_r"),
        F.col("adresse_clean").alias("address_r"),
    )
    return exact.select(match.ID, "siret_siege").join(left, match.ID).join(right, "siret_siege")


@register
def gamma_levels(spark, sf_dir):
    """Agreement levels and match probability of declared pairs."""
    scored = linkage.score_pairs(declared_pairs(spark, sf_dir), MODEL)
    return scored.select(
        match.ID,
        "siret_siege",
        "name_level",
        "address_level",
        F.round("match_probability", 6).alias("match_probability"),
    )


@register
def fuzzy_score_fixed_params(spark, sf_dir):
    """Best accepted candidate of each distinct name and address."""
    left, right = linkage_sides(spark, sf_dir)
    vl, vr = settle(linkage.values(left)), settle(linkage.values(right))
    near = settle(linkage.near_addresses(vl, vr, MODEL))
    best = linkage.best_matches(vl, vr, MODEL, near)
    return best.withColumn("match_probability", F.round("match_probability", 6))


@register
def unmatched_fuzzy_scores(spark, sf_dir):
    """Best accepted candidate of each name and address that the exact stage left over."""
    left, right = unmatched_sides(spark, sf_dir)
    vl, vr = settle(linkage.values(left)), settle(linkage.values(right))
    near = settle(linkage.near_addresses(vl, vr, MODEL))
    best = linkage.best_matches(vl, vr, MODEL, near)
    return best.withColumn("match_probability", F.round("match_probability", 6))


def cascade_result(spark, sf_dir, model) -> DataFrame:
    matches = run_cascade(inputs.announcements(spark, sf_dir), offices(spark, sf_dir), model)
    return matches.withColumn("match_confidence", F.round("match_confidence", 6))


@register
def cascade_fixed_params(spark, sf_dir):
    return cascade_result(spark, sf_dir, MODEL)


@register
def cascade(spark, sf_dir):
    """The cascade with a model trained on the data."""
    return cascade_result(spark, sf_dir, None)


@register
def fuzzy_em_trained(spark, sf_dir):
    """Parameters of the trained model, one row per compared field and level."""
    return trained_parameters(spark, *linkage_sides(spark, sf_dir))


@register
def unmatched_em_trained(spark, sf_dir):
    """Parameters of the model that the cascade trains: on what the exact stage left over."""
    return trained_parameters(spark, *unmatched_sides(spark, sf_dir))


def trained_parameters(spark, left: DataFrame, right: DataFrame) -> DataFrame:
    model = linkage.fit(left, right)
    rows = [
        (name, level, m, u, model.prior)
        for name, ms, us in (
            ("name", model.m_name, model.u_name),
            ("address", model.m_address, model.u_address),
        )
        for level, (m, u) in enumerate(zip(ms, us, strict=True))
    ]
    frame = spark.createDataFrame(rows, "field string, level int, m double, u double, prior double")
    return frame.withColumns({c: F.round(c, 6) for c in ("m", "u", "prior")})


def scored_offers(spark, sf_dir) -> DataFrame:
    offers = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("A"), F.col("l_orderkey").cast("string")).alias("uid_l"),
        F.concat(inputs.padded("l_suppkey"), F.lit("00027")).alias("uid_r"),
        (F.col("l_quantity") / 100.0).alias("match_probability"),
    )
    return match.fuzzy_records(offers)


@register
def best_match(spark, sf_dir):
    """Best of the scored suppliers of each order."""
    return match.best_match(scored_offers(spark, sf_dir))


@register
def combined_matches(spark, sf_dir):
    """Exact matches, and for the announcements left over the best of the suppliers scored for their order."""
    announced = silver_announcements(spark, sf_dir)
    exact = settle(match.exact_matches(announced, offices(spark, sf_dir)))
    left_over = match.unmatched(announced, exact).select(F.col("id").alias(match.ID))
    return match.combine_matches(exact, scored_offers(spark, sf_dir).join(left_over, match.ID))


@register
def evaluation_set(spark, sf_dir):
    blind, truth = evaluate.hold_out(silver_announcements(spark, sf_dir), offices(spark, sf_dir))
    return blind.join(truth, "id").select("id", "commercant", "ville", "true_siret_siege")


def measured(spark, sf_dir, model) -> DataFrame:
    report = evaluate.evaluate_linkage(
        silver_announcements(spark, sf_dir), offices(spark, sf_dir), model
    )
    return report.withColumns({c: F.round(c, 9) for c in ("precision", "recall")})


@register
def precision_recall(spark, sf_dir):
    return measured(spark, sf_dir, MODEL)


@register
def precision_recall_trained(spark, sf_dir):
    return measured(spark, sf_dir, None)


# --- markets ---------------------------------------------------------------------------------------


@register
def resolve_markets(spark, sf_dir):
    return resolve.resolve_markets(inputs.markets(spark, sf_dir))


@register
def validate_markets(spark, sf_dir):
    return validated_markets(spark, sf_dir)


@register
def coverage_report(spark, sf_dir):
    report = resolve.coverage_report(validated_markets(spark, sf_dir))
    return report.withColumns(
        {c: F.round(c, 9) for c in ("resolved_share", "validated_share")}
    )


@register
def unresolved_composition(spark, sf_dir):
    return resolve.unresolved_composition(inputs.markets(spark, sf_dir))


# --- jobs ------------------------------------------------------------------------------------------


def job_tables(spark, run: Callable[[list[str], str], None], layout, result: int) -> DataFrame:
    """Run a job with tables of its own, return the one at place ``result`` and drop all."""
    names = [f"job_{uuid.uuid4().hex}" for _ in range(3)]
    run(names, scratch_path(spark, "job"))
    after = settle(tables.read_table(spark, names[result], layout))
    for name in names:
        versions.drop(spark, name)
    return after


@register
def establishments_daily(spark, sf_dir):
    """The daily job on two days: bronze with rows that lack a key, silver, versioned gold."""

    def run(names, root):
        for bronze, day in ((inputs.stock, DAY_1), (inputs.diff, DAY_2)):
            rows = bronze(spark, sf_dir).unionByName(inputs.malformed(spark, sf_dir))
            daily.establishments_daily(rows, names[0], names[1], day, rejects_root=root)

    return job_tables(spark, run, schemas.GOLD_ESTABLISHMENT, 1)


@register
def establishments_rerun(spark, sf_dir):
    """The daily job on two days, the second of them run twice: first with wrong activities and rows too many."""

    def run(names, root):
        first, second = inputs.stock(spark, sf_dir), inputs.diff(spark, sf_dir)
        activity = F.concat(F.lit("WRONG "), F.coalesce("siret", F.lit("")))
        wrong = first.unionByName(second).withColumn("activitePrincipaleEtablissement", activity)
        strays = second.withColumn("siret", F.concat(F.lit("9"), "siret"))
        for rows, day in ((first, DAY_1), (wrong.unionByName(strays), DAY_2), (second, DAY_2)):
            daily.establishments_daily(rows, names[0], names[1], day, rejects_root=root)

    return job_tables(spark, run, schemas.GOLD_ESTABLISHMENT, 1)


@register
def repeated_rows(spark, sf_dir):
    """Rows of two days' files offered at once that the daily job does not apply, with its reasons."""
    root = scratch_path(spark, "job")
    names = [f"job_{uuid.uuid4().hex}" for _ in range(2)]
    rows = inputs.bronze_establishments(spark, sf_dir)
    daily.establishments_daily(rows, *names, DAY_2, rejects_root=root)
    for name in names:
        versions.drop(spark, name)
    kinds = [
        spark.read.schema("reject_reason string, row string").parquet(
            f"{root}/bronze/establishments/rejects/{kind}"
        )
        for kind in ("malformed", "repeated", "unreadable")
    ]
    kept = kinds[0].unionByName(kinds[1]).unionByName(kinds[2])
    row = F.from_json("row", schemas.BRONZE_ESTABLISHMENT)
    return kept.select("reject_reason", row.alias("r")).select(
        "reject_reason",
        F.col("r.siret").alias("siret"),
        F.col("r.libelleCommuneEtablissement").alias("commune"),
        F.col("r.dateDernierTraitementEtablissement").alias("processed"),
    )


@register
def scd2_days_in_any_order(spark, sf_dir):
    """Three days landed and streamed out of their order, each by a run of its own: the timeline of days in order."""
    root = scratch_path(spark, "stream")
    gold = f"gold_{uuid.uuid4().hex}"
    for bronze, day in ((inputs.stock, DAY_3), (inputs.stock, DAY_1), (inputs.diff, DAY_2)):
        path = files.write_bronze(
            bronze(spark, sf_dir), root, "establishments", day,
            columns=schemas.BRONZE_ESTABLISHMENT_COLUMNS,
        )
        incremental.establishments_stream(spark, path, f"{root}/checkpoint", gold, late="insert")
    after = settle(tables.read_table(spark, gold, schemas.GOLD_ESTABLISHMENT))
    versions.drop(spark, gold)
    return after


@register
def announcements_daily(spark, sf_dir):
    """The daily job: bronze, silver, match records, versioned links; a second run adds nothing."""
    bronze, candidates = settle(inputs.bronze_announcements(spark, sf_dir)), offices(spark, sf_dir)

    def run(names, root):
        for day in (DAY_1, DAY_2):
            daily.announcements_daily(
                bronze, candidates, names[0], names[1], day, MODEL,
                matches_table=names[2], rejects_root=root,
            )

    links = job_tables(spark, run, schemas.GOLD_ANNOUNCEMENT_LINK, 1)
    return links.withColumn("match_confidence", F.round("match_confidence", 6))


@register
def announcements_stream(spark, sf_dir):
    """Announcements landed in bronze, picked up by a stream, matched and versioned."""
    candidates = offices(spark, sf_dir)

    def run(names, root):
        path = files.write_bronze(
            inputs.bronze_announcements(spark, sf_dir), root, "announcements", DAY_1,
            columns=schemas.BRONZE_ANNOUNCEMENT_COLUMNS,
        )
        incremental.announcements_stream(
            spark, path, f"{root}/checkpoint", names[0], names[1], candidates, MODEL
        )

    links = job_tables(spark, run, schemas.GOLD_ANNOUNCEMENT_LINK, 1)
    return links.withColumn("match_confidence", F.round("match_confidence", 6))


@register
def markets_daily(spark, sf_dir):
    """The daily job on one department's year: scope, silver, match records, versioned links."""

    def run(names, root):
        daily.markets_daily(
            inputs.bronze_markets(spark, sf_dir), inputs.registry(spark, sf_dir), names[0], names[1],
            MARKET_DAY, "03", matches_table=names[2], rejects_root=root,
        )

    return job_tables(spark, run, schemas.GOLD_MARKET_LINK, 1)


@register
def markets_rerun(spark, sf_dir):
    """The daily job on markets, run twice on its day: first with wrong amounts and winners."""

    def run(names, root):
        right = inputs.bronze_markets(spark, sf_dir)
        wrong = right.withColumns(
            {
                "montant": F.col("montant") + 7.0,
                "titulaire_id": F.when(F.col("objet") == "Lot 1", "X").otherwise(F.col("titulaire_id")),
            }
        )
        for rows in (wrong, right):
            daily.markets_daily(
                rows, inputs.registry(spark, sf_dir), names[0], names[1], MARKET_DAY, "03",
                matches_table=names[2], rejects_root=root,
            )

    return job_tables(spark, run, schemas.GOLD_MARKET_LINK, 1)


# --- serving ---------------------------------------------------------------------------------------


@register
def serving_join(spark, sf_dir):
    announced = silver_announcements(spark, sf_dir)
    gold = link_gold(announced, offices(spark, sf_dir))
    return serve.announcements_view(gold, announced)


@register
def search(spark, sf_dir):
    return serve.search(establishment_gold(spark, sf_dir), "tion_1")


@register
def history(spark, sf_dir):
    """All versions of an establishment that has changed."""
    return serve.history(establishment_gold(spark, sf_dir), CHANGED_SIRET)


@register
def history_of_key(spark, sf_dir):
    """The same from the gold table of the daily job: one bucket of current rows, and closed ones that may have the key."""
    names = [f"job_{uuid.uuid4().hex}" for _ in range(2)]
    for bronze, day in ((inputs.stock, DAY_1), (inputs.diff, DAY_2)):
        daily.establishments_daily(bronze(spark, sf_dir), *names, day)
    rows = versions.of_key(spark, names[1], schemas.GOLD_ESTABLISHMENT, siret=CHANGED_SIRET)
    after = settle(serve.history(rows, CHANGED_SIRET))
    for name in names:
        versions.drop(spark, name)
    return after


@register
def announcements_of(spark, sf_dir):
    return serve.announcements_of(serving_join(spark, sf_dir), SOME_SIRET)


@register
def markets_of(spark, sf_dir):
    return serve.markets_of(market_gold(spark, sf_dir), SOME_SUPPLIER)


@register
def search_indexed(spark, sf_dir):
    """The search from the folders that an index of town names points at."""
    path = scratch_path(spark, "search")
    serving.build_search_index(establishment_gold(spark, sf_dir), path)
    return serving.search(spark, path, "tion_1")


@register
def history_published(spark, sf_dir):
    path = scratch_path(spark, "establishments")
    serving.publish_establishments(establishment_gold(spark, sf_dir), path)
    return serving.history(spark, path, CHANGED_SIRET)


@register
def announcements_published(spark, sf_dir):
    path = scratch_path(spark, "announcements")
    announced = silver_announcements(spark, sf_dir)
    serving.publish_announcements(link_gold(announced, offices(spark, sf_dir)), announced, path)
    return serving.announcements_of(spark, path, SOME_SIRET)


@register
def markets_published(spark, sf_dir):
    path = scratch_path(spark, "markets")
    serving.publish_markets(market_gold(spark, sf_dir), path)
    return serving.markets_of(spark, path, SOME_SUPPLIER)


@register
def won_then_bankrupt(spark, sf_dir):
    bought = inputs.markets(spark, sf_dir).filter("titulaire_type_identifiant = 'SIRET'")
    wins = bought.select(F.substring("titulaire_id", 1, 9).alias("siren"), "date_notification")
    notices = inputs.announcements(spark, sf_dir).withColumnRenamed("siren_declared", "siren")
    return serve.won_then_bankrupt(wins, notices, inputs.BANKRUPTCY)


# --- quality ---------------------------------------------------------------------------------------


def seeded(spark, sf_dir) -> DataFrame:
    """Versions of orders with violations: by status, doubled, contradictory or without a key."""
    df = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date")
    key = F.concat(F.lit("A"), F.col("o_custkey").cast("string"))
    return df.select(
        F.when(F.col("o_orderpriority") != "5-LOW", key).alias("key"),
        F.col("o_orderpriority").alias("method"),
        day.alias("valid_from"),
        F.when(F.col("o_orderstatus") != "O", F.date_add(day, 30)).alias("valid_to"),
        F.when(
            F.col("o_orderpriority") != "1-URGENT", F.col("o_orderstatus") != "F"
        ).alias("is_current"),
    )


@register
def dq_one_current(spark, sf_dir):
    return quality.one_current(seeded(spark, sf_dir), ["key"])


@register
def dq_unique_valid_from(spark, sf_dir):
    return quality.unique_version(seeded(spark, sf_dir), ["key"])


@register
def dq_valid_to_flag(spark, sf_dir):
    return quality.flag_matches_valid_to(seeded(spark, sf_dir), ["key"])


@register
def dq_not_null(spark, sf_dir):
    return quality.not_null(
        seeded(spark, sf_dir), ["key", "method", "valid_from", "valid_to", "is_current"]
    )


@register
def dq_accepted_values(spark, sf_dir):
    return quality.accepted_values(seeded(spark, sf_dir), "method", ["1-URGENT", "2-HIGH"])


@register
def dq_market_links(spark, sf_dir):
    """Pairs of market and winner that would be current more than once, were they not deduplicated."""
    links = validated_markets(spark, sf_dir).withColumn("is_current", F.lit(True))
    return quality.one_current(links, schemas.MARKET_KEYS)


def seeded_links(spark, sf_dir) -> DataFrame:
    """Market links of two runs, doubled and contradictory where the winner's type asks for it."""
    unresolved = F.col("match_method") == schemas.UNRESOLVED
    kinds = F.array(
        F.lit("gold"),
        F.when(unresolved, "open-ended"),
        F.when(unresolved & F.col("is_current"), "closed"),
    )
    # Copies of each row in one pass: three reads of the table would each work it out.
    copies = market_gold(spark, sf_dir).withColumn("_kind", F.explode(F.array_compact(kinds)))
    return copies.withColumns(
        {
            "is_current": F.when(F.col("_kind") != "open-ended", F.col("is_current")),
            "valid_to": F.when(F.col("_kind") == "closed", F.lit(DAY_3)).otherwise(F.col("valid_to")),
        }
    ).drop("_kind")


@register
def dq_market_versions(spark, sf_dir):
    """Market links that share key and start day."""
    return quality.unique_version(seeded_links(spark, sf_dir), schemas.MARKET_KEYS)


@register
def dq_market_flags(spark, sf_dir):
    """Market links whose flag contradicts their end."""
    return quality.flag_matches_valid_to(seeded_links(spark, sf_dir), schemas.MARKET_KEYS)


@register
def dq_market_nulls(spark, sf_dir):
    """Columns of market links that hold NULL where none is allowed, and the identifiers that are allowed to."""
    return quality.not_null(
        seeded_links(spark, sf_dir),
        ["uid", "titulaire_id", "match_method", "valid_from", "is_current"],
    )
