"""Serving from files: tables for the lookups of ``operators.serve``, and an index for its search.

The search index has three parts. ``rows`` are the current establishments in buckets by their town's name. ``grams`` lists for each
three letters of a town's name the names that have them, and for the empty text all names. ``ids`` lists the bucket of every
identifier. A search asks the two lists for buckets, a bounded number, and then does in these what it does without an index.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators import serve
from ledgerline.sources.lookups import BUCKET, BUCKETS, OF, bucket_of, lookup, read_lookup, write_lookup

GRAM = 3
TOWN = "libelle_commune"
GRAMS = schemas.struct_of("gram string, name string, row_bucket int")
IDS = schemas.struct_of("id string, row_bucket int")


def grams(text: Column) -> Column:
    """Distinct pieces of three letters of a text in lower case, and the empty one; a text of any length takes one pass."""
    letters = F.split(F.lower(text), "")
    pieces = letters
    for k in range(2, GRAM + 1):  # what reaches beyond the end is NULL
        pieces = F.zip_with(pieces, F.slice(letters, k, F.size(letters)), lambda a, b: F.concat(a, b))
    return F.array_distinct(F.concat(F.array(F.lit("")), F.array_compact(pieces)))


def grams_of_pattern(pattern: str) -> list[str]:
    """Pieces that every text like the lower-case ``pattern`` has; only the empty one if no part of it is long enough."""
    runs = [re.sub(r"\\(.)", r"\1", r, flags=re.S) for r in re.findall(r"(?:\\.|[^%_\\])+", pattern, re.S)]
    found = {r[i : i + GRAM] for r in runs for i in range(len(r) - GRAM + 1)}
    return sorted(found) or [""]


def build_search_index(establishments: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Index the current establishments below a new ``path``.

    Rows without a town or an identifier are kept; they are found by what they have.
    """
    current = serve.check_contract(establishments, schemas.GOLD_ESTABLISHMENT).filter("is_current")
    write_lookup(current, f"{path}/rows", [TOWN], order=["siret"], filters=["siret", "siren"], buckets=buckets)
    rows = read_lookup(current.sparkSession, f"{path}/rows", schemas.GOLD_ESTABLISHMENT)
    bucket = F.col(BUCKET).alias("row_bucket")
    names = rows.filter(F.col(TOWN).isNotNull()).select(F.col(TOWN).alias("name"), bucket).distinct()
    listed = names.select(F.explode(grams(F.col("name"))).alias("gram"), "name", "row_bucket")
    write_lookup(listed, f"{path}/grams", ["gram"], order=["name"], buckets=buckets)
    ids = rows.select(F.explode(F.array_distinct(F.array("siret", "siren"))).alias("id"), bucket)
    write_lookup(ids.dropna().distinct(), f"{path}/ids", ["id"], buckets=buckets)


def buckets_with(spark: SparkSession, path: str, q: str) -> list[int]:
    """Buckets of rows that ``q`` may find: as many numbers as buckets at most."""
    pattern = spark.sql("SELECT lower(:pattern)", {"pattern": f"%{q}%"}).first()[0]
    wanted = grams_of_pattern(pattern)
    listed = read_lookup(spark, f"{path}/grams", GRAMS)
    mine = F.lit(False)
    for gram in wanted:
        mine = mine | (F.col(BUCKET) == bucket_of([F.lit(gram)], F.col(OF)))
    # A name is listed once for each of its pieces.
    names = listed.filter(mine & F.col("gram").isin(wanted)).groupBy("name", "row_bucket").count()
    towns = names.filter((F.col("count") == len(wanted)) & F.col("name").ilike(f"%{q}%"))
    ids = lookup(spark, f"{path}/ids", IDS, id=q)
    found = towns.select("row_bucket").unionByName(ids.select("row_bucket")).distinct()
    return sorted(r[0] for r in found.collect())


def indexed_rows(spark: SparkSession, path: str, q: str) -> DataFrame:
    """The indexed rows of all buckets that ``q`` may find."""
    rows = read_lookup(spark, f"{path}/rows", schemas.GOLD_ESTABLISHMENT)
    return rows.filter(F.col(BUCKET).isin(buckets_with(spark, path, q)))


def search(spark: SparkSession, path: str, q: str) -> DataFrame:
    """What ``serve.search`` finds in the indexed establishments, from the folders that may have it."""
    return serve.search(indexed_rows(spark, path, q), q)


# --- lookups ---------------------------------------------------------------------------------------


def publish_establishments(gold: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """All versions, for ``history``."""
    rows = serve.check_contract(gold, schemas.GOLD_ESTABLISHMENT)
    write_lookup(rows, path, ["siret"], order=["valid_from"], buckets=buckets)


def publish_announcements(
    links: DataFrame, announcements: DataFrame, path: str, buckets: int = BUCKETS
) -> None:
    """Linked announcements with their content, for ``announcements_of``."""
    rows = serve.announcements_view(links, announcements)
    write_lookup(rows, path, ["siret_siege"], order=["date_parution"], buckets=buckets)


def publish_markets(market_links: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Market links with an establishment, for ``markets_of``."""
    rows = serve.check_contract(market_links, schemas.GOLD_MARKET_LINK)
    named = rows.filter("siret_titulaire IS NOT NULL")
    write_lookup(named, path, ["siret_titulaire"], order=["uid"], buckets=buckets)


def history(spark: SparkSession, path: str, siret: str) -> DataFrame:
    return serve.history(lookup(spark, path, schemas.GOLD_ESTABLISHMENT, siret=siret), siret)


def announcements_of(spark: SparkSession, path: str, siret: str) -> DataFrame:
    rows = lookup(spark, path, schemas.SERVED_ANNOUNCEMENT, siret_siege=siret)
    return serve.announcements_of(rows, siret)


def markets_of(spark: SparkSession, path: str, siret: str) -> DataFrame:
    rows = lookup(spark, path, schemas.GOLD_MARKET_LINK, siret_titulaire=siret)
    return serve.markets_of(rows, siret)
