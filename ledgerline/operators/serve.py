"""Denormalized views for serving, and the lookups on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.operators.match import ID
from ledgerline.schemas import GOLD_ESTABLISHMENT, GOLD_MARKET_LINK, SERVED_ANNOUNCEMENT

SEARCH_LIMIT = 50


def announcements_view(links: DataFrame, announcements: DataFrame) -> DataFrame:
    """Link versions that name an establishment, with the announcement they are about."""
    named = links.filter("siret_siege IS NOT NULL")
    about = announcements.withColumnRenamed("id", ID)
    return named.join(about, ID).select(SERVED_ANNOUNCEMENT.fieldNames())


def search(establishments: DataFrame, q: str) -> DataFrame:
    """Current establishments by identifier, company identifier or part of the town's name.

    ``%`` and ``_`` in ``q`` act as wildcards. The first 50 by ``siret``.
    """
    wanted = (
        (F.col("siret") == q) | (F.col("siren") == q) | F.col("libelle_commune").ilike(f"%{q}%")
    )
    found = check_contract(establishments, GOLD_ESTABLISHMENT).filter(F.col("is_current") & wanted)
    return found.orderBy("siret").limit(SEARCH_LIMIT)


def history(gold: DataFrame, siret: str) -> DataFrame:
    """All versions of one establishment, oldest first; empty when it is unknown."""
    versions = check_contract(gold, GOLD_ESTABLISHMENT)
    return versions.filter(F.col("siret") == siret).orderBy("valid_from")


def announcements_of(served: DataFrame, siret: str) -> DataFrame:
    """Current announcements of an establishment, newest first, undated ones on top."""
    mine = check_contract(served, SERVED_ANNOUNCEMENT).filter(
        (F.col("siret_siege") == siret) & F.col("is_current")
    )
    return mine.orderBy(F.col("date_parution").desc_nulls_first())


def markets_of(market_links: DataFrame, siret: str) -> DataFrame:
    """Current markets won by an establishment."""
    mine = check_contract(market_links, GOLD_MARKET_LINK).filter(
        (F.col("siret_titulaire") == siret) & F.col("is_current")
    )
    return mine.orderBy("uid", F.col("titulaire_id").asc_nulls_first())


def check_contract(df: DataFrame, layout: StructType) -> DataFrame:
    """``df`` in the promised column order; raises when a column is missing or typed otherwise."""
    found = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f.name for f in layout.fields if found.get(f.name) != f.dataType]
    if wrong:
        raise ValueError(f"columns missing or of another type: {wrong}")
    return df.select(layout.fieldNames())


def won_then_bankrupt(
    markets: DataFrame, announcements: DataFrame, family: str, months: int = 12
) -> DataFrame:
    """Companies with an announcement of ``family`` within ``months`` after winning a market.

    ``markets``: ``siren``, ``date_notification``; ``announcements``: ``siren``, ``date_parution``,
    ``famille_avis``. Both sides shrink to distinct days per company before they meet, so a company
    never has more rows than the calendar has days, and each win looks only for the next announcement
    instead of pairing with all of them.
    """
    wins = (
        markets.filter("siren IS NOT NULL AND date_notification IS NOT NULL")
        .groupBy("siren", F.col("date_notification").alias("day"))
        .agg(F.count("*").alias("wins"))
        .withColumn("bankrupt", F.lit(None).cast("date"))
    )
    failures = (
        announcements.filter("siren IS NOT NULL AND date_parution IS NOT NULL")
        .filter(F.col("famille_avis") == family)
        .groupBy("siren", F.col("date_parution").alias("day"))
        .agg(F.lit(0).cast("long").alias("wins"))
        .withColumn("bankrupt", F.col("day"))
    )
    # Latest day first: the running minimum is the next announcement on or after the row's day.
    order = [F.col("day").desc(), F.col("bankrupt").asc_nulls_last()]
    upcoming = Window.partitionBy("siren").orderBy(*order)
    due = F.min("bankrupt").over(upcoming)
    hits = wins.unionByName(failures).withColumn("due", due).filter(
        (F.col("wins") > 0) & (F.col("due") <= F.add_months("day", months))
    )
    return hits.groupBy("siren").agg(
        F.sum("wins").cast("long").alias("markets_won"),
        F.min("day").alias("first_win"),
        F.min("due").alias("first_bankruptcy"),
    )
