"""Deterministic matching of announcements to head offices, and the shape of a match record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.keys import first_by, lookup
from ledgerline.operators.scd2 import current
from ledgerline.schemas import ANNOUNCEMENT_LINK, EXACT, FUZZY, UNRESOLVED

ID = "bodacc_announcement_id"


def match_record(
    announcement: Column,
    method: str,
    siren: Column | None = None,
    siret: Column | None = None,
    confidence: Column | None = None,
) -> list[Column]:
    """Columns of one match record; what is not given is NULL."""
    given = [announcement, siren, siret, F.lit(method), confidence]
    return [
        (F.lit(None) if value is None else value).cast(field.dataType).alias(field.name)
        for field, value in zip(ANNOUNCEMENT_LINK.fields, given, strict=True)
    ]


def head_offices(candidates: DataFrame) -> DataFrame:
    """One head office per company: the smallest ``siret`` where a company has several."""
    return candidates.filter("siren IS NOT NULL").groupBy("siren").agg(F.min("siret").alias("siret"))


def exact_matches(
    announcements: DataFrame, candidates: DataFrame, every_office: bool = False
) -> DataFrame:
    """Announcements whose declared company is a candidate.

    A company listed once gives one match per announcement. Where it is listed several times the
    smallest ``siret`` is taken, so that an announcement keeps one match; ``every_office`` lists them
    all.
    """
    declared = announcements.filter("siren_declared IS NOT NULL").select("id", "siren_declared")
    if every_office:
        offices = candidates.select("siren", "siret")
        found = declared.join(offices, declared["siren_declared"] == offices["siren"])
    else:
        offices = head_offices(candidates)
        found = lookup(declared, offices, {"siren_declared": "siren"}, spread_by="id")
        found = found.filter("siret IS NOT NULL")
    return found.select(
        match_record(F.col("id"), EXACT, F.col("siren_declared"), F.col("siret"), F.lit(1.0))
    )


def unmatched(announcements: DataFrame, matches: DataFrame) -> DataFrame:
    """Announcements without any match record."""
    done = matches.select(F.col(ID).alias("id"))
    return announcements.join(done, "id", "left_anti")


def backlog(announcements: DataFrame, gold_links: DataFrame) -> DataFrame:
    """Announcements without a current link. An ``unresolved`` link counts, a closed one does not."""
    return unmatched(announcements, current(gold_links))


def fuzzy_records(predictions: DataFrame) -> DataFrame:
    """Match records of scored pairs ``uid_l``, ``uid_r``, ``match_probability``."""
    return predictions.select(
        match_record(
            F.col("uid_l"), FUZZY, siret=F.col("uid_r"), confidence=F.col("match_probability")
        )
    )


def best_match(matches: DataFrame) -> DataFrame:
    """Most confident match of each announcement; equal confidence goes to the smallest ``siret``."""
    order = [F.col("match_confidence").desc_nulls_last(), F.col("siret_siege").asc_nulls_last()]
    return first_by(matches, [ID], order)


def combine_matches(exact: DataFrame, fuzzy: DataFrame) -> DataFrame:
    return exact.unionByName(best_match(fuzzy))


def complete_unresolved(announcements: DataFrame, matches: DataFrame) -> DataFrame:
    """The matches, and an explicit ``unresolved`` record for every announcement without one."""
    missing = unmatched(announcements.select("id"), matches)
    return matches.unionByName(missing.select(match_record(F.col("id"), UNRESOLVED)))
