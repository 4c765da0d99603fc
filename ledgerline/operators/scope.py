"""Filters that cut a source down to a scope. All of them reach the file scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scope_markets(markets: DataFrame, department: str, since: dt.date) -> DataFrame:
    """Current records of one buyer department published on or after ``since``."""
    return markets.filter(
        (F.col("acheteur_departement_code") == department)
        & (F.col("datePublicationDonnees") >= F.lit(since))
        & F.col("donneesActuelles")
    )


def window_announcements(
    raw: DataFrame, since: dt.date, until: dt.date, department: str | None = None
) -> DataFrame:
    """Announcements published in ``[since, until)``; ISO days compare as text."""
    day = F.col("dateparution")
    inside = raw.filter((day >= F.lit(since.isoformat())) & (day < F.lit(until.isoformat())))
    return inside.filter(F.col("numerodepartement") == department) if department else inside


def updated_between(raw: DataFrame, since: dt.date, until: dt.date) -> DataFrame:
    """Establishments processed from ``since`` to ``until``, both days included.

    Compared as text up to the following day, which keeps a time of day on ``until`` inside and lets
    the file scan skip row groups.
    """
    day = F.col("dateDernierTraitementEtablissement")
    after = until + dt.timedelta(days=1)
    return raw.filter((day >= F.lit(since.isoformat())) & (day < F.lit(after.isoformat())))


def active_offices(raw: DataFrame) -> DataFrame:
    """Head offices whose latest period is active."""
    period = F.get("periodesEtablissement", F.lit(0))
    return raw.filter(
        F.col("etablissementSiege") & (period["etatAdministratifEtablissement"] == "A")
    )


def scope_candidates(raw: DataFrame, department: str) -> DataFrame:
    """Active head offices whose postal code starts with the department."""
    postal = F.col("adresseEtablissement.codePostalEtablissement")
    return active_offices(raw.filter(postal.startswith(department)))


def department_of(postal: Column) -> Column:
    """Department of a postal code: two characters, three overseas."""
    overseas = F.substring(postal, 1, 2).isin("97", "98")
    return F.when(overseas, F.substring(postal, 1, 3)).otherwise(F.substring(postal, 1, 2))
