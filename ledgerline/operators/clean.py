"""Bronze to silver: typed, renamed, one row per key where the domain has one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline import schemas
from ledgerline.operators.keys import dedup, duplicates

DAY = "yyyy-MM-dd"

# Silver column -> bronze column, where the names differ.
ESTABLISHMENT_SOURCES = {
    "statut_diffusion": "statutDiffusionEtablissement",
    "date_creation": "dateCreationEtablissement",
    "etablissement_siege": "etablissementSiege",
    "numero_voie": "numeroVoieEtablissement",
    "type_voie": "typeVoieEtablissement",
    "libelle_voie": "libelleVoieEtablissement",
    "code_postal": "codePostalEtablissement",
    "libelle_commune": "libelleCommuneEtablissement",
    "activite_principale": "activitePrincipaleEtablissement",
    "etat_administratif": "etatAdministratifEtablissement",
    "date_dernier_traitement": "dateDernierTraitementEtablissement",
}
ANNOUNCEMENT_SOURCES = {
    "date_parution": "dateparution",
    "numero_annonce": "numeroannonce",
    "type_avis": "typeavis_lib",
    "famille_avis": "familleavis_lib",
    "code_postal": "cp",
}
MARKET_SOURCES = {
    "titulaire_type_identifiant": "titulaire_typeIdentifiant",
    "code_cpv": "codeCPV",
    "date_notification": "dateNotification",
}


#: Text columns that hold calendar days.
ESTABLISHMENT_DAYS = ["dateCreationEtablissement", "dateDernierTraitementEtablissement"]
ANNOUNCEMENT_DAYS = ["dateparution"]


def has_key(key: str) -> Column:
    return F.col(key).isNotNull() & (F.col(key) != "")


def typed(
    df: DataFrame, layout: StructType, sources: Mapping[str, str], carry: Sequence[str] = ()
) -> DataFrame:
    """Columns of ``layout`` read from ``df``: text to day and text to flag, the rest unchanged."""
    stored = dict(df.dtypes)
    columns = []
    for field in layout.fields:
        name = sources.get(field.name, field.name)
        value, wanted = F.col(name), field.dataType.simpleString()
        if stored[name] == "string" and wanted == "date":
            value = F.try_to_date(value, DAY)
        elif stored[name] == "string" and wanted == "boolean":
            value = value == "true"
        columns.append(value.alias(field.name))
    return df.select(*columns, *carry)


def clean_establishments(bronze: DataFrame, per: Sequence[str] = ()) -> DataFrame:
    """One typed row per ``siret``, the most recently processed one.

    ``per`` names further columns, such as the day of ingestion, to keep one row for each value of.
    """
    latest = ["dateDernierTraitementEtablissement"]
    kept = dedup(bronze.filter(has_key("siret")), ["siret", *per], latest)
    return typed(kept, schemas.SILVER_ESTABLISHMENT, ESTABLISHMENT_SOURCES, per)


def repeated_establishments(bronze: DataFrame) -> DataFrame:
    """Rows that ``clean_establishments`` leaves out for another one of their ``siret``, with a reason."""
    latest = ["dateDernierTraitementEtablissement"]
    twice = duplicates(bronze.filter(has_key("siret")), ["siret"], latest)
    return twice.withColumn("reject_reason", F.lit("repeated siret"))


def repeated_announcements(bronze: DataFrame) -> DataFrame:
    """Rows that ``clean_announcements`` leaves out for another one of their ``id``, with a reason."""
    twice = duplicates(bronze.filter(has_key("id")), ["id"])
    return twice.withColumn("reject_reason", F.lit("repeated id"))


def clean_announcements(bronze: DataFrame) -> DataFrame:
    """One typed row per announcement ``id``."""
    kept = dedup(bronze.filter(has_key("id")), ["id"])
    return typed(kept, schemas.SILVER_ANNOUNCEMENT, ANNOUNCEMENT_SOURCES)


def clean_markets(bronze: DataFrame) -> DataFrame:
    """Typed markets; a market awarded jointly keeps one row per winner."""
    silver = typed(bronze.filter(has_key("uid")), schemas.SILVER_MARKET, MARKET_SOURCES)
    kind = "titulaire_type_identifiant"
    return silver.withColumn(kind, F.upper(kind))


def unreadable_days(bronze: DataFrame, days: Sequence[str]) -> DataFrame:
    """Rows that lose a value when they are typed, because a column of ``days`` holds text that is no calendar day."""

    def lost(name: str) -> Column:
        value = F.col(name)
        return value.isNotNull() & (value != "") & F.try_to_date(value, DAY).isNull()

    named = [F.when(lost(name), F.lit(f"unreadable {name}")) for name in days]
    marked = bronze.withColumn("reject_reason", F.concat_ws(", ", *named))
    return marked.filter("reject_reason <> ''")


def split_rejects(
    bronze: DataFrame, key: str, days: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows that clean keeps, and the malformed ones with a reason.

    A row is malformed without its key, or when one of the ``days`` columns holds text that is not a
    calendar day. Both results are filters on the same frame, so nothing is shuffled.
    """
    reason = F.when(~F.coalesce(has_key(key), F.lit(False)), F.lit(f"missing {key}"))
    for name in days or []:
        unreadable = F.col(name).isNotNull() & F.try_to_date(F.col(name), DAY).isNull()
        reason = reason.when(unreadable, F.lit(f"unreadable {name}"))
    marked = bronze.withColumn("reject_reason", reason)
    good = marked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return good, marked.filter(F.col("reject_reason").isNotNull())
