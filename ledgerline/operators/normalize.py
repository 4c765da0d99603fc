"""Raw API records to all-string bronze rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline import schemas
from ledgerline.functions.text import person_name, present, siren_in_text

# Bronze column -> field of the raw record.
CANDIDATE_ADDRESS = {
    "numero_voie": "numeroVoieEtablissement",
    "type_voie": "typeVoieEtablissement",
    "libelle_voie": "libelleVoieEtablissement",
    "code_postal": "codePostalEtablissement",
    "libelle_commune": "libelleCommuneEtablissement",
}


def parse_json(df: DataFrame, column: str, schema: StructType) -> DataFrame:
    """Records of a JSON text column, one output column per schema field."""
    return df.select(F.from_json(column, schema).alias("_record")).select("_record.*")


def flatten_establishments(raw: DataFrame) -> DataFrame:
    """Nested establishment records to the flat bronze layout; the first period is the current one."""
    period = F.get("periodesEtablissement", F.lit(0))
    sources = {
        name: F.col("adresseEtablissement")[name] for name in schemas.RAW_ADDRESS.fieldNames()
    }
    for name in ("etatAdministratifEtablissement", "activitePrincipaleEtablissement"):
        sources[name] = period[name]
    sources["etablissementSiege"] = F.when(F.col("etablissementSiege"), "true").otherwise("false")
    return raw.select(
        [
            sources[name].alias(name) if name in sources else F.col(name)
            for name in schemas.BRONZE_ESTABLISHMENT_COLUMNS
        ]
    )


def normalize_announcements(raw: DataFrame) -> DataFrame:
    """Announcement records to bronze; a missing identifier is looked for in the register text."""
    siren = F.coalesce(present(F.col("siren").cast("string")), siren_in_text(F.col("registre")))
    return raw.withColumn("siren_declared", siren).select(
        [F.col(name).cast("string").alias(name) for name in schemas.BRONZE_ANNOUNCEMENT_COLUMNS]
    )


def normalize_candidates(raw: DataFrame) -> DataFrame:
    """Head-office records to matching candidates named by company name or by person."""
    unit = F.col("uniteLegale")
    named = F.coalesce(
        present(unit["denominationUniteLegale"]),
        person_name(unit["nomUniteLegale"], unit["prenomUsuelUniteLegale"]),
        unit["denominationUniteLegale"],
    )
    address = F.col("adresseEtablissement")
    return raw.select(
        "siren",
        "siret",
        named.alias("denomination"),
        *[address[field].alias(name) for name, field in CANDIDATE_ADDRESS.items()],
    )
