"""Table layouts. All names and types below are fixed values: they are the data contract."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)


def struct_of(ddl: str) -> StructType:
    """Schema from ``"name type, name type"``; works without a running session."""
    types = {
        "string": StringType(),
        "int": IntegerType(),
        "date": DateType(),
        "double": DoubleType(),
        "boolean": BooleanType(),
    }
    pairs = (item.split() for item in ddl.split(","))
    return StructType([StructField(name, types[kind]) for name, kind in pairs])


def strings(names: list[str]) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


# --- fixed values: bronze columns -------------------------------------------------------------
BRONZE_ESTABLISHMENT_COLUMNS = [
    "siren", "nic", "siret", "statutDiffusionEtablissement", "dateCreationEtablissement",
    "etablissementSiege", "numeroVoieEtablissement", "typeVoieEtablissement",
    "libelleVoieEtablissement", "codePostalEtablissement", "libelleCommuneEtablissement",
    "activitePrincipaleEtablissement", "etatAdministratifEtablissement",
    "dateDernierTraitementEtablissement",
]
BRONZE_ANNOUNCEMENT_COLUMNS = [
    "id", "dateparution", "numeroannonce", "typeavis_lib", "familleavis_lib", "tribunal",
    "commercant", "siren_declared", "ville", "cp", "denomination",
]
BRONZE_CANDIDATE_COLUMNS = [
    "siren", "siret", "denomination", "numero_voie", "type_voie", "libelle_voie", "code_postal",
    "libelle_commune",
]

BRONZE_ESTABLISHMENT = strings(BRONZE_ESTABLISHMENT_COLUMNS)
BRONZE_ANNOUNCEMENT = strings(BRONZE_ANNOUNCEMENT_COLUMNS)
BRONZE_CANDIDATE = strings(BRONZE_CANDIDATE_COLUMNS)
BRONZE_MARKET = struct_of(
    "uid string, acheteur_id string, acheteur_nom string, titulaire_id string,"
    "titulaire_typeIdentifiant string, titulaire_nom string, objet string, montant double,"
    "codeCPV string, dateNotification date, acheteur_departement_code string,"
    "datePublicationDonnees date, donneesActuelles boolean"
)

# --- fixed values: raw JSON as the public APIs deliver it ------------------------------------
RAW_ADDRESS = strings(
    ["numeroVoieEtablissement", "typeVoieEtablissement", "libelleVoieEtablissement",
     "codePostalEtablissement", "libelleCommuneEtablissement"]
)
RAW_PERIOD = strings(
    ["dateFin", "dateDebut", "etatAdministratifEtablissement", "activitePrincipaleEtablissement"]
)
RAW_LEGAL_UNIT = strings(["denominationUniteLegale", "nomUniteLegale", "prenomUsuelUniteLegale"])
RAW_ESTABLISHMENT = StructType(
    [
        *strings(["siren", "nic", "siret", "statutDiffusionEtablissement",
                  "dateCreationEtablissement"]).fields,
        StructField("etablissementSiege", BooleanType()),
        StructField("dateDernierTraitementEtablissement", StringType()),
        StructField("adresseEtablissement", RAW_ADDRESS),
        StructField("uniteLegale", RAW_LEGAL_UNIT),
        StructField("periodesEtablissement", ArrayType(RAW_PERIOD)),
    ]
)
# ``registre`` arrives as a string or as an array; read as a string Spark keeps the array's text.
RAW_ANNOUNCEMENT = strings(
    ["id", "dateparution", "numeroannonce", "typeavis_lib", "familleavis_lib", "tribunal",
     "commercant", "siren", "registre", "ville", "cp", "denomination", "numerodepartement"]
)

# --- fixed values: silver and gold --------------------------------------------------------------
VALIDITY = "valid_from date, valid_to date, is_current boolean"

_ESTABLISHMENT = (
    "siren string, nic string, siret string, statut_diffusion string, date_creation date,"
    "etablissement_siege boolean, numero_voie string, type_voie string, libelle_voie string,"
    "code_postal string, libelle_commune string, activite_principale string,"
    "etat_administratif string, date_dernier_traitement date"
)
_ANNOUNCEMENT_LINK = (
    "bodacc_announcement_id string, siren_bodacc string, siret_siege string,"
    "match_method string, match_confidence double"
)
_MARKET_LINK = (
    "uid string, titulaire_id string, siret_titulaire string, match_method string,"
    "siret_validated_in_sirene boolean, acheteur_id string, acheteur_nom string,"
    "montant double, objet string, code_cpv string"
)
SILVER_ESTABLISHMENT = struct_of(_ESTABLISHMENT)
SILVER_ANNOUNCEMENT = struct_of(
    "id string, date_parution date, numero_annonce string, type_avis string,"
    "famille_avis string, tribunal string, commercant string, denomination string,"
    "siren_declared string, ville string, code_postal string"
)
SILVER_MARKET = struct_of(
    "uid string, acheteur_id string, acheteur_nom string, titulaire_id string,"
    "titulaire_type_identifiant string, titulaire_nom string, objet string, montant double,"
    "code_cpv string, date_notification date"
)
ANNOUNCEMENT_LINK = struct_of(_ANNOUNCEMENT_LINK)
MARKET_LINK = struct_of(_MARKET_LINK)
GOLD_ESTABLISHMENT = struct_of(f"{_ESTABLISHMENT}, {VALIDITY}")
GOLD_ANNOUNCEMENT_LINK = struct_of(f"{_ANNOUNCEMENT_LINK}, {VALIDITY}")
GOLD_MARKET_LINK = struct_of(f"{_MARKET_LINK}, {VALIDITY}")
SERVED_ANNOUNCEMENT = struct_of(
    "siret_siege string, bodacc_announcement_id string, siren_bodacc string,"
    "match_method string, match_confidence double, date_parution date, type_avis string,"
    "famille_avis string, tribunal string, commercant string, denomination string,"
    f"ville string, code_postal string, {VALIDITY}"
)

# --- fixed values: keys, tracked columns, labels ----------------------------------------------
ESTABLISHMENT_KEYS = ["siret"]
ESTABLISHMENT_TRACKED = [
    f.name for f in SILVER_ESTABLISHMENT.fields if f.name not in ("siren", "siret")
]
LINK_KEYS = ["bodacc_announcement_id"]
LINK_TRACKED = ["siret_siege", "match_method"]
MARKET_KEYS = ["uid", "titulaire_id"]
MARKET_TRACKED = ["siret_titulaire", "match_method", "montant"]

EXACT, FUZZY, UNRESOLVED, SOURCE_SIRET = (
    "exact_siren", "splink_fuzzy", "unresolved", "source_siret",
)
ANNOUNCEMENT_METHODS = [EXACT, FUZZY, UNRESOLVED]
MARKET_METHODS = [SOURCE_SIRET, UNRESOLVED]

# Columns a lookup result always fills; every other column may be NULL.
REQUIRED_ESTABLISHMENT = ["siren", "nic", "siret", "valid_from", "is_current"]
REQUIRED_ANNOUNCEMENT = [
    "siret_siege", "bodacc_announcement_id", "match_method", "valid_from", "is_current",
]
