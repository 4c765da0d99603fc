"""Registry inputs derived from the given tables: whole tables, values recoded, nothing left out.

customers and suppliers are establishments of companies, orders are announcements about customers,
line items are procurement markets won by suppliers.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators import clean, normalize
from ledgerline.operators.model import LinkageModel
from ledgerline.session import ship_package

DAY_1, DAY_2, DAY_3 = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)
BANKRUPTCY = "Procédures collectives"

# Fixed parameters for the queries that are compared with SQL.
MODEL = LinkageModel(
    prior=0.002,
    m_name=(0.02, 0.03, 0.15, 0.8),
    u_name=(0.7, 0.2989, 0.001, 0.0001),
    m_address=(0.05, 0.05, 0.2, 0.7),
    u_address=(0.6, 0.3, 0.05, 0.05),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def padded(key: str, width: int = 9) -> Column:
    return F.lpad(F.col(key).cast("string"), width, "0")


def postal(nation: str) -> Column:
    return F.concat(padded(nation, 2), F.lit("000"))


def by(column: str, cases: dict, otherwise: Column | None = None) -> Column:
    """Value chosen by the text in ``column``."""
    chain = F  # the first ``when`` of the module starts the chain
    for case, value in cases.items():
        chain = chain.when(F.col(column) == case, value)
    return chain.otherwise(otherwise) if otherwise is not None else chain


# --- establishments --------------------------------------------------------------------------------


def _bronze(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    missing = F.lit(None).cast("string")
    return df.select(
        [values.get(c, missing).alias(c) for c in schemas.BRONZE_ESTABLISHMENT_COLUMNS]
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their town, and the name their company goes by."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    token = F.substring(F.md5(F.col("c_name")), 1, 8)
    joined = (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(part, F.col("c_custkey") == F.col("p_partkey"), "left")
    )
    named = F.coalesce("p_name", F.lit("sans nom"))
    return joined.select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "n_name",
        named.alias("p_name"), token.alias("token"),
        F.concat_ws(" ", named, token, F.lower("c_mktsegment")).alias("company"),
    )


def customer_establishments(df: DataFrame, day: dt.date, **changes: Column) -> DataFrame:
    siren = padded("c_custkey")
    opened = F.date_add(F.lit(dt.date(1990, 1, 1)), F.col("c_nationkey") * 200).cast("string")
    values = {
        "siren": siren,
        "nic": F.lit("00019"),
        "siret": F.concat(siren, F.lit("00019")),
        "statutDiffusionEtablissement": F.lit("O"),
        "dateCreationEtablissement": F.when(F.col("c_acctbal") < 0, "inconnue").otherwise(opened),
        "etablissementSiege": F.when(
            F.col("c_mktsegment") != "HOUSEHOLD", (F.col("c_acctbal") >= 5000).cast("string")
        ),
        "numeroVoieEtablissement": F.col("c_nationkey").cast("string"),
        "typeVoieEtablissement": F.lit("RUE"),
        "libelleVoieEtablissement": F.col("c_name"),
        "codePostalEtablissement": postal("c_nationkey"),
        "libelleCommuneEtablissement": F.col("n_name"),
        "activitePrincipaleEtablissement": F.col("c_mktsegment"),
        "etatAdministratifEtablissement": F.when(F.col("c_acctbal") < 0, "F").otherwise("A"),
        "dateDernierTraitementEtablissement": F.lit(day.isoformat()),
    }
    return _bronze(df, values | changes)


def supplier_establishments(spark: SparkSession, sf_dir: str, day: dt.date) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    df = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    siren = padded("s_suppkey")
    return _bronze(
        df,
        {
            "siren": siren,
            "nic": F.lit("00027"),
            "siret": F.concat(siren, F.lit("00027")),
            "codePostalEtablissement": postal("s_nationkey"),
            "libelleCommuneEtablissement": F.col("n_name"),
            "libelleVoieEtablissement": F.col("s_name"),
            "etatAdministratifEtablissement": F.when(F.col("s_acctbal") < 0, "F").otherwise("A"),
            "dateDernierTraitementEtablissement": F.lit(day.isoformat()),
        },
    )


def stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze of day 1: every customer."""
    return customer_establishments(customers(spark, sf_dir), DAY_1)


def diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze of day 2: the customers of three segments, two of them changed, and all suppliers."""
    df = customers(spark, sf_dir).filter(
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "HOUSEHOLD")
    )
    changed = customer_establishments(
        df,
        DAY_2,
        activitePrincipaleEtablissement=by(
            "c_mktsegment", {"BUILDING": F.lit("CONSTRUCTION")}, F.col("c_mktsegment")
        ),
        etablissementSiege=F.when(
            F.col("c_mktsegment") == "HOUSEHOLD", "true"
        ).otherwise((F.col("c_acctbal") >= 5000).cast("string")),
        dateDernierTraitementEtablissement=F.when(
            F.col("c_mktsegment") == "MACHINERY", DAY_1.isoformat()
        ).otherwise(DAY_2.isoformat()),
    )
    return changed.unionByName(supplier_establishments(spark, sf_dir, DAY_2))


def malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows without a key: NULL for regions, empty for nations."""
    region = _bronze(
        table(spark, sf_dir, "region"), {"libelleCommuneEtablissement": F.col("r_name")}
    )
    nation = _bronze(
        table(spark, sf_dir, "nation"),
        {"siret": F.lit(""), "libelleCommuneEtablissement": F.col("n_name")},
    )
    return region.unionByName(nation)


def broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as lines ``csv_line`` and ``json_line``; one in five of each is broken, by the customer's number."""
    fields = ["c_name", "c_nationkey", "c_mktsegment"]
    key, kind = F.col("c_custkey").cast("string"), F.col("c_custkey") % 10
    whole = F.concat_ws(",", key, *[F.col(c).cast("string") for c in fields])
    record = F.to_json(F.struct(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(kind == 0, F.concat_ws(",", key, "c_name"))
        .when(kind == 1, F.concat(whole, F.lit(",more")))
        .otherwise(whole)
        .alias("csv_line"),
        F.when(kind == 3, F.concat(F.lit('{"key":'), key, F.lit(',"name')))
        .when(kind == 4, F.regexp_replace(record, ':\\d+', ':"many"'))
        .otherwise(record)
        .alias("json_line"),
    )


def bronze_establishments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stock(spark, sf_dir).unionByName(diff(spark, sf_dir)).unionByName(
        malformed(spark, sf_dir)
    )


def raw_establishments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the nested JSON records of the establishment API, one text column ``json``.

    Some records lack the address, the periods or the head-office flag.
    """
    df = customers(spark, sf_dir)
    siren = padded("c_custkey")
    address = F.struct(
        F.col("c_nationkey").cast("string").alias("numeroVoieEtablissement"),
        F.lit("RUE").alias("typeVoieEtablissement"),
        F.col("c_name").alias("libelleVoieEtablissement"),
        postal("c_nationkey").alias("codePostalEtablissement"),
        F.col("n_name").alias("libelleCommuneEtablissement"),
    )

    def period(state: Column, activity: Column) -> Column:
        return F.struct(
            state.alias("etatAdministratifEtablissement"),
            activity.alias("activitePrincipaleEtablissement"),
        )

    now = period(F.when(F.col("c_acctbal") < 0, "F").otherwise("A"), F.col("c_mktsegment"))
    before = period(F.lit("A"), F.lit("00.00Z"))
    person, nameless = F.col("c_mktsegment") == "HOUSEHOLD", (
        (F.col("c_mktsegment") == "AUTOMOBILE") & (F.col("c_acctbal") < 1000)
    )
    unit = F.struct(
        F.when(person, "").when(~nameless, F.col("company")).alias("denominationUniteLegale"),
        F.when(person, F.col("p_name")).alias("nomUniteLegale"),
        F.when(person, F.col("token")).alias("prenomUsuelUniteLegale"),
    )
    fields = {
        "siren": siren,
        "nic": F.lit("00019"),
        "siret": F.concat(siren, F.lit("00019")),
        "statutDiffusionEtablissement": F.lit("O"),
        "dateCreationEtablissement": F.lit("1990-01-01"),
        "etablissementSiege": F.when(F.col("c_acctbal") < 9000, F.lit(True)),
        "dateDernierTraitementEtablissement": F.lit(DAY_1.isoformat()),
        "adresseEtablissement": F.when(F.col("c_acctbal") < 9500, address),
        "uniteLegale": unit,
        "periodesEtablissement": F.when(
            F.col("c_acctbal") < 9800, F.array(now, before)
        ).otherwise(F.slice(F.array(now), 1, 0)),
    }
    return df.select(F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()])).alias("json"))


def candidates_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = normalize.parse_json(raw_establishments(spark, sf_dir), "json", schemas.RAW_ESTABLISHMENT)
    return normalize.normalize_candidates(raw)


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a matching candidate: what ``candidates_from_json`` arrives at."""
    located = F.col("c_acctbal") < 9500
    nameless = (F.col("c_mktsegment") == "AUTOMOBILE") & (F.col("c_acctbal") < 1000)
    person = F.concat_ws(" ", "p_name", "token")
    values = {
        "siren": padded("c_custkey"),
        "siret": F.concat(padded("c_custkey"), F.lit("00019")),
        "denomination": F.when(F.col("c_mktsegment") == "HOUSEHOLD", person).when(
            ~nameless, F.col("company")
        ),
        "numero_voie": F.when(located, F.col("c_nationkey").cast("string")),
        "type_voie": F.when(located, "RUE"),
        "libelle_voie": F.when(located, F.col("c_name")),
        "code_postal": F.when(located, postal("c_nationkey")),
        "libelle_commune": F.when(located, F.col("n_name")),
    }
    df = customers(spark, sf_dir)
    return df.select([values[c].alias(c) for c in schemas.BRONZE_CANDIDATE_COLUMNS])


# --- announcements ---------------------------------------------------------------------------------


def announced_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").join(
        customers(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey")
    )


def announced_values() -> dict[str, Column]:
    """What an announcement says about an order, by name of the bronze column."""
    named = by(
        "o_orderpriority",
        {
            "1-URGENT": F.concat(F.lit("  "), F.upper("company"), F.lit(" ")),
            "2-HIGH": F.concat(F.col("company"), F.lit(" sarl")),
            "3-MEDIUM": F.translate("company", "i", "y"),
            "4-NOT SPECIFIED": F.when(
                F.col("o_orderstatus") == "P", F.concat(F.col("company"), F.lit(" sas"))
            ).otherwise(F.col("company")),
        },
    )
    family = by(
        "o_orderpriority",
        {
            "1-URGENT": F.lit(BANKRUPTCY),
            "2-HIGH": F.lit("Ventes"),
            "3-MEDIUM": F.lit("Créations"),
            "4-NOT SPECIFIED": F.lit("Modifications"),
        },
    )
    town = F.when(
        F.col("o_orderstatus") == "P", F.replace("n_name", F.lit("NATION"), F.lit("NATIONS"))
    ).otherwise(F.col("n_name"))
    return {
        "id": F.concat(F.lit("A"), F.col("o_orderkey").cast("string")),
        "dateparution": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "numeroannonce": F.col("o_orderkey"),
        "typeavis_lib": F.lit("Avis initial"),
        "familleavis_lib": family,
        "tribunal": F.concat(F.lit("TC "), F.col("n_name")),
        "commercant": named,
        "ville": town,
        "cp": postal("c_nationkey"),
    }


def raw_announcements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON records of the announcement API; ``registre`` is a text, a list or missing."""
    siren = padded("o_custkey")
    spaced = F.concat_ws(" ", siren.substr(1, 3), siren.substr(4, 3), siren.substr(7, 3))
    register = by(
        "o_orderpriority",
        {
            "1-URGENT": F.to_json(F.array(siren, spaced)),
            "2-HIGH": F.concat(F.lit('"'), spaced, F.lit(" RCS "), F.col("n_name"), F.lit('"')),
            "3-MEDIUM": F.concat(F.lit('"RCS '), F.col("n_name"), F.lit('"')),
            "4-NOT SPECIFIED": F.concat(F.lit('"12 RCS PARIS '), spaced, F.lit('"')),
        },
        F.lit("null"),
    )
    values = announced_values() | {
        "siren": by("o_orderstatus", {"F": siren, "O": F.lit("")}),
        "numerodepartement": padded("c_nationkey", 2),
    }
    texts = F.to_json(F.struct(*[value.alias(name) for name, value in values.items()]))
    # The register is added as JSON, not as text, since it may be a list.
    whole = F.concat(
        F.substring_index(texts, "}", 1), F.lit(',"registre":'), register, F.lit("}")
    )
    return announced_orders(spark, sf_dir).select(whole.alias("json"))


def parsed_announcements(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_announcements(spark, sf_dir)
    return normalize.parse_json(raw, "json", schemas.RAW_ANNOUNCEMENT)


def bronze_announcements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalize_announcements(parsed_announcements(spark, sf_dir))


def announcements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver announcements: what cleaning ``bronze_announcements`` arrives at."""
    said = announced_values()
    declares = (F.col("o_orderstatus") == "F") | F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    values = said | {
        "type_avis": said["typeavis_lib"],
        "famille_avis": said["familleavis_lib"],
        "code_postal": said["cp"],
        "date_parution": F.col("o_orderdate").cast("date"),
        "numero_annonce": F.col("o_orderkey").cast("string"),
        "siren_declared": F.when(declares, padded("o_custkey")),
        "denomination": F.lit(None).cast("string"),
    }
    df = announced_orders(spark, sf_dir)
    return df.select([values[c].alias(c) for c in schemas.SILVER_ANNOUNCEMENT.fieldNames()])


# --- markets ---------------------------------------------------------------------------------------


def bronze_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as markets: one per order, won by the suppliers of its items."""
    returned, status = F.col("l_returnflag"), F.col("l_linestatus")
    unknown = (returned == "N") & (status == "F")
    winner = F.concat(padded("l_suppkey"), F.lit("00027"))
    day = F.col("l_shipdate").cast("date")
    values = {
        "uid": F.concat(F.lit("M"), F.col("l_orderkey").cast("string")),
        "acheteur_id": F.concat(F.lit("P"), F.col("l_partkey").cast("string")),
        "acheteur_nom": F.concat(F.lit("Acheteur "), F.col("l_partkey").cast("string")),
        "titulaire_id": F.when(~unknown, winner),
        "titulaire_typeIdentifiant": F.when(returned == "R", "Siret")
        .when(returned == "A", "SIRET")
        .when(status == "O", "TVA"),
        "titulaire_nom": F.when(~unknown, F.concat(F.lit("Supplier "), winner)),
        "objet": F.concat(F.lit("Lot "), F.col("l_linenumber").cast("string")),
        "montant": F.col("l_extendedprice"),
        "codeCPV": F.col("l_partkey").cast("string"),
        "dateNotification": day,
        "acheteur_departement_code": padded("l_linenumber", 2),
        "datePublicationDonnees": F.date_add(day, 30),
        "donneesActuelles": status == "O",
    }
    df = table(spark, sf_dir, "lineitem")
    return df.select([values[c].alias(c) for c in schemas.BRONZE_MARKET.fieldNames()])


def markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_markets(bronze_markets(spark, sf_dir))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned establishments to check winners against: suppliers, current unless in debt."""
    df = table(spark, sf_dir, "supplier")
    sound = F.col("s_acctbal") >= 0
    siren = padded("s_suppkey")
    return df.select(
        siren.alias("siren"),
        F.concat(siren, F.lit("00027")).alias("siret"),
        F.lit(DAY_1).alias("valid_from"),
        F.when(~sound, F.lit(DAY_2)).alias("valid_to"),
        sound.alias("is_current"),
    )
