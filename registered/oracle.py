"""SQL equivalent of each registered query, on the same tables, for a database to check against.

Named parts are common table expressions; ``sql`` puts the ones a query mentions in front of it.
"""

from __future__ import annotations

import re

from ledgerline import schemas
from ledgerline.operators.model import LinkageModel
from registered.inputs import BANKRUPTCY, MODEL

PARTS: dict[str, str] = {}


def sql(body: str) -> str:
    """``body`` preceded by the parts it needs, directly or through other parts."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in PARTS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(PARTS[name])
                needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({PARTS[n]})" for n in needed) + "\n" + body


def listed(columns, prefix: str = "") -> str:
    return ", ".join(f"{prefix}{c}" for c in columns)


def nulls_first(columns) -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in columns)


# --- establishments --------------------------------------------------------------------------------

BRONZE = schemas.BRONZE_ESTABLISHMENT_COLUMNS
SILVER = schemas.SILVER_ESTABLISHMENT.fieldNames()
GOLD = schemas.GOLD_ESTABLISHMENT.fieldNames()

PARTS["cust"] = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, n_name,
       coalesce(p_name, 'sans nom') AS p_name, substr(md5(c_name), 1, 8) AS token,
       coalesce(p_name, 'sans nom') || ' ' || substr(md5(c_name), 1, 8) || ' ' || lower(c_mktsegment)
         AS company,
       lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS siren,
       lpad(CAST(c_custkey AS VARCHAR), 9, '0') || '00019' AS siret,
       lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '000' AS postal
FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN part ON c_custkey = p_partkey
"""


def customer_rows(activity: str, head: str, processed: str) -> str:
    return f"""
    SELECT siren, '00019' AS nic, siret, 'O' AS statutDiffusionEtablissement,
      CASE WHEN c_acctbal < 0 THEN 'inconnue'
           ELSE CAST(DATE '1990-01-01' + c_nationkey * 200 AS VARCHAR) END
        AS dateCreationEtablissement,
      {head} AS etablissementSiege, CAST(c_nationkey AS VARCHAR) AS numeroVoieEtablissement,
      'RUE' AS typeVoieEtablissement, c_name AS libelleVoieEtablissement,
      postal AS codePostalEtablissement, n_name AS libelleCommuneEtablissement,
      {activity} AS activitePrincipaleEtablissement,
      CASE WHEN c_acctbal < 0 THEN 'F' ELSE 'A' END AS etatAdministratifEtablissement,
      {processed} AS dateDernierTraitementEtablissement
    FROM cust"""


_RICH = "CASE WHEN c_acctbal >= 5000 THEN 'true' ELSE 'false' END"
PARTS["stock_rows"] = customer_rows(
    "c_mktsegment",
    f"CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN {_RICH} END",
    "'2024-01-01'",
)
PARTS["diff_rows"] = (
    customer_rows(
        "CASE WHEN c_mktsegment = 'BUILDING' THEN 'CONSTRUCTION' ELSE c_mktsegment END",
        f"CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'true' ELSE {_RICH} END",
        "CASE WHEN c_mktsegment = 'MACHINERY' THEN '2024-01-01' ELSE '2024-02-01' END",
    )
    + """ WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')
    UNION ALL
    SELECT lpad(CAST(s_suppkey AS VARCHAR), 9, '0'), '00027',
      lpad(CAST(s_suppkey AS VARCHAR), 9, '0') || '00027', NULL, NULL, NULL, NULL, NULL, s_name,
      lpad(CAST(s_nationkey AS VARCHAR), 2, '0') || '000', n_name, NULL,
      CASE WHEN s_acctbal < 0 THEN 'F' ELSE 'A' END, '2024-02-01'
    FROM supplier JOIN nation ON s_nationkey = n_nationkey"""
)
PARTS["malformed_rows"] = """
SELECT NULL AS siren, NULL AS nic, NULL AS siret, NULL AS a, NULL AS b, NULL AS c, NULL AS d, NULL AS e,
  NULL AS f, NULL AS g, r_name AS h, NULL AS i, NULL AS j, NULL AS k FROM region
UNION ALL
SELECT NULL, NULL, '', NULL, NULL, NULL, NULL, NULL, NULL, NULL, n_name, NULL, NULL, NULL FROM nation
"""
PARTS["bronze_rows"] = (
    "SELECT * FROM stock_rows UNION ALL SELECT * FROM diff_rows"
    " UNION ALL SELECT * FROM malformed_rows"
)


def cleaned(rows: str) -> str:
    rest = [c for c in BRONZE if c not in ("siret", "dateDernierTraitementEtablissement")]
    return f"""
    SELECT siren, nic, siret, statutDiffusionEtablissement AS statut_diffusion,
      CAST(try_strptime(dateCreationEtablissement, '%Y-%m-%d') AS DATE) AS date_creation,
      etablissementSiege = 'true' AS etablissement_siege,
      numeroVoieEtablissement AS numero_voie, typeVoieEtablissement AS type_voie,
      libelleVoieEtablissement AS libelle_voie, codePostalEtablissement AS code_postal,
      libelleCommuneEtablissement AS libelle_commune,
      activitePrincipaleEtablissement AS activite_principale,
      etatAdministratifEtablissement AS etat_administratif,
      CAST(try_strptime(dateDernierTraitementEtablissement, '%Y-%m-%d') AS DATE)
        AS date_dernier_traitement
    FROM (SELECT *, row_number() OVER (PARTITION BY siret
            ORDER BY dateDernierTraitementEtablissement DESC NULLS LAST, {nulls_first(rest)}) AS place
          FROM {rows} WHERE siret IS NOT NULL AND siret <> '') WHERE place = 1"""


def same(columns, left: str, right: str) -> str:
    return " AND ".join(f"{left}.{c} IS NOT DISTINCT FROM {right}.{c}" for c in columns)


def two_runs(first: str, second: str, columns, keys, tracked) -> str:
    """Versions after loading ``first`` on one day and applying ``second`` on the next."""
    match, unchanged = same(keys, "o", "n"), same(tracked, "o", "n")
    return f"""
    SELECT {listed(columns, "o.")}, DATE '2024-01-01' AS valid_from,
      CASE WHEN n.{keys[0]} IS NOT NULL AND NOT ({unchanged}) THEN DATE '2024-02-01' END AS valid_to,
      NOT (n.{keys[0]} IS NOT NULL AND NOT ({unchanged})) AS is_current
    FROM {first} o LEFT JOIN {second} n ON {match}
    UNION ALL
    SELECT {listed(columns, "n.")}, DATE '2024-02-01', NULL, true
    FROM {second} n LEFT JOIN {first} o ON {match}
    WHERE o.{keys[0]} IS NULL OR NOT ({unchanged})"""


PARTS["day_one"] = cleaned("stock_rows")
PARTS["day_two"] = cleaned("diff_rows")
PARTS["etab_gold"] = two_runs(
    "day_one", "day_two", SILVER, schemas.ESTABLISHMENT_KEYS, schemas.ESTABLISHMENT_TRACKED
)

# --- announcements and candidates ------------------------------------------------------------------

PARTS["cand"] = """
SELECT siren, siret,
  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN p_name || ' ' || token
       WHEN c_mktsegment = 'AUTOMOBILE' AND c_acctbal < 1000 THEN NULL ELSE company END
    AS denomination,
  CASE WHEN c_acctbal < 9500 THEN CAST(c_nationkey AS VARCHAR) END AS numero_voie,
  CASE WHEN c_acctbal < 9500 THEN 'RUE' END AS type_voie,
  CASE WHEN c_acctbal < 9500 THEN c_name END AS libelle_voie,
  CASE WHEN c_acctbal < 9500 THEN postal END AS code_postal,
  CASE WHEN c_acctbal < 9500 THEN n_name END AS libelle_commune,
  c_acctbal
FROM cust"""
PARTS["ann"] = f"""
SELECT 'A' || CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderdate AS DATE) AS date_parution,
  CAST(o_orderkey AS VARCHAR) AS numero_annonce, 'Avis initial' AS type_avis,
  CASE o_orderpriority WHEN '1-URGENT' THEN '{BANKRUPTCY}' WHEN '2-HIGH' THEN 'Ventes'
    WHEN '3-MEDIUM' THEN 'Créations' WHEN '4-NOT SPECIFIED' THEN 'Modifications' END AS famille_avis,
  'TC ' || n_name AS tribunal,
  CASE o_orderpriority WHEN '1-URGENT' THEN '  ' || upper(company) || ' '
    WHEN '2-HIGH' THEN company || ' sarl' WHEN '3-MEDIUM' THEN replace(company, 'i', 'y')
    WHEN '4-NOT SPECIFIED' THEN company || CASE WHEN o_orderstatus = 'P' THEN ' sas' ELSE '' END
    END AS commercant,
  CAST(NULL AS VARCHAR) AS denomination,
  CASE WHEN o_orderstatus = 'F' OR o_orderpriority IN ('1-URGENT', '2-HIGH') THEN siren END
    AS siren_declared,
  CASE WHEN o_orderstatus = 'P' THEN replace(n_name, 'NATION', 'NATIONS') ELSE n_name END AS ville,
  postal AS code_postal, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS departement
FROM orders JOIN cust ON o_custkey = c_custkey"""
ANNOUNCEMENT = schemas.SILVER_ANNOUNCEMENT.fieldNames()

PARTS["exact_links"] = """
SELECT id AS bodacc_announcement_id, siren_declared AS siren_bodacc, siret AS siret_siege,
  'exact_siren' AS match_method, CAST(1.0 AS DOUBLE) AS match_confidence
FROM ann JOIN cand ON siren_declared = siren"""
PARTS["all_links"] = """
SELECT * FROM exact_links UNION ALL
SELECT id, NULL, NULL, 'unresolved', NULL FROM ann
WHERE id NOT IN (SELECT bodacc_announcement_id FROM exact_links)"""
PARTS["second_links"] = """
SELECT bodacc_announcement_id, siren_bodacc,
  CASE WHEN famille_avis IS DISTINCT FROM 'Ventes' THEN siret_siege END AS siret_siege,
  CASE WHEN famille_avis = 'Ventes' THEN 'unresolved' ELSE match_method END AS match_method,
  CASE WHEN famille_avis IS DISTINCT FROM 'Ventes' THEN match_confidence * 0.5 END AS match_confidence
FROM all_links JOIN ann ON bodacc_announcement_id = id"""
LINK = schemas.ANNOUNCEMENT_LINK.fieldNames()
PARTS["link_gold"] = two_runs(
    "all_links", "second_links", LINK, schemas.LINK_KEYS, schemas.LINK_TRACKED
)
PARTS["served"] = """
SELECT siret_siege, bodacc_announcement_id, siren_bodacc, match_method, match_confidence,
  date_parution, type_avis, famille_avis, tribunal, commercant, denomination, ville, code_postal,
  valid_from, valid_to, is_current
FROM link_gold JOIN ann ON bodacc_announcement_id = id WHERE siret_siege IS NOT NULL"""

# --- linkage ---------------------------------------------------------------------------------------

PARTS["left_side"] = """
SELECT id AS uid, siren_declared, lower(trim(coalesce(commercant, ''))) AS denomination_clean,
  lower(trim(coalesce(code_postal, '') || ' ' || coalesce(ville, ''))) AS adresse_clean FROM ann"""
PARTS["right_side"] = """
SELECT siret AS uid, lower(trim(coalesce(denomination, ''))) AS denomination_clean,
  lower(trim(coalesce(code_postal, '') || ' ' || coalesce(libelle_commune, ''))) AS adresse_clean
FROM cand"""


def value_rows(side: str, where: str) -> str:
    return f"""
    SELECT denomination_clean AS name, adresse_clean AS address, count(*) AS n, min(uid) AS uid,
      substr(denomination_clean, 1, 4) AS block FROM {side} WHERE {where} GROUP BY 1, 2"""


PARTS["left_open"] = value_rows("left_side", "siren_declared IS NULL")
PARTS["left_unmatched"] = value_rows("left_side", "uid NOT IN (SELECT bodacc_announcement_id FROM exact_links)")
PARTS["left_matched"] = value_rows("left_side", "siren_declared IS NOT NULL")
PARTS["right_values"] = value_rows("right_side", "true")


def address_level(a: str, b: str) -> str:
    return (
        f"CASE WHEN {a} = {b} THEN 3 WHEN levenshtein({a}, {b}) <= 1 THEN 2"
        f" WHEN levenshtein({a}, {b}) <= 2 THEN 1 ELSE 0 END"
    )


def name_level(a: str, b: str) -> str:
    # The shorter text is matched against the longer one.
    score = (
        f"round(CASE WHEN length({a}) <= length({b}) THEN jaro_winkler_similarity({b}, {a})"
        f" ELSE jaro_winkler_similarity({a}, {b}) END, 9)"
    )
    return f"CASE WHEN {a} = {b} THEN 3 WHEN {score} >= 0.9 THEN 2 WHEN {score} >= 0.7 THEN 1 ELSE 0 END"


def odds(model: LinkageModel, name: str = "name_level", address: str = "address_level") -> str:
    def factor(level: str, ms, us) -> str:
        cases = " ".join(
            f"WHEN {i} THEN CAST({m!r} AS DOUBLE) / CAST({u!r} AS DOUBLE)"
            for i, (m, u) in enumerate(zip(ms, us, strict=True))
        )
        return f"(CASE {level} {cases} END)"

    prior = f"CAST({model.prior!r} AS DOUBLE)"
    return (
        f"({prior} / (1 - {prior}) * {factor(name, model.m_name, model.u_name)}"
        f" * {factor(address, model.m_address, model.u_address)})"
    )


def best_of(left: str) -> str:
    return f"""
    SELECT name, address, uid, p AS match_probability FROM (
      SELECT *, row_number() OVER (PARTITION BY name, address ORDER BY p DESC, uid) AS place FROM (
        SELECT name, address, uid, odds / (1 + odds) AS p FROM (
          SELECT *, {odds(MODEL)} AS odds FROM (
            SELECT l.name, l.address, r.uid, {name_level("l.name", "r.name")} AS name_level,
              {address_level("l.address", "r.address")} AS address_level
            FROM {left} l JOIN right_values r ON l.block = r.block)))
      WHERE p >= {MODEL.threshold!r}) WHERE place = 1"""


# Announcements left over by the declared company: every customer is a candidate.
PARTS["best_open"] = best_of("left_open")
PARTS["best_unmatched"] = best_of("left_unmatched")
PARTS["best_matched"] = best_of("left_matched")
PARTS["predicted"] = """
SELECT l.uid AS bodacc_announcement_id, b.uid AS siret_siege
FROM left_side l JOIN best_matched b ON l.denomination_clean = b.name AND l.adresse_clean = b.address
WHERE l.siren_declared IS NOT NULL"""

# --- markets ---------------------------------------------------------------------------------------

_UNKNOWN = "(l_returnflag = 'N' AND l_linestatus = 'F')"
_WINNER = "lpad(CAST(l_suppkey AS VARCHAR), 9, '0') || '00027'"
PARTS["bronze_mkt"] = f"""
SELECT 'M' || CAST(l_orderkey AS VARCHAR) AS uid, 'P' || CAST(l_partkey AS VARCHAR) AS acheteur_id,
  'Acheteur ' || CAST(l_partkey AS VARCHAR) AS acheteur_nom,
  CASE WHEN NOT {_UNKNOWN} THEN {_WINNER} END AS titulaire_id,
  CASE WHEN l_returnflag = 'R' THEN 'Siret' WHEN l_returnflag = 'A' THEN 'SIRET'
       WHEN l_linestatus = 'O' THEN 'TVA' END AS "titulaire_typeIdentifiant",
  CASE WHEN NOT {_UNKNOWN} THEN 'Supplier ' || {_WINNER} END AS titulaire_nom,
  'Lot ' || CAST(l_linenumber AS VARCHAR) AS objet, l_extendedprice AS montant,
  CAST(l_partkey AS VARCHAR) AS "codeCPV", CAST(l_shipdate AS DATE) AS "dateNotification",
  lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS acheteur_departement_code,
  CAST(l_shipdate AS DATE) + 30 AS "datePublicationDonnees", l_linestatus = 'O' AS "donneesActuelles"
FROM lineitem"""
PARTS["mkt"] = """
SELECT uid, acheteur_id, acheteur_nom, titulaire_id,
  upper("titulaire_typeIdentifiant") AS titulaire_type_identifiant, titulaire_nom, objet, montant,
  "codeCPV" AS code_cpv, "dateNotification" AS date_notification FROM bronze_mkt"""
PARTS["resolved"] = """
SELECT uid, titulaire_id,
  CASE WHEN titulaire_type_identifiant = 'SIRET' THEN titulaire_id END AS siret_titulaire,
  CASE WHEN titulaire_type_identifiant = 'SIRET' THEN 'source_siret' ELSE 'unresolved' END
    AS match_method, acheteur_id, acheteur_nom, montant, objet, code_cpv FROM mkt"""
PARTS["validated"] = """
SELECT uid, titulaire_id, siret_titulaire, match_method,
  CASE WHEN siret_titulaire IS NOT NULL THEN siret_titulaire IN (
    SELECT lpad(CAST(s_suppkey AS VARCHAR), 9, '0') || '00027' FROM supplier WHERE s_acctbal >= 0)
  END AS siret_validated_in_sirene, acheteur_id, acheteur_nom, montant, objet, code_cpv
FROM resolved"""
MARKET = schemas.MARKET_LINK.fieldNames()
_MARKET_REST = [c for c in MARKET if c not in schemas.MARKET_KEYS]


def one_market(rows: str) -> str:
    return f"""
    SELECT {listed(MARKET)} FROM (SELECT *, row_number() OVER (
        PARTITION BY uid, titulaire_id ORDER BY {nulls_first(_MARKET_REST)}) AS place FROM {rows})
    WHERE place = 1"""


PARTS["first_mkt"] = one_market("validated")
PARTS["second_mkt"] = one_market(
    "(SELECT * REPLACE (CASE WHEN objet = 'Lot 1' THEN montant + 1000.0 ELSE montant END AS montant)"
    " FROM validated)"
)
PARTS["mkt_gold"] = two_runs(
    "first_mkt", "second_mkt", MARKET, schemas.MARKET_KEYS, schemas.MARKET_TRACKED
)

# One department's year, as the daily job takes it.
PARTS["scoped_mkt"] = PARTS["mkt"].strip() + """ WHERE acheteur_departement_code = '03'
  AND "datePublicationDonnees" >= DATE '1997-06-01' AND "donneesActuelles\""""
PARTS["scoped_resolved"] = PARTS["resolved"].replace("FROM mkt", "FROM scoped_mkt")
PARTS["scoped_validated"] = PARTS["validated"].replace("FROM resolved", "FROM scoped_resolved")

# --- quality ---------------------------------------------------------------------------------------

PARTS["bad_links"] = """
SELECT * FROM mkt_gold
UNION ALL SELECT * REPLACE (CAST(NULL AS BOOLEAN) AS is_current) FROM mkt_gold WHERE match_method = 'unresolved'
UNION ALL SELECT * REPLACE (DATE '2024-03-01' AS valid_to) FROM mkt_gold WHERE match_method = 'unresolved' AND is_current"""
PARTS["versions"] = """
SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN 'A' || CAST(o_custkey AS VARCHAR) END AS key,
  o_orderpriority AS method, CAST(o_orderdate AS DATE) AS valid_from,
  CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + 30 END AS valid_to,
  CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderstatus <> 'F' END AS is_current
FROM orders"""
_NULL_COLUMNS = ["key", "method", "valid_from", "valid_to", "is_current"]

# Replay: the stock, the diff, the stock again.
PARTS["timeline"] = f"""
SELECT *, DATE '2024-01-01' AS day FROM day_one UNION ALL
SELECT *, DATE '2024-02-01' FROM day_two UNION ALL SELECT *, DATE '2024-03-01' FROM day_one"""
PARTS["opening"] = f"""
SELECT * FROM (SELECT *,
    row({listed(schemas.ESTABLISHMENT_TRACKED)}) IS NOT DISTINCT FROM
    lag(row({listed(schemas.ESTABLISHMENT_TRACKED)})) OVER (PARTITION BY siret ORDER BY day) AS same
  FROM timeline) WHERE NOT same"""

_FLAT = f"""
SELECT siren, '00019' AS nic, siret, 'O' AS "statutDiffusionEtablissement",
  '1990-01-01' AS "dateCreationEtablissement",
  CASE WHEN c_acctbal < 9000 THEN 'true' ELSE 'false' END AS "etablissementSiege",
  CASE WHEN c_acctbal < 9500 THEN CAST(c_nationkey AS VARCHAR) END AS "numeroVoieEtablissement",
  CASE WHEN c_acctbal < 9500 THEN 'RUE' END AS "typeVoieEtablissement",
  CASE WHEN c_acctbal < 9500 THEN c_name END AS "libelleVoieEtablissement",
  CASE WHEN c_acctbal < 9500 THEN postal END AS "codePostalEtablissement",
  CASE WHEN c_acctbal < 9500 THEN n_name END AS "libelleCommuneEtablissement",
  CASE WHEN c_acctbal < 9800 THEN c_mktsegment END AS "activitePrincipaleEtablissement",
  CASE WHEN c_acctbal >= 9800 THEN NULL WHEN c_acctbal < 0 THEN 'F' ELSE 'A' END
    AS "etatAdministratifEtablissement",
  '2024-01-01' AS "dateDernierTraitementEtablissement" FROM cust"""
_CANDIDATE = listed(schemas.BRONZE_CANDIDATE_COLUMNS)
_ACTIVE_HEAD = "c_acctbal < 9000 AND c_acctbal >= 0"

ORACLE: dict[str, str] = {
    name: sql(body)
    for name, body in {
        "csv_bootstrap": "SELECT "
        + ", ".join(f"coalesce({c}, '') AS {c}" for c in BRONZE)
        + ", DATE '2024-01-01' AS ingestion_date FROM stock_rows",
        "bronze_by_department": f"""
            SELECT siren, siret, denomination, code_postal, substr(code_postal, 1, 2) AS department,
              DATE '2024-01-01' AS ingestion_date
            FROM cand WHERE {_ACTIVE_HEAD} AND substr(code_postal, 1, 2) IN ('02', '17')""",
        "flatten_establishments": _FLAT,
        "normalize_announcements": """
            SELECT id, CAST(date_parution AS VARCHAR) AS dateparution,
              numero_annonce AS numeroannonce, type_avis AS typeavis_lib,
              famille_avis AS familleavis_lib, tribunal, commercant, siren_declared, ville,
              code_postal AS cp, denomination FROM ann""",
        "normalize_candidates": f"SELECT {_CANDIDATE} FROM cand",
        "extract_siren": r"""
            SELECT doc_id, CASE WHEN doc_id % 3 < 2 THEN lpad(CAST(doc_id AS VARCHAR), 9, '0')
                WHEN length(digits) = 9 THEN digits END AS siren FROM (
              SELECT doc_id, replace(regexp_extract(text,
                '(?:^|[^\p{L}\p{N}_])(\d[\d ]{0,11}\d)(?:$|[^\p{L}\p{N}_])', 1), ' ', '') AS digits
              FROM documents)""",
        "scope_markets": """
            SELECT * FROM bronze_mkt WHERE acheteur_departement_code = '03'
              AND "datePublicationDonnees" >= DATE '1998-01-01' AND "donneesActuelles" """,
        "window_announcements": """
            SELECT id, CAST(date_parution AS VARCHAR) AS dateparution,
              departement AS numerodepartement FROM ann
            WHERE date_parution >= DATE '1997-01-01' AND date_parution < DATE '1998-01-01'
              AND departement = '08'""",
        "updated_between": """
            SELECT siret, dateDernierTraitementEtablissement FROM bronze_rows
            WHERE dateDernierTraitementEtablissement BETWEEN '2024-01-02' AND '2024-02-01'""",
        "scope_candidates": f"""
            SELECT {_CANDIDATE} FROM cand WHERE {_ACTIVE_HEAD} AND code_postal LIKE '08%'""",
        "clean_establishments": cleaned("bronze_rows"),
        "clean_announcements": f"SELECT {listed(ANNOUNCEMENT)} FROM ann",
        "clean_markets": "SELECT * FROM mkt",
        "reject_quarantine": """
            SELECT siren, siret, dateCreationEtablissement,
              CASE WHEN siret IS NULL OR siret = '' THEN 'missing siret'
                   ELSE 'unreadable dateCreationEtablissement' END AS reject_reason
            FROM bronze_rows WHERE siret IS NULL OR siret = ''
              OR dateCreationEtablissement = 'inconnue'""",
        "insert_if_absent": """
            SELECT * FROM day_one UNION ALL
            SELECT * FROM day_two WHERE siret NOT IN (SELECT siret FROM day_one)""",
        "scd2_establishments": "SELECT * FROM etab_gold",
        "incremental_scd2": "SELECT * FROM etab_gold",
        "scd2_as_of": """
            SELECT siret, activite_principale, etablissement_siege, valid_from, valid_to
            FROM etab_gold WHERE valid_from <= DATE '2024-01-15'
              AND (valid_to IS NULL OR valid_to > DATE '2024-01-15')""",
        "scd2_links": "SELECT * FROM link_gold",
        "scd2_markets_nullsafe": "SELECT * FROM mkt_gold",
        "scd2_replay": f"""
            SELECT {listed(SILVER)}, day AS valid_from, until AS valid_to,
              until IS NULL AS is_current
            FROM (SELECT *, lead(day) OVER (PARTITION BY siret ORDER BY day) AS until FROM opening)""",
        "exact_match": "SELECT * FROM exact_links",
        "unmatched": """
            SELECT id, siren_declared, commercant FROM ann
            WHERE id NOT IN (SELECT bodacc_announcement_id FROM exact_links)""",
        "backlog": """
            SELECT id, famille_avis FROM ann WHERE id NOT IN (
              SELECT bodacc_announcement_id FROM all_links WHERE match_method <> 'unresolved')""",
        "unresolved_completion": "SELECT * FROM all_links",
        "prepare_left": "SELECT uid, denomination_clean, adresse_clean FROM left_side",
        "prepare_right": "SELECT * FROM right_side",
        "block_counts": """
            SELECT block, l.n AS n_left, r.n AS n_right, l.n * r.n AS pairs
            FROM (SELECT block, CAST(sum(n) AS BIGINT) AS n FROM left_open GROUP BY 1) l
            JOIN (SELECT block, CAST(sum(n) AS BIGINT) AS n FROM right_values GROUP BY 1) r
            USING (block)""",
        "near_addresses": f"""
            SELECT * FROM (SELECT l.address AS address_l, r.address AS address_r,
                {address_level("l.address", "r.address")} AS address_level
              FROM (SELECT DISTINCT address FROM left_open) l
              JOIN (SELECT DISTINCT address FROM right_values) r ON true) WHERE address_level > 0""",
        "gamma_histogram": f"""
            SELECT {address_level("l.address", "r.address")} AS address_level,
              CAST(sum(l.n * r.n) AS BIGINT) AS pairs
            FROM left_open l JOIN right_values r USING (block) GROUP BY 1""",
        "unmatched_block_counts": """
            SELECT block, l.n AS n_left, r.n AS n_right, l.n * r.n AS pairs
            FROM (SELECT block, CAST(sum(n) AS BIGINT) AS n FROM left_unmatched GROUP BY 1) l
            JOIN (SELECT block, CAST(sum(n) AS BIGINT) AS n FROM right_values GROUP BY 1) r
            USING (block)""",
        "unmatched_near_addresses": f"""
            SELECT * FROM (SELECT l.address AS address_l, r.address AS address_r,
                {address_level("l.address", "r.address")} AS address_level
              FROM (SELECT DISTINCT address FROM left_unmatched) l
              JOIN (SELECT DISTINCT address FROM right_values) r ON true) WHERE address_level > 0""",
        "unmatched_gamma_histogram": f"""
            SELECT {address_level("l.address", "r.address")} AS address_level,
              CAST(sum(l.n * r.n) AS BIGINT) AS pairs
            FROM left_unmatched l JOIN right_values r USING (block) GROUP BY 1""",
        "unmatched_fuzzy_scores": """
            SELECT name, address, uid, round(match_probability, 6) AS match_probability
            FROM best_unmatched""",
        "gamma_levels": f"""
            SELECT bodacc_announcement_id, siret_siege, name_level, address_level,
              round(odds / (1 + odds), 6) AS match_probability FROM (
              SELECT *, {odds(MODEL)} AS odds FROM (
                SELECT bodacc_announcement_id, siret_siege,
                  {name_level("l.denomination_clean", "r.denomination_clean")} AS name_level,
                  {address_level("l.adresse_clean", "r.adresse_clean")} AS address_level
                FROM exact_links JOIN left_side l ON l.uid = bodacc_announcement_id
                JOIN right_side r ON r.uid = siret_siege))""",
        "fuzzy_score_fixed_params": """
            SELECT name, address, uid, round(match_probability, 6) AS match_probability
            FROM best_open""",
        "cascade_fixed_params": """
            SELECT bodacc_announcement_id, siren_bodacc, siret_siege, match_method,
              match_confidence FROM exact_links
            UNION ALL
            SELECT l.uid, NULL, b.uid,
              CASE WHEN b.uid IS NULL THEN 'unresolved' ELSE 'splink_fuzzy' END,
              round(b.match_probability, 6)
            FROM left_side l LEFT JOIN best_open b
              ON l.denomination_clean = b.name AND l.adresse_clean = b.address
            WHERE l.siren_declared IS NULL""",
        "best_match": """
            SELECT bodacc_announcement_id, CAST(NULL AS VARCHAR) AS siren_bodacc, siret_siege,
              'splink_fuzzy' AS match_method, match_confidence FROM (
              SELECT *, row_number() OVER (PARTITION BY bodacc_announcement_id
                ORDER BY match_confidence DESC, siret_siege) AS place FROM (
                SELECT 'A' || CAST(l_orderkey AS VARCHAR) AS bodacc_announcement_id,
                  lpad(CAST(l_suppkey AS VARCHAR), 9, '0') || '00027' AS siret_siege,
                  l_quantity / 100.0 AS match_confidence FROM lineitem)) WHERE place = 1""",
        "combined_matches": """
            SELECT bodacc_announcement_id, siren_bodacc, siret_siege, match_method, match_confidence
            FROM exact_links
            UNION ALL
            SELECT bodacc_announcement_id, NULL, siret_siege, 'splink_fuzzy', match_confidence FROM (
              SELECT *, row_number() OVER (PARTITION BY bodacc_announcement_id
                ORDER BY match_confidence DESC, siret_siege) AS place FROM (
                SELECT 'A' || CAST(l_orderkey AS VARCHAR) AS bodacc_announcement_id,
                  lpad(CAST(l_suppkey AS VARCHAR), 9, '0') || '00027' AS siret_siege,
                  l_quantity / 100.0 AS match_confidence FROM lineitem)
              WHERE bodacc_announcement_id IN (SELECT id FROM ann)
                AND bodacc_announcement_id NOT IN (SELECT bodacc_announcement_id FROM exact_links))
            WHERE place = 1""",
        "evaluation_set": """
            SELECT id, commercant, ville, siret_siege AS true_siret_siege
            FROM ann JOIN exact_links ON id = bodacc_announcement_id""",
        "precision_recall": """
            SELECT total, predicted, correct,
              round(CASE WHEN predicted > 0 THEN CAST(correct AS DOUBLE) / predicted ELSE 0 END, 9)
                AS "precision",
              round(CASE WHEN total > 0 THEN CAST(correct AS DOUBLE) / total ELSE 0 END, 9) AS recall
            FROM (SELECT count(*) AS total, count(p.siret_siege) AS predicted,
                count(*) FILTER (p.siret_siege = e.siret_siege) AS correct
              FROM exact_links e LEFT JOIN predicted p USING (bodacc_announcement_id))""",
        "resolve_markets": "SELECT * FROM resolved",
        "validate_markets": "SELECT * FROM validated",
        "coverage_report": """
            SELECT total, resolved, total - resolved AS unresolved,
              round(CAST(resolved AS DOUBLE) / total, 9) AS resolved_share, validated_in_sirene,
              round(CAST(validated_in_sirene AS DOUBLE) / resolved, 9) AS validated_share
            FROM (SELECT count(*) AS total,
                count(*) FILTER (match_method = 'source_siret') AS resolved,
                count(*) FILTER (siret_validated_in_sirene) AS validated_in_sirene FROM validated)""",
        "unresolved_composition": """
            SELECT titulaire_type_identifiant, count(*) AS count,
              count(*) FILTER (titulaire_nom IS NULL) AS null_nom_count
            FROM mkt WHERE NOT EXISTS (SELECT 1 FROM validated v WHERE v.match_method = 'source_siret'
              AND v.uid = mkt.uid AND v.siret_titulaire = mkt.titulaire_id) GROUP BY 1""",
        "serving_join": "SELECT * FROM served",
        "search": """
            SELECT * FROM etab_gold WHERE is_current AND (siret = 'tion_1' OR siren = 'tion_1'
              OR libelle_commune ILIKE '%tion_1%') ORDER BY siret LIMIT 50""",
        "history": """
            SELECT * FROM etab_gold WHERE siret = '00000000300019'""",
        "establishments_daily": "SELECT * FROM etab_gold",
        "establishments_rerun": "SELECT * FROM etab_gold",
        "bronze_all_departments": f"""
            SELECT siren, siret, denomination, code_postal, substr(code_postal, 1, 2) AS department,
              DATE '2024-01-01' AS ingestion_date
            FROM cand WHERE code_postal IS NOT NULL AND {_ACTIVE_HEAD}""",
        "rejected_lines": """
            SELECT 'csv' AS source, CASE WHEN c_custkey % 10 > 1 THEN CAST(c_custkey AS VARCHAR) END AS key,
              CASE WHEN c_custkey % 10 > 1 THEN c_name END AS name,
              CASE c_custkey % 10 WHEN 0 THEN c_custkey || ',' || c_name
                WHEN 1 THEN c_custkey || ',' || c_name || ',' || c_nationkey || ',' || c_mktsegment || ',more' END AS row,
              CASE WHEN c_custkey % 10 <= 1 THEN 'not as many fields as columns' END AS reject_reason FROM customer
            UNION ALL
            SELECT 'json', CASE WHEN c_custkey % 10 NOT IN (3, 4) THEN CAST(c_custkey AS VARCHAR) END,
              CASE WHEN c_custkey % 10 NOT IN (3, 4) THEN c_name END,
              CASE c_custkey % 10 WHEN 3 THEN '{"key":' || c_custkey || ',"name'
                WHEN 4 THEN '{"key":"many","name":"' || c_name || '"}' END,
              CASE WHEN c_custkey % 10 IN (3, 4) THEN 'not a record of the layout' END FROM customer""",
        "repeated_rows": """
            SELECT CASE WHEN siret IS NULL OR siret = '' THEN 'missing siret' ELSE 'repeated siret' END AS reject_reason,
              siret, libelleCommuneEtablissement AS commune, dateDernierTraitementEtablissement AS processed
            FROM (SELECT *, row_number() OVER (PARTITION BY siret
                    ORDER BY dateDernierTraitementEtablissement DESC NULLS LAST, REST) AS place FROM bronze_rows)
            WHERE siret IS NULL OR siret = '' OR place > 1
            UNION ALL
            SELECT 'unreadable dateCreationEtablissement', siret, libelleCommuneEtablissement,
              dateDernierTraitementEtablissement
            FROM bronze_rows WHERE siret <> '' AND dateCreationEtablissement = 'inconnue'""".replace(
            "REST", nulls_first([c for c in BRONZE if c not in ("siret", "dateDernierTraitementEtablissement")])
        ),
        "markets_daily": f"""
            SELECT *, DATE '1998-06-01' AS valid_from, CAST(NULL AS DATE) AS valid_to,
              true AS is_current FROM ({one_market("scoped_validated")})""",
        "market_duplicates": f"""
            SELECT * EXCLUDE (place), 'repeated key' AS reject_reason FROM (
              SELECT {listed(MARKET)}, row_number() OVER (PARTITION BY uid, titulaire_id
                ORDER BY {nulls_first(_MARKET_REST)}) AS place FROM validated) WHERE place > 1""",
        "late_days": """
            SELECT d.siret, d.activite_principale, DATE '2024-01-15' AS day
            FROM day_two d JOIN etab_gold g ON g.siret = d.siret
            WHERE g.is_current AND g.valid_from = DATE '2024-02-01'""",
        "dq_market_versions": """
            SELECT uid, titulaire_id, valid_from, count(*) AS version_count FROM bad_links
            GROUP BY 1, 2, 3 HAVING count(*) > 1""",
        "dq_market_flags": """
            SELECT uid, titulaire_id, valid_from, valid_to, is_current FROM bad_links
            WHERE (is_current AND valid_to IS NOT NULL) OR (NOT is_current AND valid_to IS NULL)""",
        "dq_market_nulls": "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM bad_links"
            for c in ["uid", "titulaire_id", "match_method", "valid_from", "is_current"]
        )
        + ") WHERE nulls > 0",
        "announcements_of": "SELECT * FROM served WHERE siret_siege = '00000000700019' AND is_current",
        "markets_of": "SELECT * FROM mkt_gold WHERE siret_titulaire = '00000000700027' AND is_current",
        "won_then_bankrupt": f"""
            SELECT siren, count(*) AS markets_won, min(day) AS first_win, min(due) AS first_bankruptcy
            FROM (SELECT substr(titulaire_id, 1, 9) AS siren, date_notification AS day,
                (SELECT min(date_parution) FROM ann WHERE famille_avis = '{BANKRUPTCY}'
                  AND siren_declared = substr(titulaire_id, 1, 9)
                  AND date_parution >= date_notification
                  AND date_parution <= date_notification + INTERVAL 12 MONTH) AS due
              FROM mkt WHERE titulaire_type_identifiant = 'SIRET') WHERE due IS NOT NULL GROUP BY 1""",
        "dq_one_current": """
            SELECT key, count(*) AS current_count FROM versions WHERE is_current
            GROUP BY 1 HAVING count(*) <> 1""",
        "dq_unique_valid_from": """
            SELECT key, valid_from, count(*) AS version_count FROM versions
            GROUP BY 1, 2 HAVING count(*) > 1""",
        "dq_valid_to_flag": """
            SELECT key, valid_from, valid_to, is_current FROM versions
            WHERE (is_current AND valid_to IS NOT NULL) OR (NOT is_current AND valid_to IS NULL)""",
        "dq_not_null": "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM versions"
            for c in _NULL_COLUMNS
        )
        + ") WHERE nulls > 0",
        "dq_accepted_values": """
            SELECT method, count(*) AS row_count FROM versions
            WHERE method NOT IN ('1-URGENT', '2-HIGH') GROUP BY 1""",
        "dq_market_links": """
            SELECT uid, titulaire_id, count(*) AS current_count FROM validated
            GROUP BY 1, 2 HAVING count(*) <> 1""",
    }.items()
}

# The jobs version what the cascade finds.
ORACLE["history_of_key"] = ORACLE["history"]
for _published, _same in (
    ("search_indexed", "search"),
    ("history_published", "history"),
    ("announcements_published", "announcements_of"),
    ("markets_published", "markets_of"),
):
    ORACLE[_published] = ORACLE[_same]
ORACLE["markets_rerun"] = ORACLE["markets_daily"]
ORACLE["scd2_days_in_any_order"] = ORACLE["scd2_replay"]
ORACLE["announcements_daily"] = ORACLE["announcements_stream"] = ORACLE["cascade_fixed_params"].replace(
    "SELECT bodacc_announcement_id, siren_bodacc, siret_siege, match_method,\n              match_confidence FROM exact_links",
    "SELECT *, DATE '2024-01-01' AS valid_from, CAST(NULL AS DATE) AS valid_to, true AS is_current FROM (\n"
    "            SELECT bodacc_announcement_id, siren_bodacc, siret_siege, match_method,\n              match_confidence FROM exact_links",
) + ")"


# Training: random pairs by hashed tickets, the prior from the rule's pairs, EM as a recursion.
_TICKET = "CAST('0x' || substr(md5('{salt}:' || uid), 1, 10) AS BIGINT)"
_BASE = LinkageModel()


def _drawn(side: str, take: str, of: str, salt: int) -> str:
    return f"""
    SELECT denomination_clean AS name, adresse_clean AS address, {_TICKET.format(salt=salt + 1)} % 64 AS part
    FROM {side}, takes WHERE {take} >= {of}
      OR {_TICKET.format(salt=salt)} < CAST(1099511627776 AS HUGEINT) * {take} // {of}"""


_TRAINING = f"""
sizes AS (SELECT (SELECT count(*) FROM open_side) AS nl, (SELECT count(*) FROM right_side) AS nr),
wanted AS (SELECT *, least(1000000, nl * nr) * 64 AS w FROM sizes),
first_take AS (SELECT *, least(nl, CAST(floor(sqrt(w)) AS BIGINT) + 1) AS tl FROM wanted),
right_take AS (SELECT *, least(nr, CAST(ceil(w / tl) AS BIGINT)) AS tr FROM first_take),
takes AS (SELECT nl, nr, tr, least(nl, CAST(ceil(w / tr) AS BIGINT)) AS tl,
    least(64, greatest(1, CAST(round_even(w / (least(nl, ceil(w / tr)) * tr), 0) AS BIGINT))) AS repeats
  FROM right_take),
drawn_left AS ({_drawn("open_side", "tl", "nl", 42)}),
drawn_right AS ({_drawn("right_side", "tr", "nr", 52)}),
shifted AS (
  SELECT name, address, (part + s) % 64 AS part
  FROM (SELECT name, address, part, unnest(range(repeats)) AS s FROM drawn_right, takes)),
random_levels AS (
  SELECT {name_level("l.name", "r.name")} AS name_level, {address_level("l.address", "r.address")} AS address_level,
    count(*) AS n
  FROM drawn_left l JOIN shifted r USING (part) GROUP BY 1, 2),
us AS (
  SELECT f AS field, k AS level, CASE WHEN coalesce(sum(n), 0) > 0
      THEN sum(n) / (SELECT sum(n) FROM random_levels) ELSE 1e-6 END AS u
  FROM (VALUES ('name'), ('address')) fields(f), range(4) levels(k) LEFT JOIN random_levels
    ON k = CASE f WHEN 'name' THEN name_level ELSE address_level END GROUP BY 1, 2),
in_block AS (
  SELECT {address_level("l.address", "r.address")} AS level, CAST(sum(l.n * r.n) AS DOUBLE) AS c
  FROM left_open l JOIN right_values r USING (block) GROUP BY 1),
rule AS (SELECT least((SELECT sum(c) FROM in_block) / 0.7 / (CAST(nl AS DOUBLE) * nr), 1 - 1e-9) AS prior FROM sizes),
given AS (
  SELECT list(coalesce(c, 0) ORDER BY us.level) AS c, list(u ORDER BY us.level) AS u, sum(coalesce(c, 0)) AS total
  FROM us LEFT JOIN in_block ON in_block.level = us.level WHERE field = 'address'),
em(turn, prior, m, done) AS (
  SELECT 0, prior, [{", ".join(f"CAST({m!r} AS DOUBLE)" for m in _BASE.m_address)}], false FROM rule
  UNION ALL
  SELECT turn + 1, new_prior, new_m, greatest(abs(new_prior - prior),
      list_max(list_transform(range(1, 5), lambda i: abs(new_m[i] - m[i])))) < 1e-4
  FROM (
    SELECT *, least(list_sum(w) / total, 1 - 1e-9) AS new_prior,
      list_transform(w, lambda x: CASE WHEN x > 0 THEN x / list_sum(w) ELSE 1e-6 END) AS new_m
    FROM (
      SELECT em.*, total, list_transform(range(1, 5), lambda i:
          c[i] * (prior / (1 - prior) * m[i] / u[i]) / (1 + prior / (1 - prior) * m[i] / u[i])) AS w
      FROM em, given WHERE NOT done AND turn < 25))),
trained AS (SELECT m FROM em ORDER BY turn DESC LIMIT 1)
SELECT field, CAST(us.level AS INT) AS level, round(CASE field WHEN 'address' THEN trained.m[us.level + 1]
    ELSE [{", ".join(f"CAST({m!r} AS DOUBLE)" for m in _BASE.m_name)}][us.level + 1] END, 6) AS m,
  round(u, 6) AS u, round(prior, 6) AS prior
FROM us, trained, rule"""
ORACLE["fuzzy_em_trained"] = (
    ORACLE["block_counts"].rsplit("SELECT block, l.n AS n_left", 1)[0].rstrip().replace("WITH ", "WITH RECURSIVE ", 1)
    + ", open_side AS (SELECT * FROM left_side WHERE siren_declared IS NULL), "
    + _TRAINING
)


def with_trained_model(where: str, left: str, body: str) -> str:
    """``body`` over ``best``, the best matches of ``left`` by the model trained on announcements that fit ``where``."""
    parts = sql(f"SELECT 1 FROM left_side, right_side, right_values, {left}, exact_links").rsplit("SELECT 1 FROM", 1)[0]
    training = _TRAINING.rsplit("SELECT field, CAST", 1)[0].rstrip().replace("left_open", left)
    m_name = ", ".join(f"CAST({m!r} AS DOUBLE)" for m in _BASE.m_name)
    return f"""{parts.rstrip().replace("WITH ", "WITH RECURSIVE ", 1)},
open_side AS (SELECT * FROM left_side WHERE {where}), {training},
params AS (
  SELECT field, us.level AS level, CASE field WHEN 'address' THEN trained.m[us.level + 1]
    ELSE [{m_name}][us.level + 1] END AS m, u FROM us, trained),
probabilities AS (
  SELECT n.level AS name_level, a.level AS address_level,
    prior / (1 - prior) * (n.m / n.u * (a.m / a.u)) AS odds
  FROM params n, params a, rule WHERE n.field = 'name' AND a.field = 'address'),
levels AS (
  SELECT l.name, l.address, r.uid, {name_level("l.name", "r.name")} AS name_level,
    {address_level("l.address", "r.address")} AS address_level
  FROM {left} l JOIN right_values r ON l.block = r.block),
best AS (
  SELECT name, address, uid, p AS match_probability FROM (
    SELECT name, address, uid, odds / (1 + odds) AS p, row_number() OVER (
      PARTITION BY name, address ORDER BY odds / (1 + odds) DESC, uid) AS place
    FROM levels JOIN probabilities USING (name_level, address_level)
    WHERE odds / (1 + odds) >= {_BASE.threshold!r}) WHERE place = 1)
{body}"""


ORACLE["unmatched_em_trained"] = (
    sql("SELECT 1 FROM left_side, right_side, right_values, left_unmatched, exact_links")
    .rsplit("SELECT 1 FROM", 1)[0]
    .rstrip()
    .replace("WITH ", "WITH RECURSIVE ", 1)
    + ", open_side AS (SELECT * FROM left_side WHERE uid NOT IN (SELECT bodacc_announcement_id FROM exact_links)), "
    + _TRAINING.replace("left_open", "left_unmatched")
)
ORACLE["cascade"] = with_trained_model(
    "siren_declared IS NULL",
    "left_open",
    """
SELECT bodacc_announcement_id, siren_bodacc, siret_siege, match_method, match_confidence FROM exact_links
UNION ALL
SELECT l.uid, NULL, b.uid, CASE WHEN b.uid IS NULL THEN 'unresolved' ELSE 'splink_fuzzy' END,
  round(b.match_probability, 6)
FROM left_side l LEFT JOIN best b ON l.denomination_clean = b.name AND l.adresse_clean = b.address
WHERE l.siren_declared IS NULL""",
)
ORACLE["precision_recall_trained"] = with_trained_model(
    "siren_declared IS NOT NULL",
    "left_matched",
    """, guessed AS (
  SELECT l.uid AS bodacc_announcement_id, b.uid AS siret_siege
  FROM left_side l JOIN best b ON l.denomination_clean = b.name AND l.adresse_clean = b.address
  WHERE l.siren_declared IS NOT NULL)
SELECT total, predicted, correct,
  round(CASE WHEN predicted > 0 THEN CAST(correct AS DOUBLE) / predicted ELSE 0 END, 9) AS "precision",
  round(CASE WHEN total > 0 THEN CAST(correct AS DOUBLE) / total ELSE 0 END, 9) AS recall
FROM (SELECT count(*) AS total, count(p.siret_siege) AS predicted, count(*) FILTER (p.siret_siege = e.siret_siege) AS correct
  FROM exact_links e LEFT JOIN guessed p USING (bodacc_announcement_id))""",
)
