import json

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions.text import folded, siren_in_text
from ledgerline.operators import normalize


def parsed(spark, schema, *records):
    df = spark.createDataFrame([(json.dumps(r),) for r in records], "json string")
    return normalize.parse_json(df, "json", schema)


@pytest.mark.parametrize(
    "text, siren",
    [
        ("334 393 806 RCS PARIS", "334393806"),
        ("334393806 RCS PARIS", "334393806"),
        ('["108798950","108 798 950"]', "108798950"),
        ("RCS PARIS", None),
        ("12 RCS PARIS 2024", None),
        ("12 RCS PARIS 334 393 806", None),
        ("[]", None),
        ("[334393806 RCS", "334393806"),
        ("é334393806", None),
        ("RCS n°334 393 806.", "334393806"),
        ("1234567890", None),
        ("", None),
        (None, None),
    ],
)
def test_siren_in_register_text(spark, text, siren):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(siren_in_text(F.col("t"))).first()[0] == siren


def test_announcement_identifier_and_text_fields(spark, rows):
    raw = parsed(
        spark,
        schemas.RAW_ANNOUNCEMENT,
        {"id": "A1", "siren": "314000007", "registre": "800000002 RCS NIORT", "numeroannonce": 7},
        {"id": "A2", "siren": "", "registre": ["108798950", "108 798 950"]},
        {"id": "A3", "registre": "334 393 806 RCS PARIS"},
        {"id": "A4"},
    )
    out = normalize.normalize_announcements(raw)
    assert out.columns == schemas.BRONZE_ANNOUNCEMENT_COLUMNS
    assert rows(out, "id", "siren_declared", "numeroannonce") == [
        ("A1", "314000007", "7"),
        ("A2", "108798950", None),
        ("A3", "334393806", None),
        ("A4", None, None),
    ]


def test_establishment_takes_first_period_and_survives_missing_parts(spark, rows):
    raw = parsed(
        spark,
        schemas.RAW_ESTABLISHMENT,
        {
            "siren": "314000007",
            "siret": "31400000700025",
            "etablissementSiege": True,
            "adresseEtablissement": {"codePostalEtablissement": "08000"},
            "periodesEtablissement": [
                {"etatAdministratifEtablissement": "F"},
                {"etatAdministratifEtablissement": "A"},
            ],
        },
        {"siret": "2", "etablissementSiege": False, "periodesEtablissement": []},
        {"siret": "3"},
    )
    out = normalize.flatten_establishments(raw)
    assert out.columns == schemas.BRONZE_ESTABLISHMENT_COLUMNS
    assert rows(
        out,
        "siret",
        "etablissementSiege",
        "codePostalEtablissement",
        "etatAdministratifEtablissement",
    ) == [
        ("2", "false", None, None),
        ("3", "false", None, None),
        ("31400000700025", "true", "08000", "F"),
    ]


@pytest.mark.parametrize(
    "unit, name",
    [
        ({"denominationUniteLegale": "SCIERIE DU LAC", "nomUniteLegale": "X"}, "SCIERIE DU LAC"),
        ({"nomUniteLegale": "KERGOAT", "prenomUsuelUniteLegale": "Enora"}, "KERGOAT Enora"),
        ({"denominationUniteLegale": "", "nomUniteLegale": "KERGOAT"}, "KERGOAT"),
        ({"prenomUsuelUniteLegale": "Enora"}, None),
        ({}, None),
    ],
)
def test_candidate_name(spark, unit, name):
    raw = parsed(spark, schemas.RAW_ESTABLISHMENT, {"siret": "1", "uniteLegale": unit})
    out = normalize.normalize_candidates(raw)
    assert out.columns == schemas.BRONZE_CANDIDATE_COLUMNS
    assert out.first()["denomination"] == name


def test_folded_text(spark):
    df = spark.createDataFrame([("  SCIERIE du Lac  ", "74000", None)], "a string, b string, c string")
    one = df.select(
        folded(F.col("a")), folded(F.col("b"), F.lit("Saint-Jorioz")), folded(F.col("c"), F.col("c"))
    ).first()
    assert tuple(one) == ("scierie du lac", "74000 saint-jorioz", "")
