import datetime as dt

from ledgerline import schemas
from ledgerline.operators import clean, keys, scope


def establishments(spark, *changes):
    base = dict.fromkeys(schemas.BRONZE_ESTABLISHMENT_COLUMNS)
    rows = [tuple((base | change).values()) for change in changes]
    return spark.createDataFrame(rows, schemas.BRONZE_ESTABLISHMENT)


def market(**change):
    return {**dict.fromkeys(schemas.BRONZE_MARKET.fieldNames()), "uid": "M1", **change}


def markets(spark, *records):
    return spark.createDataFrame([tuple(r.values()) for r in records], schemas.BRONZE_MARKET)


def test_establishments_are_typed_and_keep_leading_zeros(spark):
    bronze = establishments(
        spark,
        {
            "siret": "00203253400019",
            "nic": "00019",
            "dateCreationEtablissement": "1966-01-01",
            "dateDernierTraitementEtablissement": "pas une date",
            "etablissementSiege": "true",
        },
    )
    out = clean.clean_establishments(bronze)
    assert out.schema == schemas.SILVER_ESTABLISHMENT
    row = out.first()
    assert (row.siret, row.nic) == ("00203253400019", "00019")
    assert row.date_creation == dt.date(1966, 1, 1)
    assert row.date_dernier_traitement is None
    assert row.etablissement_siege is True


def test_head_office_flag_is_case_sensitive_and_keeps_null(spark, rows):
    bronze = establishments(
        spark,
        {"siret": "1", "etablissementSiege": "false"},
        {"siret": "2", "etablissementSiege": "True"},
        {"siret": "3", "etablissementSiege": None},
    )
    out = clean.clean_establishments(bronze)
    assert rows(out, "siret", "etablissement_siege") == [("1", False), ("2", False), ("3", None)]


def test_keyless_rows_go_and_doubles_keep_the_latest(spark, rows):
    bronze = establishments(
        spark,
        {"siret": None},
        {"siret": ""},
        {"siret": "1", "nic": "a", "dateDernierTraitementEtablissement": "2024-01-01"},
        {"siret": "1", "nic": "b", "dateDernierTraitementEtablissement": "2024-02-01"},
        {"siret": "1", "nic": "c"},
    )
    assert rows(clean.clean_establishments(bronze), "siret", "nic") == [("1", "b")]
    # Whatever the order and the partitions of the input.
    again = clean.clean_establishments(bronze.orderBy("nic").repartition(3))
    assert rows(again, "siret", "nic") == [("1", "b")]


def test_announcements(spark, rows):
    base = dict.fromkeys(schemas.BRONZE_ANNOUNCEMENT_COLUMNS)
    data = [
        base | {"id": "A1", "dateparution": "2026-10-01", "cp": "08000"},
        base | {"id": "A1", "dateparution": "2026-10-01", "cp": "08000"},
        base | {"id": "A2", "dateparution": "2026-13-01"},
        base | {"id": ""},
    ]
    bronze = spark.createDataFrame([tuple(r.values()) for r in data], schemas.BRONZE_ANNOUNCEMENT)
    out = clean.clean_announcements(bronze)
    assert out.schema == schemas.SILVER_ANNOUNCEMENT
    assert rows(out, "id", "date_parution", "code_postal") == [
        ("A1", dt.date(2026, 10, 1), "08000"),
        ("A2", None, None),
    ]


def test_markets_keep_joint_awards_and_upper_case_the_type(spark, rows):
    bronze = markets(
        spark,
        market(titulaire_id="1", titulaire_typeIdentifiant="Siret", montant=1.5),
        market(titulaire_id="2", titulaire_typeIdentifiant="TVA"),
        market(uid=None),
        market(uid=""),
    )
    out = clean.clean_markets(bronze)
    assert out.schema == schemas.SILVER_MARKET
    assert rows(out, "uid", "titulaire_id", "titulaire_type_identifiant", "montant") == [
        ("M1", "1", "SIRET", 1.5),
        ("M1", "2", "TVA", None),
    ]


def test_rejects_are_split_off_with_a_reason(spark, rows):
    bronze = establishments(
        spark,
        {"siret": "1", "dateCreationEtablissement": "2024-01-01"},
        {"siret": "2", "dateCreationEtablissement": "hier"},
        {"siret": ""},
        {"siret": "3"},
    )
    good, bad = clean.split_rejects(bronze, "siret", ["dateCreationEtablissement"])
    assert rows(good, "siret") == [("1",), ("3",)]
    assert rows(bad, "siret", "reject_reason") == [
        ("", "missing siret"),
        ("2", "unreadable dateCreationEtablissement"),
    ]


def test_market_scope(spark, rows):
    def one(uid, department, published, current):
        return market(
            uid=uid,
            acheteur_departement_code=department,
            datePublicationDonnees=published,
            donneesActuelles=current,
        )

    recent, old = dt.date(2026, 5, 1), dt.date(2024, 1, 1)
    national = markets(
        spark,
        one("M1", "08", recent, True),
        one("M2", "51", recent, True),
        one("M3", "08", old, True),
        one("M4", "08", recent, False),
        one("M5", "08", None, True),
        one("M6", "08", recent, None),
        one("M7", "08", dt.date(2025, 10, 9), True),
    )
    out = scope.scope_markets(national, "08", dt.date(2025, 10, 9))
    assert rows(out, "uid") == [("M1",), ("M7",)]


def test_market_scope_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "m")
    markets(spark, market(acheteur_departement_code="08")).write.parquet(path)
    df = scope.scope_markets(spark.read.parquet(path), "08", dt.date(2025, 1, 1)).select("uid")
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "EqualTo(acheteur_departement_code,08)" in pushed
    assert "GreaterThanOrEqual(datePublicationDonnees" in pushed
    assert "objet" not in plan  # pruned


def test_announcement_window_is_half_open_and_update_window_closed(spark, rows):
    raw = spark.createDataFrame(
        [("a", "2026-10-01", "08"), ("b", "2026-10-02", "08"), ("c", "2026-10-03", "08"),
         ("d", "2026-10-02", "51"), ("e", None, "08")],
        "id string, dateparution string, numerodepartement string",
    )
    since, until = dt.date(2026, 10, 1), dt.date(2026, 10, 3)
    assert rows(scope.window_announcements(raw, since, until), "id") == [("a",), ("b",), ("d",)]
    assert rows(scope.window_announcements(raw, since, until, "08"), "id") == [("a",), ("b",)]
    updated = spark.createDataFrame(
        [("a", "2026-09-30"), ("b", "2026-10-01"), ("c", "2026-10-03T23:59:59"), ("d", "2026-10-04")],
        "siret string, dateDernierTraitementEtablissement string",
    )
    assert rows(scope.updated_between(updated, since, until), "siret") == [("b",), ("c",)]


def test_duplicates_put_only_repeated_keys_in_order(spark, monkeypatch):
    data = [(None, "x"), (None, "y"), ("a", "x"), ("a", "x"), ("a", None), ("b", "x"), ("", "z")]
    df = spark.createDataFrame(data, "k string, v string")

    def left_out():
        return sorted(map(tuple, keys.duplicates(df, ["k"]).collect()), key=repr)

    expected = [("a", "x"), ("a", "x"), (None, "y")]
    assert left_out() == expected
    assert "BroadcastHashJoin" in keys.duplicates(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(keys, "FEW_REPEATED", 1)
    assert left_out() == expected
    once = keys.duplicates(df.filter("v = 'z'"), ["k"])
    assert "Window" not in once._jdf.queryExecution().executedPlan().toString() and once.isEmpty()
