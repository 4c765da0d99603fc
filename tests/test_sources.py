import datetime as dt

import pytest
from pyspark.sql.types import IntegerType

from ledgerline import schemas
from ledgerline.operators import scd2
from ledgerline.operators.model import LinkageModel
from ledgerline.operators.scope import department_of
from ledgerline.plans import daily
from ledgerline.schemas import struct_of
from ledgerline.session import build_session, catalog_options, object_store_options, shared_folder
from ledgerline.sources import files, jdbc, tables
from ledgerline.streaming import incremental

HEADER = ",".join(schemas.BRONZE_ESTABLISHMENT_COLUMNS)
LINES = [
    "019000013,00042,01900001300042,O,2001-07-30,true,115,QUAI,DU MOULIN NEUF,01300,BELLEY,16.23Z,A,2024-02-09",
    "024000021,00031,02400002100031,P,2010-11-05,false,,PL,DU BEFFROI,02100,GAUCHY,56.10A,F,2024-06-17",
]


def test_csv_bootstrap_keeps_text_and_empty_fields(spark, tmp_path, day):
    path = tmp_path / "stock.csv"
    path.write_text("\n".join([HEADER, *LINES]) + "\n")
    landed = daily.bootstrap_establishments(spark, str(path), str(tmp_path / "lake"), day(1))
    assert (tmp_path / "lake/bronze/establishments/stock/ingestion_date=2026-10-01").is_dir()
    out = {r.siret: r for r in files.read_bronze(spark, landed, schemas.BRONZE_ESTABLISHMENT).collect()}
    assert out["02400002100031"].numeroVoieEtablissement == ""
    assert out["02400002100031"].codePostalEtablissement == "02100"
    assert out["01900001300042"].ingestion_date == day(1)


def test_csv_with_another_header_is_refused(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("a,b\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv_strings(spark, str(path), ["b", "a"]).collect()


def test_bronze_partitions(spark, tmp_path, day, rows):
    layout = struct_of("id string")

    def land(value, n, **options):
        df = spark.createDataFrame([(value,)], "id int")
        return files.write_bronze(df, str(tmp_path), "src", day(n), columns=["id"], **options)

    path = land(1, 1, department="08")
    land(2, 2, department="08")
    land(3, 2, department="08")  # a rerun replaces its own day
    land(4, 2, department="17")
    assert path.endswith("bronze/src")
    read = files.read_bronze(spark, path, layout, by_department=True)
    assert rows(read) == [
        ("1", "08", day(1)), ("3", "08", day(2)), ("4", "17", day(2)),
    ]
    recent = files.read_bronze(spark, path, layout, by_department=True, since=day(2), until=day(3))
    assert rows(recent, "id") == [("3",), ("4",)]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "ingestion_date" in plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert files.bronze_root("/lake/", "a", "diff") == "/lake/bronze/a/diff"


def test_malformed_rows_are_quarantined(spark, tmp_path, day, rows):
    layout = struct_of("siret string, d string")
    bronze = spark.createDataFrame([("1", "2024-01-01"), (None, None), ("2", "x")], layout)
    good = daily.quarantine(bronze, str(tmp_path), "src", "siret", ["d"], day(1))
    assert rows(good) == [("1", "2024-01-01")]
    kept = struct_of("siret string, d string, reject_reason string")
    rejects = files.read_bronze(spark, files.bronze_root(str(tmp_path), "src", "rejects"), kept)
    assert rows(rejects, "reject_reason") == [("missing siret",), ("unreadable d",)]


def test_json_records_read_with_a_declared_schema(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "A1", "registre": ["1", "2"], "numeroannonce": 7}\n')
    row = files.read_json_raw(spark, str(tmp_path / "a.json"), schemas.RAW_ANNOUNCEMENT).first()
    assert (row.id, row.registre, row.numeroannonce) == ("A1", '["1", "2"]', "7")


def test_tables(spark, table_name, rows):
    layout = struct_of("id string, v double")
    tables.ensure_table(spark, table_name, layout)
    tables.ensure_table(spark, table_name, layout)
    assert tables.read_table(spark, table_name).schema == layout
    tables.append_rows(spark.createDataFrame([(1.0, "a")], "v double, id string"), table_name)
    more = spark.createDataFrame([("a", 9.0), ("b", 2.0), ("b", 2.0)], layout)
    for _ in range(2):
        tables.insert_if_absent_into(table_name, more, ["id"])
    assert rows(spark.table(table_name)) == [("a", 1.0), ("b", 2.0)]
    tables.replace_table(spark.createDataFrame([("z", 0.0)], layout), table_name)
    assert rows(spark.table(table_name)) == [("z", 0.0)]


LAYOUT = struct_of("k string, v double, valid_from date, valid_to date, is_current boolean")


def test_gold_table_rewrites_only_the_partitions_of_the_run(spark, table_name, day, rows):
    tables.ensure_gold(spark, table_name, LAYOUT)
    expected = spark.createDataFrame([], LAYOUT)
    runs = [
        (day(1), [("a", 1.0), ("b", 1.0)]),
        (day(2), [("a", 2.0), ("c", 1.0)]),
        (day(3), [("a", 3.0), ("b", 3.0)]),
        (day(3), [("c", 3.0)]),  # a second run on the day adds to its partition
        (day(3), [("c", 3.0)]),
    ]
    old = None
    for run, data in runs:
        incoming = spark.createDataFrame(data, "k string, v double")
        expected = scd2.scd2_apply(expected, incoming, ["k"], ["v"], run)
        expected = spark.createDataFrame(expected.collect(), LAYOUT)
        tables.historize(table_name, LAYOUT, incoming, ["k"], ["v"], run)
        gold = tables.read_table(spark, table_name, LAYOUT)
        assert rows(gold) == rows(expected)
        files_of_day_2 = sorted(
            f for f in spark.table(table_name).inputFiles() if "valid_to=2026-10-02" in f
        )
        old = old or files_of_day_2
        assert files_of_day_2 == old


def test_several_days_into_a_gold_table(spark, table_name, day, rows):
    tables.ensure_gold(spark, table_name, LAYOUT)
    batches = [
        [("a", 1.0, day(1)), ("b", 1.0, day(1)), ("a", 2.0, day(2))],
        [("a", 3.0, day(3)), ("b", 2.0, day(2)), ("b", 2.0, day(3))],
    ]
    for batch in batches:
        incoming = spark.createDataFrame(batch, "k string, v double, d date")
        for _ in range(2):
            tables.historize_days(table_name, LAYOUT, incoming, ["k"], ["v"], "d")
    gold = tables.read_table(spark, table_name, LAYOUT)
    assert rows(gold, "k", "v", "valid_from", "valid_to") == sorted(
        [
            ("a", 1.0, day(1), day(2)),
            ("a", 2.0, day(2), day(3)),
            ("a", 3.0, day(3), None),
            ("b", 1.0, day(1), day(2)),
            ("b", 2.0, day(2), None),
        ],
        key=repr,
    )


def bronze_establishment(spark, siret, street):
    base = dict.fromkeys(schemas.BRONZE_ESTABLISHMENT_COLUMNS, "")
    row = base | {"siren": siret[:9], "siret": siret, "numeroVoieEtablissement": street}
    return spark.createDataFrame([tuple(row.values())], schemas.BRONZE_ESTABLISHMENT)


def test_establishments_daily(spark, table_name, day, rows):
    for n, street in ((1, "8"), (2, "10"), (3, "10")):
        bronze = bronze_establishment(spark, "31400000700025", street)
        daily.establishments_daily(bronze, f"{table_name}_s", table_name, day(n))
    gold = tables.read_table(spark, table_name, schemas.GOLD_ESTABLISHMENT)
    assert rows(gold, "numero_voie", "valid_from", "valid_to", "is_current") == [
        ("10", day(2), None, True), ("8", day(1), day(2), False),
    ]


def test_establishments_stream_picks_up_each_file_once(spark, tmp_path, table_name, day, rows):
    root, checkpoint = str(tmp_path / "lake"), str(tmp_path / "checkpoint")

    def land(n, street):
        return files.write_bronze(
            bronze_establishment(spark, "31400000700025", street), root, "establishments", day(n)
        )

    land(1, "8")
    path = land(2, "10")  # two days in one batch
    incremental.establishments_stream(spark, path, checkpoint, table_name)
    land(3, "12")
    for _ in range(2):
        incremental.establishments_stream(spark, path, checkpoint, table_name)
    gold = tables.read_table(spark, table_name, schemas.GOLD_ESTABLISHMENT)
    assert rows(gold, "numero_voie", "valid_from", "valid_to") == [
        ("10", day(2), day(3)), ("12", day(3), None), ("8", day(1), day(2)),
    ]


CANDIDATES = (
    "siren string, siret string, denomination string, code_postal string, libelle_commune string"
)


def bronze_announcements(spark, *records):
    base = dict.fromkeys(schemas.BRONZE_ANNOUNCEMENT_COLUMNS)
    return spark.createDataFrame(
        [tuple((base | r).values()) for r in records], schemas.BRONZE_ANNOUNCEMENT
    )


def test_announcements_stream_links_the_backlog(spark, tmp_path, table_name, day, rows):
    root, checkpoint = str(tmp_path / "lake"), str(tmp_path / "checkpoint")
    silver, links = f"{table_name}_s", table_name
    candidates = spark.createDataFrame(
        [("1", "100", "ALPHA BOIS", "08000", "SEDAN"), ("2", "200", "BETA", "08000", "SEDAN")], CANDIDATES
    )
    batches = [
        (day(1), [{"id": "A1", "siren_declared": "1"}, {"id": "A2", "commercant": "alpha bois",
                                                       "cp": "08000", "ville": "Sedan"}]),
        (day(2), [{"id": "A1", "siren_declared": "2"}, {"id": "A3"}]),
    ]
    for run, records in batches:
        path = files.write_bronze(
            bronze_announcements(spark, *records), root, "announcements", run, run_type="diff"
        )
        incremental.announcements_stream(
            spark, path, checkpoint, silver, links, candidates, LinkageModel(prior=0.01)
        )
    gold = tables.read_table(spark, links, schemas.GOLD_ANNOUNCEMENT_LINK)
    assert rows(gold, "bodacc_announcement_id", "siret_siege", "match_method", "valid_from") == [
        ("A1", "100", "exact_siren", day(1)),
        ("A2", "100", "splink_fuzzy", day(1)),
        ("A3", None, "unresolved", day(2)),
    ]


def test_announcements_are_put_in_order_once_and_only_what_they_match_by_waits(spark, table_name, day, rows, monkeypatch):
    bronze = bronze_announcements(spark, {"id": "A1"}, {"id": "A1", "commercant": "B"}, {"id": ""}, {"id": "A2"})
    candidates = spark.createDataFrame([("1", "100", "ALPHA BOIS", "08000", "SEDAN")], CANDIDATES)
    append, settle, plans, waiting = tables.append_rows, daily.settle, [], []

    def appended(df, table):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        append(df, table)

    monkeypatch.setattr(tables, "append_rows", appended)
    monkeypatch.setattr(daily, "settle", lambda df: waiting.append(df.columns) or settle(df))
    for n in (1, 2):
        daily.announcements_daily(
            bronze, candidates, f"{table_name}_s", table_name, day(n), LinkageModel(prior=0.01)
        )
    assert rows(spark.table(f"{table_name}_s"), "id", "commercant") == [("A1", None), ("A2", None)]
    assert all(p.count("row_number") and p.count("Exchange hashpartitioning") == 2 for p in plans)
    assert len(plans) == 2 and waiting[0] == ["id", "siren_declared", "commercant", "code_postal", "ville"]


def test_markets_daily_twice_adds_nothing(spark, table_name, day, rows):
    base = dict.fromkeys(schemas.BRONZE_MARKET.fieldNames()) | {
        "acheteur_departement_code": "08",
        "datePublicationDonnees": dt.date(2026, 5, 1),
        "donneesActuelles": True,
    }
    data = [
        base | {"uid": "M1", "titulaire_id": "S1", "titulaire_typeIdentifiant": "Siret", "montant": 1.0},
        base | {"uid": "M1", "titulaire_id": "X", "titulaire_typeIdentifiant": "TVA", "montant": 1.0},
        base | {"uid": "M2"},
        base | {"uid": "M3", "acheteur_departement_code": "51"},
    ]
    national = spark.createDataFrame([tuple(r.values()) for r in data], schemas.BRONZE_MARKET)
    registry = spark.createDataFrame([("S1", True)], "siret string, is_current boolean")
    for n in (1, 2):
        daily.markets_daily(national, registry, f"{table_name}_s", table_name, day(n))
    gold = tables.read_table(spark, table_name, schemas.GOLD_MARKET_LINK)
    assert rows(gold, "uid", "titulaire_id", "match_method", "siret_validated_in_sirene", "valid_from") == [
        ("M1", "S1", "source_siret", True, day(1)),
        ("M1", "X", "unresolved", None, day(1)),
        ("M2", None, "unresolved", None, day(1)),
    ]


class Writer:
    """Stands in for a frame's JDBC writer, since no database may be started."""

    def __init__(self, df, log):
        self.df, self.log = df, log

    def option(self, name, value):
        self.log[name] = value
        return self

    def jdbc(self, **call):
        self.log.update(call)
        self.df.write.format("noop").mode("overwrite").save()


def test_served_rows_are_checked_counted_and_truncated(spark, day, monkeypatch):
    log = {}
    data = [("a", 1.0, day(1), day(2), False), ("a", 2.0, day(2), None, True)]
    gold = spark.createDataFrame(data, LAYOUT)
    original = type(gold).observe

    def observe(self, *args):
        observed = original(self, *args)
        return type("Observed", (), {"write": Writer(observed, log)})()

    monkeypatch.setattr(type(gold), "observe", observe)
    props = jdbc.jdbc_properties({"POSTGRES_USER": "u", "POSTGRES_PASSWORD": "p"})
    url = jdbc.jdbc_url({"POSTGRES_HOST": "db", "POSTGRES_SERVING_DB": "shown"})
    assert jdbc.replace_served(gold, url, "t", props, ["k"]) == 2
    assert log["truncate"] == "true" and log["mode"] == "overwrite" and log["table"] == "t"
    assert log["url"] == "jdbc:postgresql://db:5432/shown"
    assert log["createTableColumnTypes"] == "k TEXT, v DOUBLE PRECISION"
    assert log["properties"]["driver"] == "org.postgresql.Driver"
    with pytest.raises(ValueError, match="valid_to"):
        jdbc.replace_served(gold, url, "t", props, ["k"], required=["k", "valid_to"])
    with pytest.raises(ValueError, match="valid_from"):
        jdbc.replace_served(gold.unionByName(gold), url, "t", props, ["k"])


def test_session_options(spark):
    assert object_store_options({}) == {}
    env = {"S3_ENDPOINT_URL": "http://x", "S3_ACCESS_KEY": "a", "S3_SECRET_KEY": "b"}
    options = object_store_options(env)
    assert options["spark.hadoop.fs.s3a.endpoint"] == "http://x"
    assert options["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert catalog_options("c", "s3a://w")["spark.sql.catalog.c.warehouse"] == "s3a://w"
    assert build_session(env={}) is not None
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_broken_csv_lines_are_rejects(spark, tmp_path, rows):
    lines = ["a,b,c", "1,2,3", "6,7,8,9", "4,5", '"x ""q"" y",,"u,v"', ",,", '"open,1,2']
    (tmp_path / "f.csv").write_text("\n".join(lines) + "\n")
    good, bad = files.split_csv(spark, str(tmp_path), ["a", "b", "c"])
    assert rows(good) == [("", "", ""), ("1", "2", "3"), ('x "q" y', "", "u,v")]
    assert rows(good, "a") == [("",), ("1",), ('x "q" y',)]
    assert rows(bad, "row") == [('"open,1,2',), ("4,5",), ("6,7,8,9",)]
    assert rows(bad, "reject_reason") == [("not as many fields as columns",)] * 3
    with pytest.raises(Exception, match="conform"):
        files.split_csv(spark, str(tmp_path), ["a", "b", "d"])


def test_broken_json_lines_are_rejects(spark, tmp_path, rows):
    lines = ['{"a":1,"b":"x"}', '{"a":2,"b":', "[7]", '{"a":"z","b":"y"}', '{"b":"w","more":1}']
    (tmp_path / "f.json").write_text("\n".join(lines) + "\n")
    layout = schemas.StructType([schemas.StructField("a", IntegerType()), schemas.StructField("b", schemas.StringType())])
    good, bad = files.split_json(spark, str(tmp_path), layout)
    assert rows(good) == [(1, "x"), (None, "w")]
    assert rows(bad, "row") == sorted((line,) for line in lines[1:4])


def test_the_stock_keeps_its_broken_lines(spark, tmp_path, day, rows):
    (tmp_path / "stock.csv").write_text("siren,nic\n1,2\n3\n4,5,6\n")
    path = daily.bootstrap_establishments(spark, str(tmp_path / "stock.csv"), str(tmp_path), day(1))
    assert rows(spark.read.parquet(path), "siren", "nic") == [("1", "2")]
    kept = spark.read.parquet(f"{tmp_path}/bronze/establishments/rejects/lines")
    assert rows(kept, "row") == [('{"row":"3"}',), ('{"row":"4,5,6"}',)]


def test_all_departments_in_one_pass(spark, tmp_path, day, rows):
    def landed(*postal):
        data = [(str(i), str(i), code) for i, code in enumerate(postal)]
        df = spark.createDataFrame(data, "siren string, siret string, code_postal string")
        return files.write_by_department(df, str(tmp_path), "c", day(1), department_of(df["code_postal"]), ["siren", "code_postal"])

    landed("08000", "75001", "97411", None, "")
    path = landed("08000", "08100", "2A000")
    found = files.read_bronze(spark, path, schemas.strings(["siren", "code_postal"]), by_department=True)
    assert rows(found, "department", "code_postal") == [("08", "08000"), ("08", "08100"), ("2A", "2A000")]
