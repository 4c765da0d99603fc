"""Versioned gold tables: staging, audits, publishing, reruns, days in any order."""

import itertools
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators import quality
from ledgerline.operators.scd2 import scd2_apply
from ledgerline.plans import daily
from ledgerline.sources import files, tables, versions
from ledgerline.streaming import incremental

LAYOUT = schemas.struct_of(f"k string, v double, {schemas.VALIDITY}")


def incoming(spark, values):
    return spark.createDataFrame(list(values.items()), "k string, v double")


@pytest.fixture
def table(spark, table_name):
    versions.create(spark, table_name, LAYOUT, ["k"], buckets=4)
    yield table_name
    versions.drop(spark, table_name)


def run(spark, table, values, run_date, **options):
    versions.historize(table, LAYOUT, incoming(spark, values), ["v"], run_date, **options)


def slow(runs):
    """Versions after runs (day, values), the last run of a day counting."""
    by_day, open_since, out = dict(runs), {}, []
    for day, values in sorted(by_day.items()):
        for k, v in values.items():
            if k in open_since and open_since[k][1] != v:
                out.append((k, open_since[k][1], open_since[k][0], day))
            if k not in open_since or open_since[k][1] != v:
                open_since[k] = (day, v)
    return sorted(out + [(k, v, since, None) for k, (since, v) in open_since.items()], key=repr)


def shown(spark, table, rows):
    return rows(tables.read_table(spark, table, LAYOUT), "k", "v", "valid_from", "valid_to")


def folders(spark, table):
    at = versions.state(spark, table)
    return {part: run for part, run in versions._manifest(spark, at).items()}


def test_runs_equal_slow(spark, table, day, rows):
    rng = random.Random(4)
    runs = [(day(n), {f"k{rng.randrange(30)}": float(rng.randrange(3)) for _ in range(20)}) for n in (1, 2, 3, 3, 5)]
    done = []
    for when, values in runs:
        run(spark, table, values, when)
        done.append((when, values))
        assert shown(spark, table, rows) == slow(done)
    quality.assert_sound(spark.table(table), ["k"], ["k", "valid_from"])


def test_a_run_with_one_key_rewrites_one_bucket(spark, table, day):
    run(spark, table, {f"k{i}": 1.0 for i in range(50)}, day(1))
    before = folders(spark, table)
    assert {bucket for _, bucket in before} == {0, 1, 2, 3}
    run(spark, table, {"k7": 2.0}, day(2))
    after = folders(spark, table)
    changed = {part for part in after if after[part] != before.get(part)}
    assert len(changed) == 2 and (str(day(2)), versions.CLOSED) in changed
    at = versions.state(spark, table)
    written = list(Path(at.root.removeprefix("file:")).glob(f"run={after[(str(day(2)), versions.CLOSED)]}/*/*/*.parquet"))
    assert len(written) == 2


def test_a_rerun_replaces_its_day(spark, table, day, rows):
    first = {"a": 1.0, "b": 1.0, "c": 1.0}
    run(spark, table, first, day(1))
    run(spark, table, {"a": 9.0, "b": 9.0, "wrong": 9.0}, day(2))
    right = {"a": 2.0, "b": 1.0, "d": 1.0}
    for _ in range(2):
        run(spark, table, right, day(2))
        assert shown(spark, table, rows) == slow([(day(1), first), (day(2), right)])
    with pytest.raises(ValueError, match="runs after"):
        run(spark, table, first, day(1))


@pytest.mark.parametrize("same_day", ["replace", "strict"])
def test_other_rules_of_the_same_day(spark, table, day, rows, same_day):
    gold = spark.createDataFrame([], LAYOUT)
    for values in ({"a": 1.0, "b": 1.0}, {"a": 2.0}, {"c": 1.0}):
        rule = {"same_day": same_day}
        if same_day == "strict" and values == {"a": 2.0}:
            with pytest.raises(ValueError, match="unique start day"):
                run(spark, table, values, day(1), **rule)
            continue
        run(spark, table, values, day(1), **rule)
        gold = scd2_apply(gold, incoming(spark, values), ["k"], ["v"], day(1), **rule)
    assert shown(spark, table, rows) == rows(gold, "k", "v", "valid_from", "valid_to")


def test_a_failed_audit_leaves_the_table_as_it_was(spark, table, day, rows):
    run(spark, table, {"a": 1.0}, day(1))
    before, manifest = shown(spark, table, rows), folders(spark, table)
    with pytest.raises(ValueError, match="required columns"):
        versions.historize(table, LAYOUT, incoming(spark, {"b": None}), ["v"], day(2), required=["v"])
    twice = spark.createDataFrame([("z", 1.0, day(1), None, True), ("z", 2.0, day(1), None, True), ("y", 1.0, day(1), day(2), True)], LAYOUT)
    parts = {(None, b) for b in range(4)} | {(str(day(2)), versions.CLOSED)}
    with pytest.raises(ValueError, match=r"one current.*unique start.*agrees"):
        versions.replace_parts(spark, table, LAYOUT, twice, parts)
    with pytest.raises(ValueError, match="not replaced"):
        versions.replace_parts(spark, table, LAYOUT, twice.limit(1), [(str(day(3)), versions.CLOSED)])
    assert (shown(spark, table, rows), folders(spark, table)) == (before, manifest)
    root = Path(versions.state(spark, table).root.removeprefix("file:"))
    assert {p.name for p in root.glob("run=*")} == {f"run={r}" for r in manifest.values()}


def test_the_fused_audit_counts_what_the_assertions_find(spark, day):
    data = [("a", 1.0, day(1), None, True), ("a", 2.0, day(1), None, True), ("b", None, day(1), day(2), True), (None, 1.0, day(3), None, False), ("c", 1.0, day(1), None, None)]
    gold = spark.createDataFrame(data, LAYOUT)
    assert quality.violations(gold, ["k"], ["k", "v"]) == {
        "one current version per key": quality.one_current(gold, ["k"]).count(),
        "unique start day per key": quality.unique_version(gold, ["k"]).count(),
        "is_current agrees with valid_to": quality.flag_matches_valid_to(gold, ["k"]).count(),
        "required columns": 2,
    }
    assert quality.violations(gold.limit(0), ["k"], ["k"]) == {}


def test_old_folders_go_and_readers_keep_two_versions(spark, table, day, rows):
    run(spark, table, {"a": 1.0}, day(1))
    reader = tables.read_table(spark, table, LAYOUT)
    run(spark, table, {"a": 2.0}, day(2))
    assert rows(reader, "k", "v") == [("a", 1.0)]
    for n in range(3, 7):
        run(spark, table, {"a": float(n)}, day(n))
    at = versions.state(spark, table)
    root = Path(at.root.removeprefix("file:"))
    assert len(list(root.glob("run=*/*/*/*.parquet"))) == len(folders(spark, table)) + versions.KEPT - 1
    assert not spark.catalog.tableExists(f"{table}__v{at.number - versions.KEPT}")


def test_lookups_read_one_bucket(spark, table, day, rows):
    run(spark, table, {f"k{i}": 1.0 for i in range(200)}, day(1))
    run(spark, table, {f"k{i}": 2.0 for i in range(100)}, day(2))
    found = versions.of_key(spark, table, LAYOUT, k="k5")
    assert rows(found, "v", "valid_to") == [(1.0, day(2)), (2.0, None)]
    assert rows(versions.of_key(spark, table, LAYOUT, k="none")) == []
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan
    at = versions.state(spark, table)
    read = {r[0] for r in found.select("k").withColumn("f", F.input_file_name()).select("f").distinct().collect()}
    assert len(read) == 2
    assert at.buckets == 4


def test_rows_without_a_key_are_versioned_too(spark, table, day, rows):
    for n, v in ((1, 1.0), (2, 2.0)):
        versions.historize(table, LAYOUT, spark.createDataFrame([(None, v), ("", 5.0)], "k string, v double"), ["v"], day(n))
    assert shown(spark, table, rows) == [("", 5.0, day(1), None), (None, 1.0, day(1), day(2)), (None, 2.0, day(2), None)]
    versions.historize(table, LAYOUT, incoming(spark, {"x": 1.0}).limit(0), ["v"], day(3))
    assert len(shown(spark, table, rows)) == 3


def bronze_rows(spark, values):
    base = dict.fromkeys(schemas.BRONZE_ESTABLISHMENT_COLUMNS, "")
    records = [base | {"siren": k[:9], "siret": k, "activitePrincipaleEtablissement": v} for k, v in values.items()]
    return spark.createDataFrame([tuple(r.values()) for r in records], schemas.BRONZE_ESTABLISHMENT)


DAYS = [{"a": "1", "b": "1"}, {"a": "2", "c": "1"}, {"a": "1", "b": "1", "c": "2"}, {"a": "1"}]


@pytest.mark.parametrize("order", [(3, 1, 0, 2), (1, 3, 2, 0), (2, 0, 3, 1)])
def test_days_in_any_order_give_the_timeline_in_order(spark, tmp_path, table_name, day, rows, order):
    root = str(tmp_path)
    for n in order:
        path = files.write_bronze(bronze_rows(spark, DAYS[n]), root, "establishments", day(n + 1))
        incremental.establishments_stream(spark, path, f"{root}/checkpoint", table_name, late="insert")
    gold = tables.read_table(spark, table_name, schemas.GOLD_ESTABLISHMENT)
    want = slow([(day(n + 1), values) for n, values in enumerate(DAYS)])
    assert rows(gold, "siret", "activite_principale", "valid_from", "valid_to") == want
    quality.assert_sound(gold, ["siret"], ["siret"])
    versions.drop(spark, table_name)


def test_a_batch_that_fails_halfway_is_applied_once(spark, tmp_path, table_name, day, rows, monkeypatch):
    root, checkpoint, gold = str(tmp_path), f"{tmp_path}/checkpoint", table_name
    path = files.write_bronze(bronze_rows(spark, {"a": "1", "b": "1"}), root, "establishments", day(2))

    def stream():
        incremental.establishments_stream(spark, path, checkpoint, gold, rejects_root=f"{root}/kept")

    stream()
    files.write_bronze(bronze_rows(spark, {"a": "2", "b": "0"}), root, "establishments", day(1))
    with monkeypatch.context() as m:
        m.setattr(versions, "_vacuum", lambda *_: 1 / 0)  # after publishing
        with pytest.raises(Exception, match="division"):
            stream()
    number = versions.state(spark, gold).number
    stream()
    assert versions.state(spark, gold).number == number
    shown = rows(tables.read_table(spark, gold, schemas.GOLD_ESTABLISHMENT), "siret", "activite_principale", "valid_from")
    assert shown == [("a", "1", day(2)), ("b", "1", day(2))]
    late = spark.read.parquet(f"{root}/kept/bronze/establishments/rejects/late")
    assert rows(late, "batch") == [("1",), ("1",)]
    files.write_bronze(bronze_rows(spark, {"b": "7"}), root, "establishments", day(1))
    stream()
    late = spark.read.parquet(f"{root}/kept/bronze/establishments/rejects/late")
    assert rows(late.groupBy("batch").count()) == [("1", 2), ("2", 1)]
    versions.drop(spark, gold)


def test_establishments_daily_twice_on_one_day(spark, tmp_path, table_name, day, rows):
    def job(values, n):
        rows = bronze_rows(spark, values).unionByName(bronze_rows(spark, values).limit(1))
        daily.establishments_daily(rows, f"{table_name}_s", table_name, day(n), rejects_root=str(tmp_path))

    job({"a": "1", "b": "1"}, 1)
    job({"a": "8", "b": "8", "z": "8"}, 2)
    job({"a": "2", "b": "1"}, 2)
    gold = tables.read_table(spark, table_name, schemas.GOLD_ESTABLISHMENT)
    assert rows(gold, "siret", "activite_principale", "valid_from", "valid_to") == [
        ("a", "1", day(1), day(2)), ("a", "2", day(2), None), ("b", "1", day(1), None),
    ]
    kept = spark.read.parquet(f"{tmp_path}/bronze/establishments/rejects/repeated")
    assert rows(kept, "reject_reason", "ingestion_date") == [("repeated siret", str(day(1))), ("repeated siret", str(day(2)))]
    versions.drop(spark, table_name)


def test_orders_of_runs_do_not_matter_for_the_rebuild(spark, table, day, rows):
    values = [(day(n), f"k{n % 2}", float(n % 3)) for n in range(1, 7)]
    frame = spark.createDataFrame([(k, v, d) for d, k, v in values], "k string, v double, d date")
    for subset in itertools.islice(itertools.permutations(values, 2), 0, 12, 5):
        part = frame.join(spark.createDataFrame([(d,) for d, _, _ in subset], "d date"), "d").select("k", "v", "d")
        versions.insert_days(table, LAYOUT, part, ["v"], "d")
    versions.insert_days(table, LAYOUT, frame, ["v"], "d")
    by_day = [(d, {k: v}) for d, k, v in values]
    assert shown(spark, table, rows) == slow(by_day)


def test_rows_of_a_batch_are_cleaned_once(spark, tmp_path, table_name, day, monkeypatch):
    """Steps that read them again, and the write of rebuilt timelines, find stored rows."""
    plans = []
    for step, at in (("historize_days", 2), ("replace_parts", 3)):

        def asked(*args, step=step, at=at, run=getattr(versions, step), **options):
            plans.append((step, args[at]._jdf.queryExecution().optimizedPlan().toString()))
            return run(*args, **options)

        monkeypatch.setattr(versions, step, asked)
    for n in (3, 1):
        path = files.write_bronze(bronze_rows(spark, DAYS[n]), str(tmp_path), "establishments", day(n + 1))
        incremental.establishments_stream(spark, path, f"{tmp_path}/checkpoint", table_name, late="insert")
    assert len(plans) == 5
    assert all("Window" not in plan for step, plan in plans if step == "historize_days")
    # Of the three writes, the one of the rebuilt timelines comes second.
    assert "Window" not in [plan for step, plan in plans if step == "replace_parts"][1]
    versions.drop(spark, table_name)
