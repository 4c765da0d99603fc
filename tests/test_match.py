import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import match
from ledgerline.operators.keys import hot_keys, lookup
from ledgerline.schemas import ANNOUNCEMENT_LINK

ANNOUNCEMENTS = "id string, siren_declared string, commercant string"
CANDIDATES = "siren string, siret string"


@pytest.fixture
def announcements(spark):
    return spark.createDataFrame(
        [("A1", "704500001", "x"), ("A2", None, "y"), ("A3", "500000005", "z")], ANNOUNCEMENTS
    )


@pytest.fixture
def candidates(spark):
    return spark.createDataFrame(
        [("704500001", "70450000100031"), ("861000008", "86100000800027"), (None, "0")], CANDIDATES
    )


def links(spark, *data):
    return spark.createDataFrame(list(data), ANNOUNCEMENT_LINK)


def test_exact_match_and_the_rest(announcements, candidates, rows):
    exact = match.exact_matches(announcements, candidates)
    assert exact.schema.fieldNames() == ANNOUNCEMENT_LINK.fieldNames()
    assert rows(exact) == [("A1", "704500001", "70450000100031", "exact_siren", 1.0)]
    assert rows(match.unmatched(announcements, exact), "id") == [("A2",), ("A3",)]


def test_company_with_several_offices(spark, announcements, rows):
    offices = spark.createDataFrame([("704500001", "2"), ("704500001", "1")], CANDIDATES)
    assert rows(match.exact_matches(announcements, offices), match.ID, "siret_siege") == [("A1", "1")]
    every = match.exact_matches(announcements, offices, every_office=True)
    assert rows(every, "siret_siege") == [("1",), ("2",)]


def test_best_match_with_ties(spark, rows):
    predictions = spark.createDataFrame(
        [("A1", "T8", 0.31), ("A1", "T5", 0.74), ("A2", "T4", 0.52), ("A2", "T3", 0.52)],
        "uid_l string, uid_r string, match_probability double",
    )
    fuzzy = match.fuzzy_records(predictions)
    assert rows(match.best_match(fuzzy)) == [
        ("A1", None, "T5", "splink_fuzzy", 0.74),
        ("A2", None, "T3", "splink_fuzzy", 0.52),
    ]


def test_combination_is_completed_with_unresolved(spark, announcements, candidates, rows):
    exact = match.exact_matches(announcements, candidates)
    fuzzy = links(
        spark,
        ("A2", None, "T1", "splink_fuzzy", 0.47),
        ("A2", None, "T6", "splink_fuzzy", 0.63),
    )
    out = match.complete_unresolved(announcements, match.combine_matches(exact, fuzzy))
    assert rows(out) == [
        ("A1", "704500001", "70450000100031", "exact_siren", 1.0),
        ("A2", None, "T6", "splink_fuzzy", 0.63),
        ("A3", None, None, "unresolved", None),
    ]


def test_backlog_counts_closed_links_as_missing_and_unresolved_ones_as_done(spark, rows):
    announcements = spark.createDataFrame(
        [("A1", None, ""), ("A2", None, ""), ("A3", None, ""), ("A4", None, "")], ANNOUNCEMENTS
    )
    gold = spark.createDataFrame(
        [
            ("A1", "exact_siren", None, True),
            ("A2", "splink_fuzzy", dt.date(2026, 10, 2), False),
            ("A4", "unresolved", None, True),
        ],
        "bodacc_announcement_id string, match_method string, valid_to date, is_current boolean",
    )
    assert rows(match.backlog(announcements, gold), "id") == [("A2",), ("A3",)]


@pytest.mark.parametrize("share", [2, 4, 500])
def test_lookup_keeps_every_fact_once_with_hot_missing_and_null_keys(spark, rows, monkeypatch, share):
    monkeypatch.setattr("ledgerline.operators.keys.HOT_SHARE", share)
    facts = [(i, "hot" if i % 3 == 0 else "warm" if i % 3 == 1 else None) for i in range(60)]
    facts += [(100, "cold"), (101, "unknown")]
    df = spark.createDataFrame(facts, "id long, key string")
    entries = spark.createDataFrame([("hot", 1), ("cold", 2), ("unused", 3)], "k string, value int")
    expected = {"hot": 1, "cold": 2}
    out = rows(lookup(df, entries, {"key": "k"}, spread_by="id"))
    assert out == sorted(((i, k, expected.get(k)) for i, k in facts), key=repr)
    assert lookup(df.limit(0), entries, {"key": "k"}, spread_by="id").isEmpty()


def test_hot_keys_are_those_with_a_share_of_the_rows(spark, rows, monkeypatch):
    monkeypatch.setattr("ledgerline.operators.keys.HOT_SHARE", 4)
    keys = ["a"] * 50 + ["b"] * 26 + ["c"] * 24 + [None] * 90
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    assert rows(hot_keys(df, ["k"])) == [("a",), ("b",)]


def test_large_entries_are_not_broadcast_because_they_compress_well(spark, tmp_path):
    """A gigabyte once decoded, in files of a few megabytes."""
    text = F.concat(F.repeat(F.lit("x"), 2000), F.col("id").cast("string"))
    spark.range(500_000).select("id", text.alias("text")).write.parquet(str(tmp_path / "entries"))
    entries = spark.read.parquet(str(tmp_path / "entries"))
    facts = spark.range(10).withColumnRenamed("id", "key")
    found = lookup(facts, entries, {"key": "id"}, spread_by="key")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.split("\n") if "Join" in line]
    assert sum("strategy=broadcast" in line for line in joins) == 2  # the hot keys, twice
    assert len(joins) == 3


def test_few_entries_reach_the_facts_without_a_shuffle(spark, rows):
    facts = [(i, ["a", "b", "c", None][i % 4]) for i in range(40)]
    df = spark.createDataFrame(facts, "id long, key string")
    entries = spark.createDataFrame([("a", 1), ("b", None)], "k string, value int")
    few = lookup(df, entries, {"key": "k"}, spread_by="id", few=2)
    assert rows(few) == rows(lookup(df, entries, {"key": "k"}, spread_by="id", few=1))
    assert rows(few) == sorted(((i, k, {"a": 1}.get(k)) for i, k in facts), key=repr)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
