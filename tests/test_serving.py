"""Lookups and search from published files, and what they read."""

import datetime as dt

import pytest

from ledgerline import schemas
from ledgerline.operators import serve
from ledgerline.plans import serving
from ledgerline.sources import lookups

DAY = dt.date(2026, 10, 1)
TOWNS = ["Brume-sur-Vive", "BRUMEVAL", "Ys", "Y", "", None, "Été 50%", "Plat_Bas", "Saint-Brumond", "ΟΔΟΣ"]
QUERIES = ["brum", "BRUME", "b_ume", "%", "", "y", "ys", "ét", "50\\%", "plat\\_", "br%val", "zzz", "sur-vive", "οδος", "000000003", "00000000300001"]


def establishment(number, town, current=True):
    values = {f.name: None for f in schemas.GOLD_ESTABLISHMENT.fields}
    siren = None if number % 7 == 6 else f"{number // 2:09d}"
    siret = f"{number // 2:09d}{number % 2:05d}"
    values |= {"siren": siren, "siret": siret, "libelle_commune": town}
    values |= {"valid_from": DAY, "valid_to": None if current else DAY, "is_current": current}
    return tuple(values[f.name] for f in schemas.GOLD_ESTABLISHMENT.fields)


@pytest.fixture(scope="module")
def gold(spark):
    data = [establishment(i, TOWNS[i % len(TOWNS)]) for i in range(200)]
    data += [establishment(1000 + i, "Brumeval", current=False) for i in range(5)]
    data += [establishment(2000 + i, "Brume-sur-Vive") for i in range(300)]  # one town has most rows
    return spark.createDataFrame(data, schemas.GOLD_ESTABLISHMENT).repartition(4)


@pytest.fixture(scope="module")
def index(gold, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "search")
    serving.build_search_index(gold, path, buckets=16)
    return path


def files_read(df):
    """Files that the scans of a query opened, as Spark counts them."""
    df.collect()
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        metric = node.metrics().get("numFiles")
        total += metric.get().value() if metric.isDefined() else 0
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


@pytest.mark.parametrize("q", QUERIES)
def test_indexed_search_equals_search(spark, gold, index, q):
    assert serving.search(spark, index, q).collect() == serve.search(gold, q).collect()


def test_search_opens_only_folders_that_may_have_it(spark, index):
    every = files_read(serving.indexed_rows(spark, index, ""))
    assert every > 4
    assert files_read(serving.search(spark, index, "saint-brum")) == 1
    assert files_read(serving.search(spark, index, "00000000300001")) == 1
    assert files_read(serving.search(spark, index, "nowhere")) == 0


def test_every_current_row_is_indexed(spark, gold, index, rows):
    kept = lookups.read_lookup(spark, f"{index}/rows", schemas.GOLD_ESTABLISHMENT)
    assert rows(kept, *gold.columns) == rows(gold.filter("is_current"))


def test_pieces_of_patterns():
    assert serving.grams_of_pattern("%abcd%") == ["abc", "bcd"]
    assert serving.grams_of_pattern("%ab_cde%fg%") == ["cde"]
    assert serving.grams_of_pattern("%a\\%b%") == ["a%b"]
    assert serving.grams_of_pattern("%%") == serving.grams_of_pattern("%ab%") == [""]


def test_a_very_long_town(spark, tmp_path):
    town = "ab" * 500_000 + "needle"
    gold = spark.createDataFrame([establishment(1, town), establishment(2, "ab")], schemas.GOLD_ESTABLISHMENT)
    serving.build_search_index(gold, f"{tmp_path}/long", buckets=4)
    assert [r.siret for r in serving.search(spark, f"{tmp_path}/long", "NEEDLE").collect()] == ["00000000000001"]


def test_an_empty_table(spark, tmp_path):
    none = spark.createDataFrame([], schemas.GOLD_ESTABLISHMENT)
    serving.build_search_index(none, f"{tmp_path}/none")
    assert serving.search(spark, f"{tmp_path}/none", "a").collect() == []
    serving.publish_establishments(none, f"{tmp_path}/history")
    assert serving.history(spark, f"{tmp_path}/history", "1").collect() == []


def test_history_reads_one_folder(spark, gold, tmp_path):
    path = f"{tmp_path}/history"
    serving.publish_establishments(gold, path)
    found = serving.history(spark, path, "00000000300001")
    assert found.collect() == serve.history(gold, "00000000300001").collect()
    assert files_read(found) == 1
    assert files_read(lookups.read_lookup(spark, path, schemas.GOLD_ESTABLISHMENT)) > 16


def test_values_may_be_missing_repeated_or_of_other_types(spark, tmp_path, rows):
    data = [(1, "a"), (1, "a"), (None, "b"), (2, None), (3, "")]
    df = spark.createDataFrame(data, "key bigint, text string")
    lookups.write_lookup(df, f"{tmp_path}/keys", ["key"], buckets=8)
    lookups.write_lookup(df, f"{tmp_path}/both", ["key", "text"], buckets=3)
    find = lambda **v: rows(lookups.lookup(spark, f"{tmp_path}/keys", df.schema, **v))
    assert find(key=1) == [(1, "a"), (1, "a")] and find(key=9) == []
    assert find(key=None) == [(None, "b")]
    both = lambda **v: rows(lookups.lookup(spark, f"{tmp_path}/both", df.schema, **v))
    assert both(key=2, text=None) == [(2, None)] and both(key=3, text="") == [(3, "")]


def test_folder_columns_are_not_overwritten(spark, tmp_path):
    df = spark.createDataFrame([(1, 2)], "key int, Lookup_Bucket int")
    with pytest.raises(ValueError, match="taken"):
        lookups.write_lookup(df, f"{tmp_path}/taken", ["key"])
