import pytest

from ledgerline import schemas
from ledgerline.operators import evaluate, quality, serve
from ledgerline.schemas import ANNOUNCEMENT_LINK, struct_of

VERSIONS = "key string, valid_from date, valid_to date, is_current boolean"


@pytest.fixture
def held_out(spark):
    announcements = spark.createDataFrame(
        [("B4", "400", "alder"), ("B5", "500", "birch"), ("B6", "600", "cedar"), ("B7", None, "dogwood"),
         ("B8", "801", "elm")],
        "id string, siren_declared string, commercant string",
    )
    candidates = spark.createDataFrame(
        [(s, f"{s}-1") for s in ("400", "500", "600", "700")], "siren string, siret string"
    )
    return evaluate.hold_out(announcements, candidates)


def predicted(spark, *pairs):
    data = [(a, None, s, "splink_fuzzy", 0.55) for a, s in pairs]
    return spark.createDataFrame(data, ANNOUNCEMENT_LINK)


def test_held_out_announcements_are_blind(held_out, rows):
    blind, truth = held_out
    assert rows(blind) == [("B4", "alder"), ("B5", "birch"), ("B6", "cedar")]
    assert rows(truth) == [("B4", "400-1"), ("B5", "500-1"), ("B6", "600-1")]


def test_precision_and_recall(spark, held_out):
    _, truth = held_out
    guesses = predicted(spark, ("B6", "600-1"), ("B4", "500-1"), ("B5", "500-1"), ("B5", "400-1"), ("C1", "x"))
    assert tuple(evaluate.precision_recall(truth, guesses).first()) == (3, 4, 2, 0.5, 2 / 3)
    assert tuple(evaluate.precision_recall(truth, predicted(spark)).first()) == (3, 0, 0, 0.0, 0.0)
    nothing = evaluate.precision_recall(truth.limit(0), predicted(spark, ("B4", "x")))
    assert tuple(nothing.first()) == (0, 0, 0, 0.0, 0.0)


@pytest.fixture
def sound(spark, day):
    return spark.createDataFrame(
        [("a", day(1), day(2), False), ("a", day(2), None, True), ("b", day(1), None, True)], VERSIONS
    )


def test_each_violation_trips_its_own_assertion(spark, sound, day, rows):
    checks = {
        "current": quality.one_current,
        "version": quality.unique_version,
        "flag": quality.flag_matches_valid_to,
    }
    violations = {
        "current": ("b", day(3), None, True),
        "version": ("b", day(1), day(2), False),
        "flag": ("c", day(1), day(5), True),
    }
    assert all(check(sound, ["key"]).isEmpty() for check in checks.values())
    quality.assert_sound(sound, ["key"], ["key", "valid_from"])
    for seeded, row in violations.items():
        bad = sound.unionByName(spark.createDataFrame([row], struct_of(VERSIONS)))
        tripped = [name for name, check in checks.items() if not check(bad, ["key"]).isEmpty()]
        assert tripped == [seeded]
        with pytest.raises(ValueError):
            quality.assert_sound(bad, ["key"], ["key"])


def test_not_null_and_accepted_values(sound, rows):
    assert rows(quality.not_null(sound, ["key", "valid_to", "is_current"])) == [("valid_to", 2)]
    assert rows(quality.accepted_values(sound, "key", ["a"])) == [("b", 1)]


@pytest.fixture
def registry(spark, day):
    base = dict.fromkeys(schemas.GOLD_ESTABLISHMENT.fieldNames())
    data = [
        {"siren": "1", "siret": "100", "libelle_commune": "Charleville", "valid_from": day(2),
         "is_current": True},
        {"siren": "1", "siret": "100", "libelle_commune": "Sedan", "valid_from": day(1),
         "valid_to": day(2), "is_current": False},
        {"siren": "2", "siret": "200", "libelle_commune": "CHARLY", "valid_from": day(1),
         "is_current": True},
    ]
    return spark.createDataFrame(
        [tuple((base | r).values()) for r in data], schemas.GOLD_ESTABLISHMENT
    )


@pytest.mark.parametrize(
    "q, found",
    [("char", ["100", "200"]), ("100", ["100"]), ("2", ["200"]), ("sedan", []), ("ch%y", ["200"])],
)
def test_search(registry, q, found):
    assert [r.siret for r in serve.search(registry, q).collect()] == found


def test_search_is_limited(spark, registry):
    many = registry.filter("siret = '200'").crossJoin(spark.range(60)).drop("id")
    assert serve.search(many, "charly").count() == serve.SEARCH_LIMIT


def test_history(registry, day):
    assert [r.valid_from for r in serve.history(registry, "100").collect()] == [day(1), day(2)]
    assert serve.history(registry, "999").isEmpty()
    assert serve.check_contract(registry, schemas.GOLD_ESTABLISHMENT).schema == registry.schema
    with pytest.raises(ValueError):
        serve.check_contract(registry.drop("siret"), schemas.GOLD_ESTABLISHMENT)


def test_announcements_of_an_establishment(spark, day):
    links = spark.createDataFrame(
        [
            ("A1", None, "100", "exact_siren", 1.0, day(1), None, True),
            ("A2", None, "100", "exact_siren", 1.0, day(1), None, True),
            ("A3", None, "100", "exact_siren", 1.0, day(1), None, True),
            ("A4", None, "100", "exact_siren", 1.0, day(1), day(2), False),
            ("A5", None, None, "unresolved", None, day(1), None, True),
            ("A6", None, "100", "exact_siren", 1.0, day(1), None, True),  # without content
        ],
        schemas.GOLD_ANNOUNCEMENT_LINK,
    )
    base = dict.fromkeys(schemas.SILVER_ANNOUNCEMENT.fieldNames())
    content = [("A1", day(3)), ("A2", None), ("A3", day(5)), ("A4", day(1)), ("A5", day(1))]
    announcements = spark.createDataFrame(
        [tuple((base | {"id": i, "date_parution": d}).values()) for i, d in content],
        schemas.SILVER_ANNOUNCEMENT,
    )
    view = serve.announcements_view(links, announcements)
    assert view.schema.fieldNames() == schemas.SERVED_ANNOUNCEMENT.fieldNames()
    assert view.count() == 4
    found = [r.bodacc_announcement_id for r in serve.announcements_of(view, "100").collect()]
    assert found == ["A2", "A3", "A1"]


def test_won_then_bankrupt(spark, rows):
    import datetime as dt

    d = dt.date
    wins = spark.createDataFrame(
        [("1", d(2024, 2, 29)), ("1", d(2023, 1, 1)), ("1", d(2024, 2, 29)), ("2", d(2024, 1, 1)),
         ("3", d(2024, 1, 1)), (None, d(2024, 1, 1)), ("4", d(2024, 5, 1))],
        "siren string, date_notification date",
    )
    notices = spark.createDataFrame(
        [("1", d(2025, 2, 28), "P"), ("2", d(2023, 12, 31), "P"), ("2", d(2025, 1, 2), "P"),
         ("3", d(2024, 6, 1), "other"), ("4", d(2024, 5, 1), "P")],
        "siren string, date_parution date, famille_avis string",
    )
    assert rows(serve.won_then_bankrupt(wins, notices, "P")) == [
        ("1", 2, d(2024, 2, 29), d(2025, 2, 28)),
        ("4", 1, d(2024, 5, 1), d(2024, 5, 1)),
    ]


def test_markets_of(spark, rows, day):
    base = dict.fromkeys(schemas.GOLD_MARKET_LINK.fieldNames())
    data = [
        base | {"uid": "M1", "siret_titulaire": "1", "is_current": True},
        base | {"uid": "M2", "siret_titulaire": "1", "is_current": False},
        base | {"uid": "M3", "siret_titulaire": "2", "is_current": True},
    ]
    links = spark.createDataFrame([tuple(r.values()) for r in data], schemas.GOLD_MARKET_LINK)
    assert rows(serve.markets_of(links, "1"), "uid") == [("M1",)]
