import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.functions import similarity
from ledgerline.functions.text import segment_keys, segment_probes, with_character_masks
from ledgerline.operators import linkage
from ledgerline.operators.keys import lookup
from ledgerline.operators.model import LinkageModel, default_m, prior_from_rule, train_m
from ledgerline.plans.cascade import run_cascade

PREPARED = "uid string, denomination_clean string, adresse_clean string"


def jw(a, b):
    return similarity.jaro_winkler_pairs(pd.Series([a]), pd.Series([b]))[0]


def plain_jaro_winkler(a, b):
    """The published definition, one character at a time."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    reach = max(0, len(long) // 2 - 1)
    used, pairs = set(), []
    for i, c in enumerate(short):
        for j in range(max(0, i - reach), min(len(long), i + reach + 1)):
            if j not in used and long[j] == c:
                used.add(j)
                pairs.append(c)
                break
    if not pairs:
        return 0.0
    m = len(pairs)
    swaps = sum(x != long[j] for x, j in zip(pairs, sorted(used), strict=True)) // 2
    jaro = (m / len(short) + m / len(long) + (m - swaps) / m) / 3
    prefix = 0
    while prefix < min(4, len(short)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


@pytest.mark.parametrize(
    "a, b, score",
    [
        ("martha", "marhta", 0.9611),
        ("dixon", "dicksonx", 0.8133),
        ("dwayne", "duane", 0.84),
        ("abc", "abc", 1.0),
        ("", "", 0.0),
        ("", "a", 0.0),
        ("a", "b", 0.0),
    ],
)
def test_published_similarities(a, b, score):
    assert jw(a, b) == pytest.approx(score, abs=5e-5)


def test_similarity_equals_its_definition_at_any_length():
    rng = random.Random(5)
    left = ["".join(rng.choices("abcdé 𝄞", k=rng.randint(0, n))) for n in (5, 20, 64, 70, 200) for _ in range(60)]
    right = [
        x[: len(x) // 2] + "".join(rng.choices("abcdé 𝄞", k=rng.randint(0, len(x) + 2))) for x in left
    ]
    got = similarity.jaro_winkler_pairs(pd.Series(left), pd.Series(right))
    want = [plain_jaro_winkler(a, b) for a, b in zip(left, right, strict=True)]
    assert np.allclose(got, want, atol=1e-12)
    assert similarity.jaro_winkler_pairs(pd.Series([None, "a"]), pd.Series(["a", None])).isna().all()


@pytest.mark.parametrize("threshold", [0.7, 0.9])
def test_tiles_of_names_reach_what_pairs_reach(threshold):
    rng = random.Random(6)

    def some(count):
        texts = ["soci" * rng.randint(0, 1) + "".join(rng.choices("abcdé 𝄞", k=rng.randint(0, n))) for n in (4, 12, 30, 64, 90) for _ in range(count)]
        return texts + [t[::-1] for t in texts[:5]] + [t[:-1] + "x" for t in texts[-12:]]

    lefts, rights = some(14), some(9)
    rights += [t[1:] + "a" for t in lefts[::3]] + lefts[:4]
    pairs = pd.Series([a for a in lefts for _ in rights]), pd.Series([b for _ in lefts for b in rights])
    want = similarity.jaro_winkler_pairs(*pairs).to_numpy().reshape(len(lefts), len(rights)) >= threshold
    assert (similarity.reaching(lefts, rights, threshold) == want).all() and want.any()
    assert similarity.reaching([], rights, threshold).shape == (0, len(rights))
    assert similarity.reaching(lefts, [""], threshold).sum() == 0


def test_bound_never_excludes_a_pair_that_reaches_the_threshold(spark):
    rng = random.Random(9)
    names = sorted({"".join(rng.choices("abcde", k=rng.randint(1, 14))) for _ in range(120)})
    df = spark.createDataFrame([("sarl" + n,) for n in names], "name string")
    left = with_character_masks(df, "name", "l")
    right = with_character_masks(df.withColumnRenamed("name", "name_r"), "name_r", "r")
    pairs = left.crossJoin(right)
    for threshold in (0.9, 0.7):
        marked = pairs.withColumn("kept", similarity.may_reach(threshold, 4, "l", "r"))
        scored = marked.withColumn(
            "score", similarity.jaro_winkler(F.col("name"), F.col("name_r"))
        )
        assert scored.filter((F.col("score") >= threshold) & ~F.col("kept")).isEmpty()
    assert not marked.filter("NOT kept").isEmpty() or threshold == 0.7


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("depth", [1, 2])
def test_near_texts_share_a_segment(spark, depth):
    rng = random.Random(2)
    texts = sorted({"".join(rng.choices("ab1", k=rng.randint(0, 9))) for _ in range(150)})
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    keys = df.select("t", segment_keys(F.col("t"), depth).alias("k"), segment_probes(F.col("t"), depth).alias("p"))
    found = {r.t: (set(r.k), set(r.p)) for r in keys.collect()}
    for a in texts:
        for b in texts:
            if distance(a, b) <= depth:
                assert found[a][0] & found[b][1], (a, b)


@pytest.mark.parametrize("parts", [2, 4])
def test_near_texts_share_one_of_any_segments(spark, parts):
    rng = random.Random(3)
    texts = sorted({"".join(rng.choices("ab1", k=rng.randint(0, 12))) for _ in range(120)})
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    keys = df.select("t", segment_keys(F.col("t"), 1, parts).alias("k"), segment_probes(F.col("t"), 1, parts).alias("p"))
    found = {r.t: (r.k, set(r.p)) for r in keys.collect()}
    for a in texts:
        for b in texts:
            if distance(a, b) <= 1:
                assert sum(k in found[b][1] for k in found[a][0]) >= parts - 1, (a, b)


def test_a_shared_postcode_makes_no_square(spark, monkeypatch):
    rng = random.Random(8)
    towns = sorted({"".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=14)) for _ in range(2000)})
    left = spark.createDataFrame([(f"75001 {t}",) for t in towns], "address string")
    right = spark.createDataFrame([(f"75001 {t[:-1]}x",) for t in towns], "address string")
    candidates = linkage.address_candidates(left, right, LinkageModel())
    assert candidates.count() < 20 * len(towns)
    pairs = linkage.near_addresses(left, right, LinkageModel())
    assert pairs.filter(F.substring("address_l", 1, 19) == F.substring("address_r", 1, 19)).count() == len(towns)


def test_a_long_address_has_as_many_keys_as_a_short_one(spark, rows):
    long = "".join(random.Random(1).choices("abcdef ", k=20_000))
    near = long[:9_000] + "x" + long[9_001:-1]
    left = spark.createDataFrame([(long,), ("10 paris",)], "address string")
    right = spark.createDataFrame([(near,), ("10 pari",), ("20 lyon",)], "address string")
    pairs = linkage.near_addresses(left, right, LinkageModel())
    assert rows(pairs, "address_l", "address_r") == sorted([(long, near), ("10 paris", "10 pari")])


WORDS = ["sarl alpha", "sarl alpine", "alphonse", "alpha bois", "bois du roi", "bois du rio",
         "sarl alphabet", "", "ab", "abc"]
TOWNS = ["75001 paris", "75002 paris", "69001 lyon", "", "1", "69001 lyons", "13000 marseille"]


def sample(rng, count, prefix):
    return [
        (f"{prefix}{i:04d}", rng.choice(WORDS) + rng.choice(["", "s", " sa"]), rng.choice(TOWNS))
        for i in range(count)
    ]


def levels(x, y):
    score = round(plain_jaro_winkler(x[1], y[1]), 9)
    name = 3 if x[1] == y[1] else 2 if score >= 0.9 else 1 if score >= 0.7 else 0
    return name, {0: 3, 1: 2, 2: 1}.get(distance(x[2], y[2]), 0)


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(3)
    left, right = sample(rng, 60, "A"), sample(rng, 50, "S")
    frames = [spark.createDataFrame(side, PREPARED) for side in (left, right)]
    vl, vr = (linkage.values(f).cache() for f in frames)
    in_block = {
        (i, j): levels(x, y)
        for i, x in enumerate(left)
        for j, y in enumerate(right)
        if x[1][:4] == y[1][:4]
    }
    return left, right, frames, vl, vr, in_block


def test_counts_by_address_level_equal_listing_all_pairs(sides):
    *_, vl, vr, in_block = sides
    near = linkage.near_addresses(vl, vr, LinkageModel())
    counts = linkage.block_address_counts(vl, vr, near, LinkageModel()).collect()
    got = {r.address_level: int(r.pairs) for r in counts if r.pairs}
    assert got == dict(Counter(address for _, address in in_block.values()))
    assert sum(int(r.pairs) for r in linkage.block_counts(vl, vr).collect()) == len(in_block)


@pytest.mark.parametrize("seed", range(8))
def test_best_matches_equal_scoring_all_pairs(sides, seed, monkeypatch):
    left, right, _, vl, vr, in_block = sides
    rng = random.Random(seed)

    def some(*choices):
        return tuple(rng.choice(choices) for _ in range(4))

    model = LinkageModel(
        prior=rng.choice([0.001, 0.05, 0.3, 0.6]),
        u_name=some(0.3, 0.1, 0.01, 0.001),
        u_address=some(0.3, 0.1, 0.01, 0.001),
        m_name=some(0.3, 0.1, 0.01, 0.5),
        m_address=some(0.3, 0.1, 0.01, 0.5),
    ) if seed else LinkageModel(prior=0.01)
    expected = {}
    for (i, j), pattern in in_block.items():
        p = model.probability(*pattern)
        if p >= model.threshold:
            value, offer = left[i][1:], (-p, right[j][0])
            expected[value] = min(expected.get(value, offer), offer)
    monkeypatch.setattr(linkage.first_partners, "__defaults__", (rng.choice([1, 3, 64]),))
    best = linkage.best_matches(vl, vr, model, tile_rows=rng.choice([3, 1000]))
    got = {(r.name, r.address): (-r.match_probability, r.uid) for r in best.collect()}
    assert got == expected


@pytest.mark.parametrize("seed", range(6))
def test_trained_like_models_equal_scoring_all_pairs(sides, seed, monkeypatch):
    """Names more alike score more in these, addresses more alike not always; unrelated addresses are accepted."""
    left, right, _, vl, vr, in_block = sides
    model = LinkageModel(
        prior=(0.3, 0.5, 0.7, 0.3, 0.5, 0.25)[seed],
        u_name=(0.5, 0.3, 0.15, 0.05),
        u_address=(0.6, 0.2, 0.1, 0.1),
        m_name=(0.02, 0.28, 0.3, 0.4) if seed % 2 else (0.1, 0.2, 0.3, 0.4),
        m_address=(0.3, 0.2, 0.2, 0.3) if seed < 3 else (0.5, 0.02, 0.03, 0.45),
    )
    pairs = [(n, a) for n in (1, 2) for a in model.address_levels if model.accepts(n, a)]
    assert pairs and all(linkage._names_in_order(model, n, a) for n, a in pairs)
    expected = {}
    for (i, j), pattern in in_block.items():
        p = model.probability(*pattern)
        if p >= model.threshold:
            value, offer = left[i][1:], (-p, right[j][0])
            expected[value] = min(expected.get(value, offer), offer)
    monkeypatch.setattr(linkage, "ROUND_GROWTH", 2)
    monkeypatch.setattr(linkage, "FEW_TILES", 0)
    monkeypatch.setattr(linkage.first_partners, "__defaults__", (1 + seed,))
    best = linkage.best_matches(vl, vr, model, tile_rows=(3, 1000)[seed % 2])
    got = {(r.name, r.address): (-r.match_probability, r.uid) for r in best.collect()}
    assert got == expected


def test_first_partners_stop_early(spark, monkeypatch):
    left = spark.range(300).selectExpr("'bloc' AS block", "concat('bloc name ', id) AS name")
    right = spark.range(5000).selectExpr("'bloc' AS block", "concat('bloc nama ', id) AS name_r", "lpad(id, 6, '0') AS uid")
    asked = []
    monkeypatch.setattr(linkage, "FEW_TILES", 0)
    compared = linkage._tile_partners
    monkeypatch.setattr(linkage, "_tile_partners", lambda l, r, *a: asked.append(l.count() * r.count()) or compared(l, r, *a))
    hits = linkage.first_partners(left, right, ["block"], LinkageModel(), 1, 1000)
    assert {r.uid for r in hits.collect()} == {"000000"} and hits.count() == 300
    assert asked == [300 * linkage.FIRST_ROUND]


def test_tiles_cut_a_hot_group_and_keep_every_pair(spark):
    left = spark.range(50).selectExpr("'hot' AS k", "id AS a").union(
        spark.range(3).selectExpr("'cold'", "id")
    )
    right = spark.range(40).selectExpr("'hot' AS k", "id AS b").union(
        spark.range(2).selectExpr("'cold'", "id")
    )
    l, r, keys = linkage.tiles(left, right, ["k"], ["a"], ["b"], 10)
    assert keys == ["k", "part_l", "part_r"]
    pairs = l.join(r, keys)
    assert pairs.count() == pairs.select("k", "a", "b").distinct().count() == 50 * 40 + 3 * 2
    assert l.groupBy(*keys).count().agg({"count": "max"}).first()[0] < 25
    l, r, keys = linkage.tiles(left, right, ["k"], ["a"], ["b"], 100)
    assert keys == ["k"] and l.join(r, keys).count() == 2006


def test_random_pairs_cover_everything_when_few_and_are_repeatable_when_many(spark, sides):
    left, right, (lf, rf), *_ = sides
    all_levels = Counter(levels(x, y) for x in left for y in right)
    model = LinkageModel()

    def drawn(**options):
        counts = linkage.random_pair_counts(lf, rf, len(left), len(right), model, **options)
        return {(r.name_level, r.address_level): r.pairs for r in counts.collect()}

    assert drawn() == dict(all_levels)
    few = drawn(max_pairs=500)
    assert few == drawn(max_pairs=500)
    assert 200 < sum(few.values()) < 1000
    assert few != drawn(max_pairs=500, seed=7)


def test_training():
    assert default_m(4) == pytest.approx((0.05 / 3, 0.05 / 3, 0.05 / 3, 0.95))
    assert prior_from_rule(70, 1000) == pytest.approx(0.1)
    assert prior_from_rule(1000, 1000) < 1.0
    assert prior_from_rule(0, 0) == 0.0
    u = (0.97, 0.01, 0.01, 0.01)
    # 1,000 matches that agree nine times in ten, among 99,000 pairs distributed like u.
    counts = [99_000 * share for share in u]
    counts[0] += 100
    counts[3] += 900
    m = train_m(counts, u, 0.01, default_m(4))
    assert m[3] > 0.8 > 0.2 > m[0] > 0
    assert train_m([0, 0, 0, 0], u, 0.1, default_m(4)) == default_m(4)
    unseen = train_m([10, 0, 0, 5], u, 0.1, default_m(4))
    assert unseen[1] == 1e-6


def test_model_survives_json_and_rejects_missing_levels():
    model = LinkageModel(prior=0.2, u_name=(0.4, 0.3, 0.2, 0.1))
    assert LinkageModel.from_json(model.to_json()) == model
    with pytest.raises(ValueError):
        LinkageModel(m_name=(0.5, 0.5))
    odds = 0.2 / 0.8 * (model.m_name[3] / 0.1) * (model.m_address[0] / model.u_address[0])
    assert model.probability(3, 0) == pytest.approx(odds / (1 + odds))


def test_score_pairs(spark):
    pairs = spark.createDataFrame(
        [("alpha", "1 x", "alpha", "1 x"), ("martha", "1 x", "marhta", "1 y"), ("ab", "", "xy", "abcd")],
        "name_l string, address_l string, name_r string, address_r string",
    )
    out = linkage.score_pairs(pairs, LinkageModel()).collect()
    assert [(r.name_level, r.address_level) for r in out] == [(3, 3), (2, 2), (0, 0)]
    assert out[1].match_probability == pytest.approx(LinkageModel().probability(2, 2))


ANNOUNCEMENTS = "id string, siren_declared string, commercant string, code_postal string, ville string"
CANDIDATES = (
    "siren string, siret string, denomination string, code_postal string, libelle_commune string"
)


def test_cascade_gives_every_announcement_one_record(spark, rows):
    announcements = spark.createDataFrame(
        [
            ("N10", "310000016", "ATELIER VERNIS", "35000", "RENNES"),
            ("N11", None, "MENUISERIE GOELAND", "29200", "BREST"),
            ("N12", None, "ZEBULON", "64100", "BAYONNE"),
            ("N13", "310000099", None, None, None),
        ],
        ANNOUNCEMENTS,
    )
    candidates = spark.createDataFrame(
        [
            ("310000016", "31000001600011", "ATELIER VERNIS ET CIE", "35000", "RENNES"),
            ("420000024", "42000002400038", "MENUISERIE GOELANDS", "29200", "BREST"),
            ("530000032", "53000003200045", "MENHIR TRANSPORTS", "29200", "BREST"),
        ],
        CANDIDATES,
    )
    model = LinkageModel(prior=0.01)
    out = run_cascade(announcements, candidates, model)
    assert rows(out, "bodacc_announcement_id", "siren_bodacc", "siret_siege", "match_method") == [
        ("N10", "310000016", "31000001600011", "exact_siren"),
        ("N11", None, "42000002400038", "splink_fuzzy"),
        ("N12", None, None, "unresolved"),
        ("N13", None, None, "unresolved"),
    ]
    confidence = dict(rows(out, "bodacc_announcement_id", "match_confidence"))
    assert confidence["N10"] == 1.0 and confidence["N12"] is None
    assert confidence["N11"] == pytest.approx(model.probability(2, 3))


def test_trained_cascade_is_total(spark, sides):
    left, right, *_ = sides
    announcements = spark.createDataFrame(
        [(i, None, n, t[:5], t[6:]) for i, n, t in left], ANNOUNCEMENTS
    )
    candidates = spark.createDataFrame(
        [(s, s, n, t[:5], t[6:]) for s, n, t in right], CANDIDATES
    )
    out = run_cascade(announcements, candidates).collect()
    assert sorted(r.bodacc_announcement_id for r in out) == [i for i, *_ in left]
    for r in out:
        assert (r.match_method == "unresolved") == (r.siret_siege is None)
        assert r.match_confidence is None or 0.5 <= r.match_confidence <= 1.0


def test_cascade_without_any_candidate(spark):
    announcements = spark.createDataFrame([("B1", "1", "X", "08000", "Y")], ANNOUNCEMENTS)
    out = run_cascade(announcements, spark.createDataFrame([], CANDIDATES)).collect()
    assert [r.match_method for r in out] == ["unresolved"]


def test_no_partners_where_nobody_meets(spark):
    left = spark.sql("SELECT 'bloc' AS block, 'bloc name' AS name")
    right = spark.sql("SELECT 'othe' AS block, 'other name' AS name_r, '1' AS uid")
    assert linkage.first_partners(left, right, ["block"], LinkageModel(), 2, 1000).isEmpty()


def test_names_are_compared_with_little_more_than_they_need(spark, monkeypatch):
    """The first partner is the hundredth name: no round of thousands follows the first one."""
    left = spark.range(20).selectExpr("'bloc' AS block", "concat('bloc name ', id) AS name")
    name = "if(id < 100, concat('bloc', repeat('z', 40), id), concat('bloc nama ', id))"
    right = spark.range(5000).selectExpr("'bloc' AS block", f"{name} AS name_r", "lpad(id, 6, '0') AS uid")
    asked = []
    monkeypatch.setattr(linkage, "FEW_TILES", 0)
    compared = linkage._tile_partners
    monkeypatch.setattr(linkage, "_tile_partners", lambda l, r, *a: asked.append(r.count()) or compared(l, r, *a))
    hits = linkage.first_partners(left, right, ["block"], LinkageModel(), 2, 1000)
    assert {r.uid for r in hits.collect()} == {"000100"} and hits.count() == 20
    assert sum(asked) <= 500


def test_names_met_as_arrays_make_few_tasks(spark):
    """4.5 million pairs of one group are work for one task, not for a task per four tiles of a thousand."""
    left = spark.range(1500).selectExpr("'bloc' AS block", "concat('bloc name ', id) AS name")
    right = spark.range(3000).selectExpr("'bloc' AS block", "concat('bloc nama ', id) AS name_r", "lpad(id, 6, '0') AS uid")
    rows = linkage._tiled(left, right, ["block"], ["uid", "name_r"], 1000).collect()
    assert [(len(r.names), len(r.name_r)) for r in rows] == [(1500, 3000)]


def test_many_small_groups_are_not_one_task(spark, monkeypatch):
    monkeypatch.setattr(linkage, "ROWS_A_TASK", 100)
    left, right = spark.range(500).selectExpr("id AS k", "id AS a"), spark.range(500).selectExpr("id AS k", "id AS b")
    l, r, keys = linkage.tiles(left, right, ["k"], ["a"], ["b"], 1000)
    assert l.rdd.getNumPartitions() == r.rdd.getNumPartitions() == 11 and l.join(r, keys).count() == 500


def test_partners_are_kept_by_shuffles_not_on_the_driver(spark, monkeypatch):
    """What grows with the input is not broadcast, however small a compressed file looks."""
    left = spark.range(300).selectExpr("'bloc' AS block", "concat('bloc name ', id) AS name")
    right = spark.range(900).selectExpr("'bloc' AS block", "concat('bloc nama ', id) AS name_r", "lpad(id, 6, '0') AS uid")
    plans, settle = [], linkage.settle
    monkeypatch.setattr(linkage, "FEW_TILES", 0)
    monkeypatch.setattr(linkage, "settle", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or settle(df))
    linkage.first_partners(left, right, ["block"], LinkageModel(), 2, 1000, 1).count()
    assert plans and not any("BroadcastExchange" in p for p in plans)
    facts = spark.range(100).selectExpr("id AS k", "id AS fact")
    found = lookup(facts, spark.range(50).selectExpr("id AS k", "id AS entry"), {"k": "k"}, spread_by="fact")
    assert "SortMergeJoin" in found._jdf.queryExecution().executedPlan().toString() and found.count() == 100


def test_who_has_a_better_match_is_not_looked_for_again(spark, monkeypatch):
    """Partners at the same address are more probable than elsewhere, so blocks are not searched for these names."""
    model = LinkageModel(
        prior=0.13, m_name=(0.02, 0.02, 0.01, 0.95), u_name=(0.95, 0.04, 0.0004, 0.0096),
        m_address=(0.4, 0.3, 0.1, 0.2), u_address=(0.8, 0.1, 0.05, 0.05),
    )
    columns = "uid string, denomination_clean string, adresse_clean string"
    left = [(f"l{i}", f"bloc namE {i:03}", "01000 somewhere") for i in range(50)]
    right = [(f"r{i:03}", f"bloc name {i:03}", "01000 somewhere") for i in range(50)]
    vl, vr = (linkage.values(spark.createDataFrame(side, columns)) for side in (left, right))
    assert model.accepts(2, 0) and model.probability(2, 3) > model.probability(2, 0)
    asked = []
    monkeypatch.setattr(linkage, "FEW_TILES", 0)
    first = linkage.first_partners
    monkeypatch.setattr(linkage, "first_partners", lambda l, r, k, *a: asked.append((k, l.count())) or first(l, r, k, *a))
    best = linkage.best_matches(vl, vr, model).collect()
    assert len(best) == 50 and {r.match_probability for r in best} == {model.probability(2, 3)}
    assert (["block"], 0) in asked and (["block"], 50) not in asked


def test_reaching_equals_pairs_one_by_one():
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(45))) for _ in range(60)]
    texts += ["", "x" * 70, "a" * 64, "abca" * 16]
    for threshold in (0.5, 0.7, 0.9):
        got = similarity.reaching(texts, texts[::-1], threshold)
        for i, text in enumerate(texts):
            pairs = similarity.jaro_winkler_pairs(pd.Series([text] * len(texts)), pd.Series(texts[::-1]))
            assert (got[i] == (pairs >= threshold).to_numpy()).all()
