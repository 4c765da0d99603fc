"""The pipeline's stages against a small corpus with planted cases."""

import random

import pytest

import corpus_pipeline
from ledgerline.llm import neardup

NAMES = [name for name, _ in corpus_pipeline.STAGES]


def sentence(rng, words=60):
    syllables = ["tion", "the", "ing", "er", "an", "re", "st", "en", "at", "or"]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(words))


def within_radius(a, b):
    return a != b and (neardup.fingerprint(a.encode()) ^ neardup.fingerprint(b.encode())).bit_count() <= neardup.RADIUS


@pytest.fixture
def corpus(spark, tmp_path):
    rng = random.Random(7)
    clean = {i: sentence(rng) for i in range(40)}
    item = sentence(rng, 15)
    words = clean[7].split()
    near = next(t for i in range(1000) if within_radius(clean[7], t := " ".join([*words[:-1], f"the{i}"])))
    planted = {
        100: clean[3],  # exact copies
        101: clean[3],
        102: f"{clean[5][:200]} {item} {clean[6][:200]}",  # a passage of the benchmark
        103: "too short",
        104: " ".join(w + "***" for w in sentence(rng).split()),
        105: "1234 5678 " + " ".join(str(rng.randrange(10**6)) for _ in range(60)),  # no letter
        106: None,
        107: "",
        109: near,
        108: " ".join(["again and again the same words come back to us"] * 20),
    }
    rows = [(i, t, "en", f"s{i % 3}", len(t or ""), "x") for i, t in {**clean, **planted}.items()]
    rows += [rows[0], (None, None, None, None, None, "x")]  # a repeated row, and one of nulls
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item), (2, None)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), clean


def test_stages_are_in_order():
    assert NAMES == ["quality_rules", "language_id", "near_duplicates", "decontamination", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_each_stage_drops_what_is_planted_for_it(spark, corpus, tmp_path):
    sf_dir, clean = corpus
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = {"quality_rules": {103, 104, 106, 107, 108, None}, "language_id": {105}, "near_duplicates": {100, 101, 109}, "decontamination": {102}}
    left = {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == docs.columns
        after.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        left -= want[name]
        assert {r["doc_id"] for r in docs.collect()} == left, name
        assert docs.where("doc_id = 0").count() == (2 if name in NAMES[:2] else 1)
    assert left == set(clean)


def test_run_packs_what_is_left(spark, corpus):
    sf_dir, clean = corpus
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    assert {p["doc_id"] for p in pieces} == set(clean)
    ends = sorted((p["sequence_id"], p["offset"], p["length"]) for p in pieces)
    assert [o for _, o, _ in ends] == [sum(n for s, _, n in ends[:i] if s == ends[i][0]) for i in range(len(ends))]


def test_an_empty_corpus_passes(spark, corpus, tmp_path):
    sf_dir, _ = corpus
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).collect() == []
    assert corpus_pipeline.pack(spark, docs, sf_dir).collect() == []
