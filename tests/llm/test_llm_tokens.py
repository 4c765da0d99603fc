"""Token ids, token files, packing and counts that follow edits."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_cases import ODD
from tokenizers import Tokenizer

from ledgerline.llm import packing, tokencounts, tokenfile
from ledgerline.llm.encoder import WordEncoder
from ledgerline.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text, end):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_equals_the_tokenizer(tokenizer):
    rng = random.Random(3)
    letters = "aB'é ×.,<|>9́  İ\n\t½ſK😀endoftext ÀßÞ"
    texts = ["a<|endoftext|>b", "it's 's!'ll", "", " ", "word,.!x", "ÉCOLE, ÇA!"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    encoder = WordEncoder(PATH, most_words=500)  # forgets on the way
    for i in range(0, len(texts), 100):
        ids, counts = encoder.encode([t.encode() for t in texts[i : i + 100]])
        found = np.split(ids, np.cumsum(counts)[:-1])
        for text, got in zip(texts[i : i + 100], found):
            assert got.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_encoder_refuses_tokenizers_that_keep_white_space():
    with pytest.raises(ValueError):
        WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))


def written(spark, docs):
    path = scratch_path(spark, "tokens")
    tokenfile.write_tokens(docs, path, PATH, end=1)
    return path


def test_token_files_round_trip(spark, documents, prose, tokenizer):
    rows = list(enumerate(prose(300)))
    random.Random(1).shuffle(rows)
    path = written(spark, documents(rows).repartition(5))
    back = {r["doc_id"]: list(r["tokens"]) for r in tokenfile.read_tokens(spark, path).collect()}
    start = 0
    digest = {r["doc_id"]: r for r in tokenfile.token_digest(tokenfile.read_tokens(spark, path)).collect()}
    for i, text in sorted(rows):
        ids = ids_of(tokenizer, text, 1)
        assert back[i] == ids
        assert (digest[i]["start"], digest[i]["n_tokens"], digest[i]["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)
    assert [r["doc_id"] for r in tokenfile.read_tokens(spark, path, only=[7, 250, 999]).orderBy("doc_id").collect()] == [7, 250]
    files = tokenfile.read_tokens(spark, path).selectExpr("file_no", "doc_id").groupBy("file_no").agg({"doc_id": "min"}).orderBy("file_no").collect()
    assert [f[1] for f in files] == sorted(f[1] for f in files)


def test_token_files_of_odd_rows(spark, documents, tokenizer):
    got = tokenfile.token_digest(tokenfile.read_tokens(spark, written(spark, documents(ODD)))).collect()
    assert sorted(r["ids_crc32"] for r in got) == sorted(crc(ids_of(tokenizer, t, 1)) for _, t in ODD)
    spans = sorted((r["start"], r["n_tokens"]) for r in got)
    assert [s for s, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]
    assert tokenfile.token_digest(tokenfile.read_tokens(spark, written(spark, documents([])))).collect() == []


def check_packing(pieces, texts, tokenizer, sequence):
    """Every id in one piece, sequences gapless and full but the last."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for i, text in texts:
        ids = ids_of(tokenizer, text, 2)
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"], p["ids_crc32"]) == (at, len(ids), crc(ids[at : at + p["length"]]))
            at += p["length"]
        assert at == len(ids)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for number, runs in by_sequence.items():
        at = 0
        for offset, length in sorted(runs):
            assert offset == at
            at += length
        assert at == sequence or number == len(by_sequence) - 1 and at <= sequence


@pytest.mark.parametrize("mixture", [None, {"a": 1, "b": 1, "c": 5}, {"c": 1}])
def test_packing(spark, prose, tokenizer, mixture):
    rng = random.Random(2)
    texts = list(enumerate(prose(200)))
    docs = spark.createDataFrame([(i, t, rng.choice(["a", "a", "a", "b", "c", None])) for i, t in texts], "doc_id bigint, text string, source string")
    pieces = packing.pack(packing.encode_queues(docs.repartition(4), PATH, 2), mixture, sequence=32, window=4).collect()
    check_packing(pieces, texts, tokenizer, 32)


def test_windows_hold_the_mixture(spark, prose):
    docs = spark.createDataFrame([(i, t, "ab"[i % 3 == 0]) for i, t in enumerate(prose(300))], "doc_id bigint, text string, source string")
    pieces = packing.pack(packing.encode_queues(docs.repartition(3), PATH, 2), sequence=64, window=2).toPandas()
    pieces["source"] = ["ab"[i % 3 == 0] for i in pieces["doc_id"]]
    share = pieces.groupby("source")["length"].sum() / pieces["length"].sum()
    pieces["window"] = pieces["sequence_id"] // 2
    per_window = pieces.groupby(["window", "source"])["length"].sum().unstack(fill_value=0)
    done = per_window.iloc[:-1]
    assert len(done) > 20
    for source in "ab":
        assert (done[source].cumsum() - share[source] * 128 * np.arange(1, len(done) + 1)).abs().max() < 1


def test_packing_of_odd_rows(spark, documents, tokenizer):
    pieces = packing.pack(packing.encode_queues(documents(ODD), PATH, 2), sequence=8, window=2).collect()
    assert sum(p["length"] for p in pieces) == sum(len(ids_of(tokenizer, t, 2)) for _, t in ODD)
    assert packing.pack(packing.encode_queues(documents([]), PATH, 2)).collect() == []


def test_schedule_gives_every_token_once():
    for totals, weights in (([5, 0, 90], [1, 1, 1]), ([100, 7, 33], [0, 2, 1]), ([1], [0]), ([64, 64], [3, 5])):
        stretches = packing.schedule(totals, weights, 16)
        places = sorted((q, n) for s, t in enumerate(totals) for _, n, q in packing.placed(stretches, s, 0, t))
        assert [q for q, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
        assert sum(n for _, n in places) == sum(totals)


def test_counts_follow_edits(tokenizer):
    rng = random.Random(8)
    encoder = WordEncoder(PATH)
    count = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    for _ in range(300):
        text = "".join(rng.choice("ab c\nd é.") for _ in range(rng.randint(0, 300)))
        leaves = tokencounts.leaves_of(text, 8)
        assert "".join(leaves) == text
        tree = tokencounts.Tree.of([len(x) for x in leaves], [count(x) for x in leaves])
        for _ in range(3):  # edits of edits
            edits = [(rng.randint(0, len(text) + 3), rng.randint(0, 12), rng.choice(["", "x", " ", "new words", "y z "])) for _ in range(rng.randint(0, 5))]
            edits = tokencounts.ordered(edits, len(text))
            tokencounts.recount(tree, text, edits, encoder)
            text = tokencounts.edited(text, edits)
            assert (tree.tokens[1], tree.chars[1]) == (count(text), len(text))
            level = tree.size
            assert all(tree.tokens[i] == tree.tokens[2 * i] + tree.tokens[2 * i + 1] for i in range(1, level))


def test_an_edit_recounts_its_surroundings_only(spark, documents, tokenizer):
    text = " ".join(f"word{i}" for i in range(20_000)) + "\nme@example.com\n" + "same line\n" * 3
    docs = documents([(1, text), (2, "plain"), *ODD])
    trees = tokencounts.count_tokens(docs, PATH)
    got = tokencounts.apply_edits(trees, tokencounts.cleaned(docs), PATH)
    row = got.where("doc_id = 1 AND n_chars > 9").first()
    want = " ".join(f"word{i}" for i in range(20_000)) + "\n<EMAIL>\nsame line\n"
    assert row["text"] == want and row["n_edits"] == 3
    assert row["n_edited"] == len(tokenizer.encode(want, add_special_tokens=False).ids)
    assert row["n_recounted"] < 5 * tokencounts.LEAF_CHARS
    assert got.count() == len({(i, t or "") for i, t in ODD}) + 2
    assert tokencounts.apply_edits(tokencounts.count_tokens(documents([]), PATH), tokencounts.cleaned(documents([])), PATH).collect() == []
