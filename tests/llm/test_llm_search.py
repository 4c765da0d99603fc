"""Decontamination, near-duplicates and URL filters against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from llm_cases import ODD

from ledgerline.llm import decontaminate, neardup, urlfilter

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def brute(docs, items, size):
    out = []
    for i, text in docs:
        words = WORD.findall(lower(text or ""))
        hit, found = set(), set()
        for item, passage in items:
            w = WORD.findall(lower(passage or ""))
            for k in range(max(1, len(w) - size + 1) if w else 0):
                window = w[k : k + size]
                for p in range(len(words) - len(window) + 1):
                    if words[p : p + len(window)] == window:
                        hit |= set(range(p, p + len(window)))
                        found.add(item)
        out.append((i, len(words), len(hit), sorted(found)))
    return out


def test_terms_are_the_words_of_the_pattern():
    text = "Ab-c 12 É_x·y{z} \x7f ß\n"
    assert [t.decode() for t in decontaminate.terms_of(text.encode())] == WORD.findall(lower(text))


def test_numbers_pack_and_unpack():
    values = np.array([0, 1, 127, 128, 16383, 16384, 1 << 21, (1 << 32) - 1])
    data, ends = decontaminate.pack_numbers(values)
    assert decontaminate.unpack_numbers(data.tobytes()).tolist() == values.tolist() and ends[-1] == len(data)
    assert len(decontaminate.unpack_numbers(b"")) == 0


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_phrases_equal_brute_force(spark, documents, prose, block_bytes):
    texts = list(enumerate(prose(60, most=80, words=4), 100)) + ODD
    items = [(f"q{i}", t) for i, t in enumerate(prose(8, most=12, words=4, seed=9))] + [("none", None), ("blank", "--"), ("one", "one")]
    postings = decontaminate.index(documents(texts).repartition(3))
    found = decontaminate.search(postings, spark.createDataFrame(items, "item_id string, text string"), window=5, block_bytes=block_bytes)
    got = sorted(((r["doc_id"], r["n_words"], decontaminate_hits(r), sorted({m["item_id"] for m in r["matches"]})) for r in found.collect()), key=repr)
    assert got == sorted(brute(texts, items, 5), key=repr)
    digest = {r["doc_id"]: r for r in decontaminate.contamination(found).collect()}
    for i, n, hits, listed in brute(texts[:60], items, 5):
        assert (digest[i]["n_words"], digest[i]["n_hit"], digest[i]["n_items"], digest[i]["contaminated"]) == (n, hits, len(listed), hits > 0)


def decontaminate_hits(row):
    return len({p for m in row["matches"] for p in range(m["first"], m["last"] + 1)})


def test_proximity_tolerates_moved_words(spark, documents):
    docs = documents([(1, "a b x c d"), (2, "a b c d"), (3, "d c b a"), (4, "a b x x x c d")])
    items = spark.createDataFrame([(7, "a b c d")], "item_id int, text string")
    postings = decontaminate.index(docs)
    found = {s: sorted(r["doc_id"] for r in decontaminate.search(postings, items, slop=s).where("size(matches) > 0").collect()) for s in (0, 1, 3)}
    assert found == {0: [2], 1: [1, 2], 3: [1, 2, 4]}
    with pytest.raises(ValueError):
        decontaminate.search(postings, items, slop=40)


def test_search_of_empty_tables(spark, documents):
    items = spark.createDataFrame([], "item_id long, text string")
    assert [len(r["matches"]) for r in decontaminate.search(decontaminate.index(documents(ODD)), items).collect()] == [0] * len(ODD)
    some = spark.createDataFrame([(1, "x")], "item_id long, text string")
    assert decontaminate.contamination(decontaminate.search(decontaminate.index(documents([])), some)).collect() == []


def slow_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower(text or "")) if w]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots_of(values, radius):
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a in parent:
        for b in parent:
            if (a ^ b).bit_count() <= radius:
                parent[root(a)] = root(b)
    return {v: root(v) for v in parent}


@pytest.mark.parametrize("most", [256, 2])
def test_near_duplicates_equal_brute_force(spark, documents, prose, most):
    rng = random.Random(4)
    texts = [t for t in prose(60, most=50, words=300) if t]
    for t in list(texts):  # near copies of near copies
        words = t.split(" ")
        for _ in range(2):
            words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
    rows = list(enumerate(texts, 10)) + ODD
    prints = [(i, slow_fingerprint(t)) for i, t in rows]
    root = roots_of({f for _, f in prints}, 3)
    least = {}
    for i, f in prints:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    want = sorted(((i, f"{f:016x}", least.get(root[f])) for i, f in prints), key=repr)
    docs = documents(rows)
    assert sorted(map(tuple, neardup.near_duplicates(docs, most=most).collect()), key=repr) == want
    kept = neardup.survivors(docs, most=most)
    assert kept.columns == docs.columns
    assert len(kept.collect()) == len(set(root.values()))
    assert {r["doc_id"] for r in kept.collect()} >= set(least.values())


def test_covering_masks_lose_no_pair_within_the_radius():
    rng = random.Random(6)
    for bits in (list(range(64)), sorted(rng.sample(range(64), 17)), [3, 9]):
        masks = neardup.covering(bits, 3)
        for _ in range(2000):
            flipped = sum(1 << b for b in rng.sample(bits, min(len(bits), rng.randint(1, 3))))
            assert any(not flipped & m for m in masks)


def test_a_dense_group_is_linked_without_all_pairs(spark):
    centre = 0x0123456789ABCDEF
    close = {centre} | {centre ^ 1 << a ^ 1 << b for a in range(64) for b in range(a)}
    far = {centre ^ (0xFFFF << 20) ^ 1 << a for a in range(64)}
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in close | far]
    nodes = spark.createDataFrame(signed, "fingerprint bigint")
    pairs = neardup.near_pairs(nodes, most=16)
    assert pairs.count() < 15 * 15 * len(signed)
    labels = {r["node"]: r["root"] for r in neardup.components(pairs).collect()}
    assert len({labels.get(v, v) for (v,) in signed}) == 2


def test_components_of_a_chain_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(300)] + [(5, 5)]
    rows = neardup.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in rows} == {**dict.fromkeys(range(1, 201), 0), **dict.fromkeys(range(1001, 1300), 1000)}


def test_cascade_is_exact(spark):
    rng = random.Random(1)
    keys = [f"k{i}" for i in range(4000)]
    listed = set(rng.sample(keys, 300)) | {"not in the universe"}
    frame = lambda ks: spark.createDataFrame([(k,) for k in ks], "key string")
    levels = urlfilter.cascade(frame([*listed, None]), frame([*keys, *keys[:50], None]))
    assert len(levels) > 1
    universe = frame([*keys, None])
    got = {r["key"] for r in universe.where(urlfilter.listed_in(universe["key"], levels)).collect()}
    assert got == listed & set(keys)
    assert {r["key"] for r in urlfilter.listed_by_join(universe, frame(listed)).collect()} == got
    assert urlfilter.cascade(frame([]), frame(keys)) == []


def test_rules_of_urls(spark):
    rules = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "bare": "block"}
    urls = [
        ("http://A.example.ORG/es/x?q", "a.example.org", "/es/x", "example.org/es/", "block"),
        ("x://example.org/en/123", "example.org", "/en/123", "example.org/en/1", "block"),
        ("x://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        ("x://example.org", "example.org", "", None, "allow"),
        ("x://a.bare#f", "a.bare", "", "bare", "block"),
        ("http://spam.net/p#1", "spam.net", "/p", None, "block"),
        ("http://spam.net/q", "spam.net", "/q", None, "allow"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, u[0], "x") for i, u in enumerate(urls)] + [(0, urls[0][0], "y")], "page_id long, url string, rule string")
    blocked = spark.createDataFrame([("spam.net/p",), ("spam.net/p",), (None,)], "key string")
    got = sorted(map(tuple, urlfilter.judge(pages, rules, blocked).collect()))
    assert got == sorted([(i, *u[1:]) for i, u in enumerate(urls)] + [(0, *urls[0][1:])])
    assert urlfilter.judge(pages.limit(0), rules, blocked.limit(0)).collect() == []


def test_spam_pages(spark):
    pages = spark.createDataFrame([("http://H/a", "***bad***"), ("http://h/b", "plain text"), (None, "***"), ("http://h/c", None)], "url string, html string")
    assert [r["key"] for r in urlfilter.spam_keys(pages).collect()] == ["h/a"]
