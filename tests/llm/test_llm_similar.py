"""Near-duplicates by a similarity of 0.8 of five-word shingles."""

import random

import numpy as np
import pyarrow as pa

from ledgerline.llm import similar
from ledgerline.llm.tables import stored
from llm_cases import ODD


def slow_set(text):
    found = (text or "").encode().lower().split()
    return frozenset(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))) if found else frozenset()


def slow_groups(rows):
    parent = {s: s for s in {slow_set(t) for _, t in rows}}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a in parent:
        for b in parent:
            if len(a & b) * 5 >= len(a | b) * 4:
                parent[root(a)] = root(b)
    return {s: root(s) for s in parent}


def edited(rng, text, n):
    words = text.split()
    for at in rng.sample(range(len(words)), n):
        words[at] = f"changed{rng.randrange(1000)}"
    return " ".join(words)


def test_survivors_equal_brute_force(spark, documents):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    line = " ".join(rng.choices(vocabulary, k=12))
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(30, 150))) + " " + line for _ in range(40)]
    for t in list(texts):
        texts += [edited(rng, t, n) for n in (1, 1, 2, 3, 6)]
    texts += [texts[0], "a b c", "A  b c", "a b d"]
    rows = list(enumerate(texts, 10)) + ODD
    group = slow_groups(rows)
    best = {}
    for i, t in rows:
        g = group[slow_set(t)]
        best[g] = min(best.get(g, (True, 0)), (i is None, i or 0))
    docs = documents(rows).repartition(3)
    kept = similar.survivors(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == sorted(best.values())


def test_planted_near_copies_are_dropped(spark, documents):
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(500)}" for _ in range(300)) for _ in range(40)]
    near = [edited(rng, t, 5) for t in texts]
    far = [edited(rng, t, 60) for t in texts]
    docs = documents(list(enumerate(texts + near + far)))
    assert {r["doc_id"] for r in similar.survivors(docs).collect()} == {*range(40), *range(80, 120)}


def test_a_large_group_makes_few_pairs(spark, documents):
    rng = random.Random(5)
    base = " ".join(f"w{i}" for i in range(200))
    docs = documents([(i, edited(rng, base, 2)) for i in range(400)])
    nodes = stored(similar.sketches(docs).dropDuplicates(["same"]), "nodes")
    found = stored(similar.links(nodes, docs), "links")
    assert found.count() < 40 * 400
    assert similar.components(found).count() == nodes.count() - 1


def test_buckets_may_span_batches():
    rows = [(band, same, 10 + same) for band in (-5, 0, 7) for same in range(6)] + [(9, 1, 10)]
    for size in (1, 4, 100):
        batches = [pa.RecordBatch.from_pylist([dict(zip(("band", "same", "n"), r)) for r in rows[i : i + size]]) for i in range(0, len(rows), size)]
        got = [tuple(r.values()) for b in similar._stars(iter(batches)) for r in b.to_pylist()]
        assert sorted(got) == [(band, 0, same, 10, 10 + same) for band in (-5, 0, 7) for same in range(1, 6)]


def test_pairs_of_unconnected_sets_are_all_made():
    rng = np.random.default_rng(1)
    rows = [(band, same, 10, int(rng.integers(0, 4))) for band in range(5) for same in range(20)]
    names = ("band", "same", "n", "root")
    want = {(band, a, b) for band in range(5) for _, a, _, r in rows[band * 20 : band * 20 + 20] for _, b, _, s in rows[band * 20 : band * 20 + 20] if a < b and r != s}
    for size in (1, 7, 100):
        batches = [pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows[i : i + size]]) for i in range(0, len(rows), size)]
        got = [tuple(r.values()) for b in similar._rest(iter(batches)) for r in b.to_pylist()]
        assert sorted(got) == sorted((a, b) for _, a, b in want)
