"""Contexts of LM scoring are the words themselves."""

import math
import random
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import mixing
from ledgerline.llm.tables import stored

TRAINED = [i for i in range(200) if not mixing.held_out(i, 7, 2)]
HELD = [i for i in range(200) if mixing.held_out(i, 7, 2)]


def test_words_of_one_hashed_slot_are_different_contexts(spark, documents):
    seen = {}
    for letters in product("abcdefghij", repeat=5):  # equal endings, so equal classes
        w = "".join(letters) + "aaa"
        if (other := seen.setdefault(zlib.crc32(w.encode()) % 4096, w)) != w:
            break
    x, y = "xxx", next(y for y in ("yyy", "zzz", "vvv") if mixing.code_of(y.encode()) % 64 != mixing.code_of(b"xxx") % 64)
    rows = [(TRAINED[0], f"{other} {x} " * 50), (TRAINED[1], f"{w} {y} " * 50), (HELD[0], f"{other} {x} " * 5), (HELD[1], f"{w} {x} " * 5)]
    got = {r["doc_id"]: r for r in mixing.scores(documents(rows)).collect()}
    assert got[HELD[0]]["base_score"] == got[HELD[1]]["base_score"]
    assert got[HELD[0]]["score"] > got[HELD[1]]["score"] + 0.5


def test_contexts_are_counted_over_all_segments(spark, documents, monkeypatch):
    rng = random.Random(2)
    rows = [(i, " ".join(f"w{rng.randrange(3000) if rng.random() < 0.5 else rng.randrange(5)}" for _ in range(200))) for i in range(100)]
    want = {}
    for i, t in rows:
        if not mixing.held_out(i, 7, 2):
            words = ["", *t.split(), ""]
            for a, b in zip(words, words[1:]):
                want.setdefault(a, Counter())[mixing.code_of(b.encode())] += 1
    parts = stored(mixing.segments(documents(rows).repartition(5)), "segments")
    terms = {(r["segment"], r["number"]): bytes(r["term"]).decode() for r in parts.where("kind = 'word'").collect()}
    known = mixing.known_words(parts).collect()
    assert {terms[r["segment"], r["number"]] for r in known} == set(want)
    assert sum(r["first"] for r in known) == len(want)
    for r in known:
        values, _ = mixing.unpacked(pa.array([bytes(r["next"])], pa.binary()))
        assert {v % 64: v >> 6 for v in values.tolist()} == want[terms[r["segment"], r["number"]]]
        assert sum(want[terms[r["segment"], r["number"]]].values()) == r["c"]


def test_packed_lists_are_restored():
    rng = random.Random(7)
    lists = [[rng.randrange(1 << rng.randrange(1, 50)) for _ in range(rng.randrange(5))] for _ in range(300)] + [[], [0], []]
    flat = np.array([v for x in lists for v in x], np.int64)
    ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    array = mixing.packed(flat, ends)
    for begin, size in ((0, 303), (100, 50), (302, 1), (5, 0)):
        values, owner = mixing.unpacked(array.slice(begin, size))
        got = [values[owner == i].tolist() for i in range(size)]
        assert got == lists[begin : begin + size]
    assert len(mixing.packed(np.zeros(0, np.int64), np.zeros(1, np.int64))) == 0


def coded(text):
    """Words of a text with its end, and the class of each."""
    words = [*text.encode().lower().split(), b""]
    return words, [mixing.code_of(w) % mixing.CLASSES for w in words]


def contexts(words, classes, k):
    """What stands before the token ``k``: nothing, one class, two classes, the word."""
    last, second = ([*classes[:k][::-1], 0, 0])[:2]
    return ("none",), ("class", last), ("classes", last, second), ("word", words[k - 1] if k else b"")


def path(cls):
    """Each bit of a class with the bits before it."""
    bits = f"{cls:0{mixing.CLASS_BITS}b}"
    return [(bits[:i], int(b)) for i, b in enumerate(bits)]


def slow_scores(rows):
    """Scores by one text, one token and one bit after another, in plain Python."""
    counts, seen = Counter(), Counter()
    for i, text in rows:
        words, classes = coded(text)
        if not mixing.held_out(i, 7, 2):
            counts.update(words)
            seen.update((c, p, b) for k, cls in enumerate(classes) for c in contexts(words, classes, k) for p, b in path(cls))
    members = Counter()
    for w, n in counts.items():
        members[mixing.code_of(w) % mixing.CLASSES] += n + 1

    def odds(context, prefix):
        if context[0] == "word" and context[1] not in counts:
            return 0.0
        return math.log((seen[context, prefix, 1] + 0.4) / (seen[context, prefix, 0] + 0.4))

    out = {}
    for i, text in rows:
        words, classes = coded(text)
        total, own = 0.0, {}
        weights = [[0.3] * 6 for _ in range(mixing.CLASS_BITS)]
        half = mixing.STEPS // 2
        tables = [[1 / (1 + math.exp(half - s)) for s in range(mixing.STEPS)] for _ in range(mixing.CLASS_BITS)]
        for k, (w, cls) in enumerate(zip(words, classes)):
            total += math.log10((counts[w] + 1) / (members[cls] + 1))
            for place, (prefix, bit) in enumerate(path(cls)):
                mine = own.get(prefix, 0.5)
                x = [*(odds(c, prefix) for c in contexts(words, classes, k)), math.log(mine / (1 - mine)), 1.0]
                dot = sum(a * b for a, b in zip(weights[place], x))
                mixed = min(max(1 / (1 + math.exp(-dot)), mixing.LEAST), 1 - mixing.LEAST)
                step = round(min(max(dot, -half), half)) + half
                refined = tables[place][step]
                p = (mixed + refined) / 2
                total += math.log10(p if bit else 1 - p)
                weights[place] = [a + mixing.RATE * (bit - mixed) * b for a, b in zip(weights[place], x)]
                own[prefix] = min(max(mine + mixing.LOCAL_RATE * (bit - mine), 0.01), 0.99)
                tables[place][step] += mixing.TABLE_RATE * (bit - refined)
        out[i] = total
    return out


def test_scores_equal_a_slow_version(spark, documents):
    rng = random.Random(11)
    rows = [(i, " ".join(f"w{int(rng.expovariate(0.1))}{rng.choice('ab')}" for _ in range(rng.randrange(80)))) for i in range(60)]
    rows += [(1001, "Same same SAME"), (1002, ""), (1003, "  "), (1004, "é ß unheard")]
    got = {r["doc_id"]: r for r in mixing.scores(documents(rows).repartition(3)).collect()}
    want = slow_scores(rows)
    assert {r["held_out"] for r in got.values()} == {True, False}
    assert {i: r["score"] for i, r in got.items()} == pytest.approx(want, rel=1e-3)
    for i, text in rows:
        assert got[i]["bits_per_byte"] == pytest.approx(-got[i]["score"] * math.log2(10) / max(1, len(text.encode())))


def test_probabilities_of_all_next_words_are_one(spark, documents):
    """Whatever word comes first, the probabilities of the known ones and of one that is unknown in each class sum to one."""
    rows = [(i, t) for i, t in zip(TRAINED, ["a b c a", "b c d", "a a e f g"])]
    words = sorted({w for _, t in rows for w in t.split()})
    unknown, at = {}, 0
    while len(unknown) < mixing.CLASSES:
        unknown.setdefault(mixing.code_of(f"{at:03d}".encode()) % mixing.CLASSES, f"{at:03d}")
        at += 1
    model = mixing.train(parts := stored(mixing.segments(documents(rows)), "segments"), mixing.known_words(parts))
    codes = np.array([mixing.code_of(w.encode()) % mixing.CLASSES for w in (*words, *unknown.values(), "")])
    counts = np.array([*(sum(t.split().count(w) for _, t in rows) for w in words), *[0] * mixing.CLASSES, len(rows)])
    n = len(codes)
    zero, none = np.zeros(n, np.int64), np.zeros((1, mixing.CLASSES), np.float32)
    _, _, score = model.score(np.arange(n), counts, codes, np.ones(n, np.int64), zero, none)
    assert (10.0**score).sum() == pytest.approx(1, rel=1e-4)
