"""The prefix trie against a slow version in plain Python."""

import hashlib
import random
import zlib

import pytest

from ledgerline.llm import prefixtrie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, x1 int, n_turns string"


def slow(rows):
    """Nodes of rebuilt conversations: (conv_id, depth, parent, members, children, leaves, saved, ends)."""
    own = {}
    for c, turn, role, text, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(c, []).append((role or "", text or ""))
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - (abs(c) % 20) * (1 if c >= 0 else -1), [])[:h] + turns[h:]
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids, leaves, saved = {n: 0 for n in members}, {}, {}
    for n in sorted(members, key=len, reverse=True):
        words = len(n[-1][1].encode().split()) if n else 0
        leaves[n] = leaves.get(n, 0) or 1
        saved[n] = saved.get(n, 0) + (len(members[n]) - 1) * words
        if n:
            up = n[:-1]
            kids[up] += 1
            leaves[up] = leaves.get(up, 0) + leaves[n]
            saved[up] = saved.get(up, 0) + saved[n]
    out = []
    for n, of in members.items():
        ends = ",".join(map(str, sorted(c for c in of if len(rebuilt[c]) == len(n))))
        up = min(members[n[:-1]]) if n else None
        out.append((min(of), len(n), up, len(of), kids[n], leaves[n], saved[n], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def cases(seed, n=70):
    rng = random.Random(seed)
    said = [("user", "hello there"), ("assistant", "hi"), ("user", " what now\n then? "), (None, None), ("user", "")]
    rows = []
    for c in rng.sample(range(-30, 120), n):
        for t in range(rng.randint(1, 6)):
            role, text = rng.choice(said) if rng.random() < 0.8 else ("user", f"own {c} {t} \x1c x")
            rows.append((c, rng.choice([None, t, t]), role, text, "a", 1, "b"))
    return rows + rows[:4] + [(None, 0, "user", "nobody", "a", 1, "b")]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def result(spark, rows, **settings):
    nodes = prefixtrie.trie(*prefixtrie.families(frame(spark, rows).repartition(5)), **settings)
    assert nodes.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(r) for r in nodes.collect())


@pytest.mark.parametrize("settings", [{}, {"most": 3, "queued": 5}, {"most": 1, "queued": 2}])
def test_nodes_equal_slow(spark, settings):
    rows = cases(4)
    assert result(spark, rows, **settings) == slow(rows)


def test_hot_beginnings_and_copies(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "IDS_A_PIECE", 7)
    rows = [(c, t, "user", f"turn {t}" if c % 3 else f"turn {t} of {c if t else 0}", "", 0, "") for c in range(200) for t in range(4)]
    assert result(spark, rows, most=20) == slow(rows)


def test_one_long_conversation_is_summed_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "CHUNK", 8)
    rows = [(20, t, "user", f"turn {t % 5}", "", 0, "") for t in range(100)] + [(c, t, "user", f"turn {t % 5}", "", 0, "") for c in (21, 22, 40) for t in range(60)]
    assert result(spark, rows, most=2, queued=3) == slow(rows)


def test_long_texts_and_no_rows(spark):
    rows = [(c, 0, "user", "word " * 1_000_000, "", 0, "") for c in (1, 2, 3)]
    assert result(spark, rows) == slow(rows)
    assert result(spark, []) == []
    assert result(spark, [(None, 1, "user", "x", "", 0, "")]) == []


def test_queue_spills_in_order():
    rng = random.Random(1)
    queue, got, inside = prefixtrie.SpillingQueue(10), [], []
    for i in range(500):
        item = (rng.randrange(100), i)
        queue.push(item)
        inside.append(item)
        if i % 3 == 0:
            assert queue.least() == min(inside)
            got.append(queue.pop())
            inside.remove(got[-1])
    while queue.least():
        got.append(queue.pop())
    assert sorted(got) == sorted([*got]) and got[-len(inside) :] == sorted(inside)
    assert len(got) == 500
