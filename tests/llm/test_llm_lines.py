"""Line deduplication against a slow version in plain Python."""

import hashlib
import random

import pytest

from ledgerline.llm import linededup
from llm_cases import ODD

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow(rows):
    order = lambda i: (i is not None, i or 0)
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders.setdefault(line.strip(SPACE).translate(LOWER), set()).add(i)
    out = []
    for i, t in rows:
        lines, kept = (t or "").split("\n"), []
        for line in lines:
            of = holders[k := line.strip(SPACE).translate(LOWER)]
            if len(k) < 20 or len(of) < 3 or i == max(of, key=order):
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def cases(seed, n=60):
    rng = random.Random(seed)
    common = [f"this is a line {'of Ünïcode ' * (i % 2)}that many texts have {i}" for i in range(8)]
    rows = []
    for i in range(n):
        lines = [rng.choice([rng.choice(common), rng.choice(common).upper(), f"  {rng.choice(common)}\t", f"own line of this document {i} {rng.random()}", "short", ""]) for _ in range(rng.randint(0, 9))]
        rows.append((i, "\n".join([*lines, common[0] if i % 3 else "x"])))
    return rows + [rows[5], (5, common[1]), (None, common[2]), (None, f"{common[2]}\n{common[0]}"), (-7, "\n\n"), (99, "\n".join(common[:3] * 4))] + ODD


@pytest.mark.parametrize("most_hot", [1000, 12])
def test_digest_equals_slow(spark, documents, most_hot):
    rows = cases(3)
    docs = documents(rows).repartition(5)
    if most_hot == 12:
        assert linededup.hot_keys(linededup.line_hashes(docs), 12)
    got = linededup.line_digest(docs, most_hot=most_hot).collect()
    want = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in slow(rows)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert any(d for _, _, d, _ in want)


def test_texts_and_columns_stay(spark, documents):
    rows = cases(8)
    docs = documents(rows).withColumnRenamed("n_chars", "_dropped").withColumnRenamed("score", "version")
    after = linededup.deduplicated(docs)
    assert after.schema.simpleString() == docs.schema.simpleString()
    want = [(i, t if d or text is not None else None) for (i, _, d, t), (_, text) in zip(slow(rows), rows, strict=True)]
    assert sorted(((r["doc_id"], r["text"]) for r in after.collect()), key=repr) == sorted(want, key=repr)


def test_bitmaps_are_runs(spark, documents):
    line = "a line that is long enough to count"
    docs = documents([(1, f"one\n{line}\n{line}\ntwo\n{line}"), (2, line), (3, f"{line}\n{line}"), (4, None)])
    found = {r["doc_id"]: r for r in linededup.keep_bitmaps(docs).collect()}
    assert [tuple(run) for run in found[1]["kept"]] == [(0, 1), (3, 1)]
    assert found[2]["kept"] == [] and found[2]["n_dropped"] == 1
    assert [tuple(run) for run in found[3]["kept"]] == [(0, 2)]
    assert (found[4]["n_lines"], found[4]["n_dropped"]) == (1, 0)


def test_long_texts_and_no_rows(spark, documents):
    line = "the same line again and again in it"
    long = "\n".join([line, "x" * 5_000_000, *[f"{line} {i}" for i in range(50_000)]])
    rows = [(1, long), (2, line), (3, line), (4, long), (5, long)]
    got = linededup.line_digest(documents(rows)).collect()
    want = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in slow(rows)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert linededup.line_digest(documents(rows).limit(0)).collect() == []


def test_no_python_in_the_plan(spark, documents):
    plan = linededup.line_digest(documents(cases(1)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
