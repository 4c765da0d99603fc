"""Hard negatives against a slow version in plain Python, and the parts of the block search."""

import math
import random

import numpy as np
import pytest

from ledgerline.llm import hardneg

SCHEMA = "vec_id bigint, embedding array<float>, label int, place string, block int, v string"


def slow(rows, anchors=100, k=5):
    usable = {}
    for i, x, label in rows:
        if i is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        row = ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(c))) for c in x])
        usable[i] = min(usable.get(i, row), row)
    out = []
    for a in usable:
        if a % anchors:
            continue
        scored = [(-sum(p * q for p, q in zip(usable[a][1], v)), i, label == usable[a][0]) for i, (label, v) in usable.items() if i != a]
        scored.sort()
        for s, p, _ in [x for x in scored if x[2]][:k]:
            fits = [x for x in scored if not x[2] and 80 * -s <= 100 * -x[0] <= 100 * -s][:k]
            out += [(a, p, rank, i, -s, -t) for rank, (t, i, _) in enumerate(fits, 1)]
    return sorted(out)


def cases(seed, n=1500, dims=6, anchors=50):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(12)]
    rows = []
    for i in range(n):
        centre = rng.choice(centres)
        rows.append((i, [c + rng.gauss(0, 0.3) for c in centre], rng.randrange(10)))
    copy = rows[3][1]
    rows += [(2000 + i, copy, i % 3) for i in range(200)]  # ties
    odd = [(None, copy, 1), (5000, None, 1), (5100, copy, None), (5200, [float("nan")] * dims, 1), (5300, [float("inf"), *copy[1:]], 2), (5400, [None, *copy[1:]], 2)]
    return rows + odd + [(5500, copy[:2], 1), (5600, [], 4), (5700, [0.0] * dims, 5), rows[0], (2001, rows[9][1], 8)]


def frame(spark, rows):
    return spark.createDataFrame([(i, x, label, "", 0, "") for i, x, label in rows], SCHEMA)


@pytest.mark.parametrize("settings", [{}, {"block_cells": 120, "segment_blocks": 3, "wave_bytes": 200}, {"block_cells": 20, "segment_blocks": 50}])
def test_negatives_equal_slow(spark, settings):
    rows = cases(2)
    docs = hardneg.mislabelled(frame(spark, rows).repartition(3))
    got = hardneg.mined(docs, lambda i: i % 100 == 0, **settings)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = slow(rows)
    assert sorted(map(tuple, got.collect())) == want
    assert len({w[0] for w in want}) > 15


def test_bounds_leave_blocks_unread(spark):
    rng = random.Random(4)
    rows = [(i, [math.cos(t := rng.random() * 6.28), math.sin(t)], i % 2) for i in range(4000)]
    usable = hardneg.candidates(frame(spark, rows))
    blocks = hardneg.write_blocks(usable, block_cells=64, segment_blocks=2)
    zones = blocks.read(spark, ["lo", "hi"]).collect()
    one = np.array([0])
    v = np.array([[256, 0]])
    window = hardneg.Windows(one, one, v, one, one, one + 100 * 60_000, one + 100 * 65_536, one + hardneg.NO_SCORE, False, 5)
    needed = sum(bool(window.needs(np.array(z["lo"]), np.array(z["hi"]))[0]) for z in zones)
    assert len(zones) >= 100 and 0 < needed < len(zones) / 4


def test_no_rows_no_anchors(spark):
    assert hardneg.mined(frame(spark, []), hardneg.every_hundredth).collect() == []
    assert hardneg.mined(frame(spark, [(1, [1.0], 2), (3, [], 2)]), hardneg.every_hundredth).collect() == []
    assert hardneg.mined(frame(spark, [(100, [1.0], 2)]), hardneg.every_hundredth).collect() == []


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2), (4, 2), (1, 4)])
def test_neighbours_on_the_curve_are_neighbours(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
    keys = hardneg.hilbert_keys(cells, bits)
    walk = cells[np.array(sorted(range(len(keys)), key=keys.__getitem__))]
    assert len(set(keys)) == len(cells)
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()
