import datetime as dt
import random

import pytest

from ledgerline.operators import quality, scd2
from ledgerline.operators.keys import dedup
from ledgerline.schemas import struct_of

ROW = "uid string, who string, amount double, note string"
LAYOUT = struct_of(f"{ROW}, valid_from date, valid_to date, is_current boolean")
KEYS, TRACKED = ["uid", "who"], ["amount"]


def frame(spark, *data):
    return spark.createDataFrame(list(data), struct_of(ROW))


def apply(spark, gold, data, run_date, **options):
    after = scd2.scd2_apply(gold, frame(spark, *data), KEYS, TRACKED, run_date, **options)
    return spark.createDataFrame(after.collect(), LAYOUT)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], LAYOUT)


def test_versions(spark, empty, rows, day):
    first = [("a", "x", 1.0, "n"), ("b", None, None, "n"), ("c", "x", 3.0, "n"), ("d", "x", 4.0, "n")]
    gold = apply(spark, empty, first, day(1))
    assert rows(gold, "uid", "valid_from", "valid_to", "is_current") == [
        (k, day(1), None, True) for k in "abcd"
    ]
    second = [
        ("a", "x", 1.0, "other note"),  # not tracked
        ("b", None, 2.0, "n"),  # NULL to value under a NULL key column
        ("c", "x", None, "n"),  # value to NULL
        ("e", "x", 5.0, "n"),  # new; d is absent
    ]
    gold = apply(spark, gold, second, day(2))
    assert rows(gold, "uid", "amount", "note", "valid_from", "valid_to", "is_current") == sorted(
        [
            ("a", 1.0, "n", day(1), None, True),
            ("b", None, "n", day(1), day(2), False),
            ("b", 2.0, "n", day(2), None, True),
            ("c", 3.0, "n", day(1), day(2), False),
            ("c", None, "n", day(2), None, True),
            ("d", 4.0, "n", day(1), None, True),
            ("e", 5.0, "n", day(2), None, True),
        ],
        key=repr,
    )
    again = apply(spark, gold, second, day(3))
    assert rows(again) == rows(gold)


def test_joint_award_keeps_both_winners(spark, empty, rows, day):
    award = [("m", "x", 1.0, "n"), ("m", "y", 1.0, "n")]
    gold = apply(spark, empty, award, day(1))
    gold = apply(spark, gold, award, day(2))
    assert rows(gold, "who", "valid_from", "is_current") == [
        ("x", day(1), True), ("y", day(1), True),
    ]


def test_duplicate_input_keys_give_one_version(spark, empty, rows, day):
    gold = apply(spark, empty, [("a", "x", 2.0, "n"), ("a", "x", 1.0, "n")], day(1))
    assert rows(gold, "uid", "amount") == [("a", 1.0)]


def test_same_day_rerun(spark, empty, rows, day):
    gold = apply(spark, empty, [("a", "x", 1.0, "n")], day(1))
    changed = [("a", "x", 2.0, "n")]
    strict = apply(spark, gold, changed, day(1))
    assert rows(strict, "amount", "valid_from", "valid_to") == [
        (1.0, day(1), day(1)), (2.0, day(1), None),
    ]
    replaced = apply(spark, gold, changed, day(1), same_day="replace")
    assert rows(replaced, "amount", "valid_from", "valid_to") == [(2.0, day(1), None)]
    assert quality.unique_version(replaced, KEYS).isEmpty()


def test_several_stored_current_versions_are_all_closed(spark, rows, day):
    gold = spark.createDataFrame(
        [("a", "x", 1.0, "n", day(1), None, True), ("a", "x", 2.0, "n", day(2), None, True)], LAYOUT
    )
    out = apply(spark, gold, [("a", "x", 3.0, "n")], day(3))
    closed = out.filter("NOT is_current")
    assert rows(closed, "amount", "valid_to") == [(1.0, day(3)), (2.0, day(3))]


def test_touched_only_leaves_older_versions_out(spark, rows, day):
    gold = spark.createDataFrame(
        [
            ("a", "x", 1.0, "n", day(1), day(2), False),
            ("b", "x", 1.0, "n", day(1), day(3), False),
            ("c", "x", 1.0, "n", day(1), None, True),
        ],
        LAYOUT,
    )
    out = apply(spark, gold, [("c", "x", 2.0, "n")], day(3), touched_only=True)
    assert rows(out, "uid", "valid_to") == [("b", day(3)), ("c", None), ("c", day(3))]


def edits(seed, days):
    """Rows of several days with changes, reverts, gaps, NULLs and repeated keys."""
    rng = random.Random(seed)
    return {
        d: [
            (rng.choice("abcde"), rng.choice([None, "x"]), rng.choice([None, 1.0, 2.0]), rng.choice("pq"))
            for _ in range(rng.randint(0, 8))
        ]
        for d in days
    }


@pytest.mark.parametrize("seed", range(6))
def test_random_edits_keep_the_invariants_and_replay_equals_daily_runs(spark, empty, rows, day, seed):
    by_day = edits(seed, [day(n) for n in range(1, 6)])
    gold = empty
    for run, data in by_day.items():
        gold = apply(spark, gold, data, run)
        assert rows(apply(spark, gold, data, run)) == rows(gold)
    assert quality.one_current(gold, KEYS).isEmpty()
    assert quality.unique_version(gold, KEYS).isEmpty()
    assert quality.flag_matches_valid_to(gold, KEYS).isEmpty()
    quality.assert_sound(gold, KEYS, ["uid", "valid_from", "is_current"])

    data = [(*row, run) for run, batch in by_day.items() for row in batch]
    incoming = spark.createDataFrame(data, struct_of(f"{ROW}, day date"))
    replayed = scd2.scd2_replay(empty, incoming, KEYS, TRACKED, "day")
    assert rows(replayed) == rows(gold)
    # Half of the days stored already, and the whole batch offered again.
    half = incoming.filter(incoming.day <= day(2))
    stored = spark.createDataFrame(scd2.scd2_replay(empty, half, KEYS, TRACKED, "day").collect(), LAYOUT)
    later = scd2.scd2_replay(stored, incoming.filter(incoming.day > day(2)), KEYS, TRACKED, "day")
    assert rows(later) == rows(gold)
    repeated = scd2.scd2_replay(
        spark.createDataFrame(rows(gold), LAYOUT), incoming, KEYS, TRACKED, "day"
    )
    assert rows(repeated) == rows(gold)


def test_as_of(spark, rows, day):
    gold = spark.createDataFrame(
        [("a", "x", 1.0, "n", day(1), day(3), False), ("a", "x", 2.0, "n", day(3), None, True)], LAYOUT
    )
    seen = {n: rows(scd2.as_of(gold, day(n)), "amount") for n in (1, 2, 3, 9)}
    assert seen == {1: [(1.0,)], 2: [(1.0,)], 3: [(2.0,)], 9: [(2.0,)]}
    assert scd2.as_of(gold, dt.date(2026, 9, 30)).isEmpty()


def test_insert_if_absent_never_changes_and_accumulates(spark, rows):
    stored = frame(spark, ("a", "x", 1.0, "n"))
    more = frame(spark, ("a", "x", 9.0, "n"), ("b", None, 2.0, "n"), ("b", None, 2.0, "n"))
    once = scd2.insert_if_absent(stored, more, KEYS)
    assert rows(once, "uid", "amount") == [("a", 1.0), ("b", 2.0)]
    assert rows(scd2.insert_if_absent(once, more, KEYS)) == rows(once)


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("concat('k', id % 2) AS uid", "'x' AS who", "double(id) AS amount", "'n' AS note")
    plan = dedup(df, ["uid"])._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:]  # below the exchange, on the map side


def test_input_is_shuffled_once_for_deduplication_and_merge(spark, day):
    gold = spark.createDataFrame([("a", "x", 1.0, "n", day(1), None, True)], LAYOUT)
    incoming = frame(spark, ("a", "x", 2.0, "n"))
    after = scd2.scd2_apply(gold, incoming, KEYS, TRACKED, day(2))
    plan = after._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # one per side


def test_applied_and_rejected_rows_are_all_rows(spark, empty, rows, day):
    rng = random.Random(4)
    data = [(rng.choice("ab"), rng.choice([None, "x"]), rng.choice([None, 1.0, 2.0]), "n") for _ in range(300)]
    applied = rows(apply(spark, empty, data, day(1)), "uid", "who", "amount", "note")
    lost = scd2.rejected(frame(spark, *data), KEYS, ["uid", "who", "amount", "note"], "twice")
    assert {r.reject_reason for r in lost.collect()} == {"twice"}
    assert sorted(applied + rows(lost.drop("reject_reason")), key=repr) == sorted(data, key=repr)


def test_late_rows_are_those_that_replay_passes_over(spark, rows, day):
    gold = spark.createDataFrame(
        [("a", "x", 1.0, "n", day(1), day(5), False), ("a", "x", 2.0, "n", day(5), None, True)], LAYOUT
    )
    offered = spark.createDataFrame(
        [
            ("a", "x", 9.0, "n", day(3)),  # contradicts what is stored for its day
            ("a", "x", 1.0, "n", day(2)),  # stored already
            ("a", "x", 2.0, "n", day(5)),
            ("b", None, 1.0, "n", day(1)),  # new
        ],
        struct_of(f"{ROW}, day date"),
    )
    late = scd2.late_rows(gold, offered, KEYS, "day")
    assert rows(late) == [("a", "x", 9.0, "n", day(3))]
    after = scd2.scd2_replay(gold, offered, KEYS, TRACKED, "day")
    assert rows(after.filter("uid = 'a'")) == rows(gold)


def test_a_contradictory_row_is_kept(spark, rows, day):
    gold = spark.createDataFrame(
        [("a", "x", 1.0, "n", day(1), day(2), True), ("b", "x", 1.0, "n", day(1), None, None)], LAYOUT
    )
    out = apply(spark, gold, [("a", "x", 2.0, "n")], day(3))
    assert [r for r in rows(gold) if r not in rows(out)] == []


def test_current_rows_are_one_partition(spark, tmp_path, day):
    gold = spark.createDataFrame([("a", "x", 1.0, "n", day(1), None, True)], LAYOUT)
    gold.write.partitionBy("valid_to").parquet(str(tmp_path / "gold"))
    read = spark.read.schema(LAYOUT).parquet(str(tmp_path / "gold"))
    plan = scd2.current(read)._jdf.queryExecution().executedPlan().toString()
    assert "isnull(valid_to" in plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
