import bisect
import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablework.operators.dedup import greedy_dedup
from tablework.plans.explain import plan_text

COLUMNS = "name string, note int, age double, seq bigint"


def expected(left, right, distance=5.0):
    """The rule as it is stated, row by row."""
    kept = []
    for name, note, age, seq, side in sorted(
        [(*row, 0) for row in left] + [(*row, 1) for row in right], key=lambda r: (r[4], r[3])
    ):
        same = [k for k in kept if k[0] == name and k[2] is not None and age is not None]
        # A difference of infinite values is NaN, which is not below any distance.
        if age is None or not any(abs(k[2] - age) < distance for k in same):
            kept.append((name, note, age, seq, side))
    return sorted(kept, key=repr)


def actual(spark, left, right, **options):
    frames = [spark.createDataFrame(rows, COLUMNS) for rows in (left, right)]
    if options.get("head_rows", 1000) < 1000:
        options.setdefault("block_rows", 2 * options["head_rows"])
    kept = greedy_dedup(*frames, "name", "age", "seq", 5.0, **options)
    return sorted([(r.name, r.note, r.age, r.seq, r.side) for r in kept.collect()], key=repr)


def numbered(rows):
    return [(*row, seq) for seq, row in enumerate(rows)]


LEFT = numbered(
    [("bob", 13, 30.0), ("bob", 13, 29.0), ("bob", 13, 25.0), ("bob", 13, 5.0), ("alice", 13, 25.0)]
)
RIGHT = numbered([("bob", 13, 20.0), ("bob", 15, 21.0), ("alice", 13, 25.0)])


@pytest.mark.parametrize("method", ["native", "cogroup"])
@pytest.mark.parametrize("head_rows", [1000, 2])
def test_left_rows_come_first_and_close_rows_are_dropped(spark, method, head_rows):
    rows = actual(spark, LEFT, RIGHT, method=method, head_rows=head_rows)
    assert rows == expected(LEFT, RIGHT)
    assert sorted((r[0], r[2]) for r in rows) == [
        ("alice", 25.0), ("bob", 5.0), ("bob", 20.0), ("bob", 25.0), ("bob", 30.0)
    ]


@pytest.mark.parametrize("method", ["native", "cogroup"])
@pytest.mark.parametrize("order", ["random", "rising", "falling"])
def test_one_group_with_most_of_the_rows(spark, method, order):
    """A large group is decided in rounds; nothing changes but the work."""
    rng = random.Random(7)
    ages = [round(rng.uniform(-150, 150), 1) for _ in range(400)]
    if order != "random":
        ages.sort(reverse=order == "falling")
    rows = numbered([("hot", i, age) for i, age in enumerate(ages)])
    rows += [("cold", 1, 3.0, 5000), (None, 2, 3.0, 5001), (None, 3, 4.0, 5002)]
    left, right = rows[::2], rows[1::2]
    assert actual(spark, left, right, method=method, head_rows=60) == expected(left, right)


def test_null_nan_and_infinite_values(spark):
    left = numbered([("a", 1, None), ("a", 2, None), ("a", 3, math.inf), ("a", 4, 1.0)])
    right = numbered([("a", 5, math.inf), ("a", 6, math.nan), ("a", 7, math.nan), ("a", 8, 2.0)])
    for method in ("native", "cogroup"):
        for head_rows in (1000, 1):
            rows = actual(spark, left, right, method=method, head_rows=head_rows)
            assert repr(rows) == repr(expected(left, right))
            assert sorted(row[1] for row in rows) == [1, 2, 3, 4, 5, 6, 7]


def test_a_distance_of_nothing_keeps_all(spark):
    rows = numbered([("a", 1, 2.0), ("a", 2, 2.0)])
    frames = [spark.createDataFrame(x, COLUMNS) for x in (rows[:1], rows[1:])]
    assert greedy_dedup(*frames, "name", "age", "seq", 0.0).count() == 2


def rising(spark, n):
    return spark.range(n).selectExpr(
        "'hot' AS name", "CAST(id AS INT) AS note", "id * 0.01D AS age", "id AS seq"
    )


def rising_by_hand(n):
    kept, last = [], None
    for i in range(n):
        age = i * 0.01
        if last is None or not abs(last - age) < 5.0:
            kept.append(age)
            last = age
    return kept


def test_a_hot_key_of_dense_rising_values(spark):
    """The worst order: each value depends on the one before. One block a round, few jobs, and no
    task that sees the whole group."""
    n = 3_000_000
    values = rising(spark, n)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("rising", "rising")
    try:
        kept = greedy_dedup(values, values.limit(0), "name", "age", "seq", 5.0)
        ages = sorted(r.age for r in kept.select("age").collect())
        jobs = len(tracker.getJobIdsForGroup("rising"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert ages == rising_by_hand(n)
    assert jobs <= 40


@pytest.mark.parametrize("order", ["id", "-id", "xxhash64(id)", "id div 7 * 7 + pmod(-id, 7)"])
def test_blocks_of_any_order(spark, order):
    n = 20_000
    values = rising(spark, n).withColumn("seq", F.expr(order.replace("id", "note")))
    values = values.withColumn("age", F.expr("age * 3"))
    kept = greedy_dedup(values, values.limit(0), "name", "age", "seq", 5.0, head_rows=10, block_rows=3000)
    places = {r.seq: r.age for r in values.select("seq", "age").collect()}
    by_hand: list[float] = []
    for _, age in sorted(places.items()):
        at = bisect.bisect_left(by_hand, age)
        if all(abs(age - x) >= 5.0 for x in by_hand[max(0, at - 1) : at + 1]):
            by_hand.insert(at, age)
    assert sorted(r.age for r in kept.select("age").collect()) == by_hand


def test_small_groups_beside_a_large_one_and_nan_keys(spark):
    rng = random.Random(3)
    rows = [(float("nan") if i % 3 == 0 else float(i % 5), i, rng.uniform(0, 300), i) for i in range(900)]
    frame = spark.createDataFrame(rows, "name double, note int, age double, seq bigint")
    kept = greedy_dedup(frame, frame.limit(0), "name", "age", "seq", 5.0, head_rows=150, block_rows=40)
    by_name = {}
    for name, note, age, _ in rows:
        own = by_name.setdefault(repr(name), [])
        if all(abs(age - x) >= 5.0 for x in own):
            own.append(age)
    found = {}
    for r in kept.collect():
        found.setdefault(repr(r.name), []).append(r.age)
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in by_name.items()}


@settings(max_examples=8, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from("xyz"), st.integers(0, 9), st.integers(0, 60)), max_size=40),
    st.lists(st.tuples(st.sampled_from("xyz"), st.integers(0, 9), st.integers(0, 60)), max_size=40),
    st.sampled_from([1000, 5]),
)
def test_any_rows(spark, left, right, head_rows):
    left = numbered([(a, b, float(c)) for a, b, c in left])
    right = numbered([(a, b, float(c)) for a, b, c in right])
    assert actual(spark, left, right, head_rows=head_rows) == expected(left, right)


def test_no_group_is_collected_from_the_source(spark):
    """What is collected per group is read from the combined values, at most HEAD_ROWS a group."""
    frames = [spark.createDataFrame(rows, COLUMNS) for rows in (LEFT, RIGHT)]
    plan = plan_text(greedy_dedup(*frames, "name", "age", "seq", 5.0))
    assert "dedup-pool" in plan
    assert "Cartesian" not in plan
