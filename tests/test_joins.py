import random

import pytest
from pyspark.sql import functions as F

from tablework.operators.joins import equi_join, interval_join
from tablework.plans.explain import plan_text


@pytest.fixture
def no_auto_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def orders_and_users(spark):
    orders = spark.range(1000).select("id", (F.col("id") % 100).alias("user"))
    users = spark.range(50).select(F.col("id").alias("uid"), F.lit("CA").alias("state"))
    return orders, users


def same():
    return F.col("user") == F.col("uid")


@pytest.mark.parametrize(
    "strategy, node",
    [
        ("broadcast", "BroadcastHashJoin"),
        ("merge", "SortMergeJoin"),
        ("shuffle_hash", "ShuffledHashJoin"),
        (None, "BroadcastHashJoin"),
    ],
)
def test_strategies_agree(spark, strategy, node):
    joined = equi_join(*orders_and_users(spark), same(), strategy)
    assert node in plan_text(joined)
    assert joined.count() == 500


def test_without_broadcast_the_join_merges(spark, no_auto_broadcast):
    joined = equi_join(*orders_and_users(spark), same())
    assert "SortMergeJoin" in plan_text(joined)
    assert joined.count() == 500


def test_a_side_over_the_limit_is_not_broadcast(spark):
    orders, users = orders_and_users(spark)
    many = spark.range(10_000_000).withColumnRenamed("id", "uid")
    assert "SortMergeJoin" in plan_text(equi_join(orders, many, same(), "broadcast"))


def test_duplicate_keys_fan_out(spark):
    left = spark.createDataFrame([("Big", 1)], "code string, n int")
    states = [("Big", "AK"), ("Big", "TN"), ("Big", "CA")]
    right = spark.createDataFrame(states, "code string, s string")
    assert equi_join(left, right, "code").count() == 3


def interval_case(spark):
    rng = random.Random(3)
    points = [(i, rng.choice([-7.5, 0.0, rng.uniform(-50, 50)])) for i in range(300)]
    intervals = []
    for i in range(60):
        low = rng.uniform(-60, 60)
        intervals.append((i, low, low + rng.choice([0.0, 0.01, 3.0, 200.0, -1.0])))
    intervals += [(98, -7.5, -7.5), (99, None, 3.0)]
    expected = sorted(
        (p, i)
        for p, v in points
        for i, low, high in intervals
        if low is not None and low <= v <= high
    )
    return (
        spark.createDataFrame(points, "p int, v double"),
        spark.createDataFrame(intervals, "i int, low double, high double"),
        expected,
    )


def test_few_intervals_are_broadcast(spark):
    points, intervals, expected = interval_case(spark)
    joined = interval_join(points, intervals, "v", "low", "high")
    assert "BroadcastNestedLoopJoin" in plan_text(joined)
    assert sorted((r.p, r.i) for r in joined.collect()) == expected


def test_many_intervals_join_by_bins(spark):
    points, intervals, expected = interval_case(spark)
    joined = interval_join(points, intervals, "v", "low", "high", broadcast_rows=10)
    plan = plan_text(joined)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert joined.columns == ["p", "v", "i", "low", "high"]
    assert sorted((r.p, r.i) for r in joined.collect()) == expected


def test_no_valid_interval(spark):
    points = spark.createDataFrame([(1, 1.0)], "p int, v double")
    empty = spark.createDataFrame([(1, 3.0, 2.0)] * 3, "i int, low double, high double")
    assert interval_join(points, empty, "v", "low", "high", broadcast_rows=1).count() == 0


@pytest.mark.parametrize("strategy", ["merge", "shuffle_hash"])
def test_a_hot_key_is_split(spark, strategy):
    """A third of the rows under one key: adaptive execution cuts that partition in pieces."""
    settings = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    before = {"spark.sql.shuffle.partitions": "4", **{key: "" for key in list(settings)[1:]}}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        user = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000)
        orders = spark.range(0, 200_000, 1, 8).select("id", user.alias("user"))
        users = spark.range(1000).select(F.col("id").alias("uid"), F.lit("CA").alias("state"))
        joined = equi_join(orders, users, same(), strategy)
        assert joined.agg(F.count("id"), F.sum("id")).first()[0] == 200_000
        rows = joined.select("id", "state")
        rows.collect()
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)


def test_a_side_that_unpacks_to_more_than_the_limit_is_not_broadcast(spark, tmp_path):
    """One long text many times over: small as a file, large in memory."""
    path = str(tmp_path / "users")
    text = F.repeat(F.lit("x"), 10_000)
    users = spark.range(5000).coalesce(1).select(F.col("id").alias("uid"), text.alias("t"))
    users.write.parquet(path)
    orders, _ = orders_and_users(spark)
    joined = equi_join(orders, spark.read.parquet(path), same(), "broadcast")
    assert "SortMergeJoin" in plan_text(joined)


@pytest.mark.parametrize("kind", ["double", "bigint"])
def test_interval_join_does_not_depend_on_its_form(spark, kind):
    inf, nan = float("inf"), float("nan")
    values = [1.0, 2.5, -3.0, 0.0, 1e15 + 2, -1e300, 5e-9, None]
    odd = [inf, -inf, nan] if kind == "double" else []
    ends = [(0.0, 2.0), (2.0, inf), (-inf, 1.0), (1.0, nan), (nan, nan), (3.0, 1.0), (None, 2.0),
            (1e15, 1e15 + 4), (inf, inf), (-inf, inf), (-1e301, -1e299), (2.5, 2.5)]
    if kind == "bigint":
        values = [None if v is None else int(v) for v in values if v != -1e300]
        ends = [(a, b) for a, b in ends if a is None or abs(a) < 1e18 and abs(b) < 1e18]
        ends = [(None if a is None else int(a), int(b)) for a, b in ends]
    points = spark.createDataFrame([(i, v) for i, v in enumerate(values + odd)], f"p int, v {kind}")
    intervals = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(ends)], f"i int, a {kind}, b {kind}")
    found = []
    for limit in (1000, 0):
        rows = interval_join(points, intervals, "v", "a", "b", broadcast_rows=limit)
        assert set(rows.columns) == {"p", "v", "i", "a", "b"}
        found.append(sorted((r.p, r.i) for r in rows.collect()))
    assert found[0] == found[1] and found[0]


def test_many_times_of_no_length_do_not_share_a_bin(spark):
    times = spark.range(2000).selectExpr("id AS i", "1700000000000000 + id AS t")
    spans = times.selectExpr("i AS j", "t AS a", "t AS b")
    joined = interval_join(times, spans, "t", "a", "b", broadcast_rows=0)
    assert joined.where("i = j").count() == joined.count() == 2000
