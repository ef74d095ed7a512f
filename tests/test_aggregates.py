import math
import random
from fractions import Fraction

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tablework.operators import aggregates
from tablework.operators.ranking import dense_rank_all, top_dense_rank, top_rows
from tablework.plans.explain import plan_text
from tablework.plans.registry import all_queries

SF_DIR = "/root/testdata/sf0.001"


def counts(spark):
    rows = [("CA", "Red", 5), ("CA", "Blue", 7), ("CA", "Red", 4)]
    rows += [("TX", "Red", 7), ("TX", None, 1)]
    return spark.createDataFrame(rows, "state string, color string, n int")


def test_group_total_is_ordered(spark):
    rows = aggregates.group_total(counts(spark), ["state", "color"], F.col("n"), "total").collect()
    assert [tuple(r) for r in rows] == [
        ("CA", "Red", 9), ("CA", "Blue", 7), ("TX", "Red", 7), ("TX", None, 1)
    ]
    rows = aggregates.group_counts(counts(spark), ["state"]).collect()
    assert [tuple(r) for r in rows] == [("CA", 3), ("TX", 2)]


def test_distinct_count_ignores_null(spark):
    df = counts(spark)
    assert aggregates.distinct_count(df, "color", "n").first().n == 2
    assert aggregates.distinct_count(df, "color", "n", relative_error=0.05).first().n == 2


def test_summary(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,)], "x double")
    assert tuple(aggregates.summary(df, "x", digits=2).first()) == (0.3, 0.15, 0.1, 0.2)
    small = spark.range(1000).selectExpr("CAST(0.004 AS DOUBLE) AS x")
    total, mean, smallest, _ = aggregates.summary(small, "x").first()
    assert abs(total - 4.0) < 1e-9 and abs(mean - 0.004) < 1e-12 and smallest == 0.004
    fine = spark.createDataFrame([(0.0001,), (0.0002,)], "x double")
    assert aggregates.summary(fine, "x", digits=4).first().total == 0.0003


def pivoted(spark, precision=4):
    rows = [("SFO", 1, 10), ("SFO", 1, 15), ("SFO", 2, 200), ("LAX", 2, 3), ("LAX", 3, 9)]
    df = spark.createDataFrame(rows, "destination string, month int, delay int")
    return aggregates.pivot_labelled(
        df,
        ["destination"],
        "month",
        {1: "JAN", 2: "FEB"},
        {"AvgDelay": aggregates.within(F.avg("delay"), precision, 2), "MaxDelay": F.max("delay")},
    ).orderBy("destination")


def test_pivot_names_absent_cells_and_overflow(spark):
    wide = pivoted(spark)
    assert wide.columns == [
        "destination", "JAN_AvgDelay", "JAN_MaxDelay", "FEB_AvgDelay", "FEB_MaxDelay"
    ]
    lax, sfo = wide.collect()
    assert (lax.JAN_AvgDelay, lax.JAN_MaxDelay, float(lax.FEB_AvgDelay)) == (None, None, 3.0)
    # 200 does not fit decimal(4,2): NULL, not an error.
    assert (float(sfo.JAN_AvgDelay), sfo.FEB_AvgDelay, sfo.FEB_MaxDelay) == (12.5, None, 200)
    assert float(pivoted(spark, 6).collect()[1].FEB_AvgDelay) == 200.0


def test_pivot_with_one_aggregate(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 2, 3)], "k string, m int, n int")
    wide = aggregates.pivot_labelled(df, ["k"], "m", {1: "ONE", 2: "TWO"}, {"n": F.sum("n")})
    assert tuple(wide.first()) == ("a", 2, 3) and wide.columns == ["k", "ONE_n", "TWO_n"]


def test_arrays_are_rebuilt_in_order(spark):
    df = spark.createDataFrame([(1, [3, 1, 2]), (2, [9])], "id int, xs array<int>").repartition(3)
    rebuilt = aggregates.rebuilt_arrays(df, "id", "xs", F.col("item") + 1, "ys")
    assert [r.ys for r in rebuilt.orderBy("id").collect()] == [[4, 2, 3], [10]]


def test_dense_rank_keeps_ties_and_nulls(spark):
    rows = [("a", i, v) for i, v in enumerate([9, 9, 8, 7, 7, 6, None])]
    rows += [(None, 1, 2), ("b", 1, None)]
    df = spark.createDataFrame(rows, "g string, i int, v int")
    top = top_dense_rank(df, "g", "v", 3)
    expected = df.selectExpr(
        "*", "CAST(dense_rank() OVER (PARTITION BY g ORDER BY v DESC) AS BIGINT) AS rank"
    ).where("rank <= 3")
    assert sorted(map(str, top.collect())) == sorted(map(str, expected.collect()))
    assert top.where("g = 'a'").count() == 5


def test_ranks_are_cut_before_the_shuffle(spark):
    """Many equal values meet in no task: they are combined, and each map task passes on three."""
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), F.lit(1).alias("v"))
    top = top_dense_rank(df, "g", "v", 3)
    plan = plan_text(top, "simple")
    window = plan[plan.index("Window ["):]
    assert window.index("Final") < window.index("Exchange") < window.index("Partial")
    assert top.count() == 5000


def test_top_rows(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (2, "b")], "n int, s string")
    top = top_rows(df, 2, F.desc("n"), F.asc("s"))
    assert "TakeOrderedAndProject" in plan_text(top)
    assert [tuple(r) for r in top.collect()] == [(2, "a"), (2, "b")]


def test_distinct_rows_and_distinct_values_differ(spark):
    df = counts(spark)
    assert df.distinct().count() == 5 and df.select("state").distinct().count() == 2


def test_unions_keep_duplicates_and_go_by_position(spark):
    one = spark.createDataFrame([(1, 2)], "a int, b int")
    other = spark.createDataFrame([(1, 2)], "b int, a int")
    assert [tuple(r) for r in one.union(other).collect()] == [(1, 2), (1, 2)]
    assert [tuple(r) for r in one.unionByName(other).collect()] == [(1, 2), (2, 1)]


def test_unknown_group_column(spark):
    with pytest.raises(AnalysisException):
        aggregates.group_counts(counts(spark), ["nope"])


@pytest.mark.parametrize(
    "name, pushed, columns",
    [
        ("project_filter_ne", "Not(EqualTo(o_orderpriority,5-LOW))",
         "struct<o_orderkey:bigint,o_orderdate:timestamp_ntz,o_orderpriority:string>"),
        ("filtered_group_sum", "EqualTo(l_returnflag,R)",
         "struct<l_quantity:double,l_returnflag:string,l_linestatus:string>"),
        ("multi_predicate_filter", "StringContains(event_type,c)",
         "struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>"),
        ("count_distinct", "IsNotNull(l_partkey)", "struct<l_partkey:bigint>"),
        ("union_all_refilter", "GreaterThan(o_totalprice,400000.0)",
         "struct<o_orderkey:bigint,o_totalprice:double,o_orderpriority:string>"),
    ],
)
def test_filters_and_columns_reach_the_scan(spark, name, pushed, columns):
    plan = plan_text(all_queries()[name](spark, SF_DIR))
    assert pushed in plan and columns in plan


def test_rebuilt_arrays_keeps_empty_and_null_arrays(spark):
    df = spark.createDataFrame([(1, [1, 2, None]), (2, []), (3, None)], "id int, xs array<int>")
    rebuilt = aggregates.rebuilt_arrays(df, "id", "xs", F.col("item") + 1, "ys")
    assert {r.id: r.ys for r in rebuilt.collect()} == {1: [2, 3, None], 2: [], 3: None}
    for again in ([(1, [1, 2]), (1, [3])], [(1, [1]), (1, [])], [(1, None), (1, None)]):
        df = spark.createDataFrame(again, "id int, xs array<int>")
        with pytest.raises(Exception, match="key repeats"):
            aggregates.rebuilt_arrays(df, "id", "xs", F.col("item"), "ys").collect()


@pytest.mark.parametrize("name", ["group_max_cast", "count_by_month", "top_week"])
def test_a_year_reaches_the_scan_as_a_range(spark, name):
    plan = plan_text(all_queries()[name](spark, SF_DIR))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def once_rounded(values):
    return float(sum(map(Fraction, values), Fraction(0)))


TRICKY = [1e16, 1.0, -1e16, 0.1, 0.2, 5e-324, -5e-324, 1e308, 3.5e-300, -1e308, 2.0**53, 1.0, -0.0, 1e-16] * 3


@pytest.mark.parametrize("parts", [1, 2, 3, 5, 8])
def test_sums_do_not_depend_on_partitions(spark, parts):
    rng = random.Random(parts)
    values = [*TRICKY, *(rng.uniform(-1, 1) * 10.0 ** rng.randint(-30, 30) for _ in range(300))]
    rng.shuffle(values)
    rows = [(i % 3, v) for i, v in enumerate(values)] + [(None, 2.5), (None, None), (7, None)]
    frame = spark.createDataFrame(rows, "k int, v double").repartition(parts)
    found = {r.k: (r.total, r.n) for r in aggregates.exact_sums(frame, ["k"], "v").collect()}
    expected = {k: [v for i, v in enumerate(values) if i % 3 == k] for k in range(3)}
    assert {k: found[k] for k in range(3)} == {k: (once_rounded(v), len(v)) for k, v in expected.items()}
    assert found[None] == (2.5, 1) and found[7] == (None, 0)
    whole = aggregates.summary(frame, "v").first()
    assert whole.total == once_rounded([*values, 2.5])
    assert whole.mean == once_rounded([*values, 2.5]) / (len(values) + 1)


def test_sums_of_numbers_that_are_not_finite(spark):
    inf, nan = math.inf, math.nan
    rows = [("nan", nan), ("nan", 1.0), ("up", inf), ("up", -1e308), ("both", inf), ("both", -inf),
            ("large", 1.7e308), ("large", 1.7e308), ("low", -1.7e308), ("low", -1.7e308), ("zero", -0.0)]
    found = {r.k: r.total for r in aggregates.exact_sums(spark.createDataFrame(rows, "k string, v double"), ["k"], "v").collect()}
    assert math.isnan(found.pop("nan")) and math.isnan(found.pop("both"))
    assert found == {"up": inf, "large": inf, "low": -inf, "zero": 0.0}
    nothing = spark.createDataFrame([], "k string, v double")
    assert aggregates.exact_sums(nothing, [], "v").collect() == [(None, 0)]
    assert aggregates.exact_sums(nothing, ["k"], "v").count() == 0
    assert tuple(aggregates.summary(nothing, "v").first()) == (None, None, None, None)


def test_exact_sums_of_every_power_of_two(spark):
    values = [math.ldexp(1.0, e) * s for e in range(-1074, 1024) for s in (1, -1)] + [math.ldexp(1.0, -1074)]
    values += [math.nextafter(math.ldexp(1.0, e), 0) for e in range(-1073, 1000, 7)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    assert aggregates.exact_sums(frame, [], "v").first().total == once_rounded(values)


def test_dense_rank_of_a_whole_table(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice([None, *range(40)])) for i in range(500)] + [(1000 + i, 7) for i in range(300)]
    frame = spark.createDataFrame(rows, "id int, v int").repartition(4)
    order = sorted({v for _, v in rows if v is not None}, reverse=True) + [None]
    ranked = dense_rank_all(frame, "v", parts=6)
    assert {r.id: r.rank for r in ranked.collect()} == {i: order.index(v) + 1 for i, v in rows}
    plan = plan_text(ranked)
    assert "SinglePartition" not in plan
    assert dense_rank_all(frame.limit(0), "v").count() == 0


def test_sketches_of_loads_add_up(spark):
    frame = spark.range(30000).selectExpr("CAST(id % 4 AS STRING) AS load", "id % 20000 AS v")
    sketches = aggregates.load_sketches(frame, "load", "v")
    about = aggregates.union_sketch(sketches, "sketch", "n").first().n
    assert abs(about - 20000) <= 3 * 0.0065 * 20000
    some = aggregates.union_sketch(sketches.where("load IN ('0', '1')"), "sketch", "n").first().n
    assert abs(some - 10000) <= 3 * 0.0065 * 10000
