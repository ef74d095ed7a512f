"""Aggregations and pivots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.functions.temporal import calendar_part, in_year
from tablework.operators import aggregates
from tablework.operators.ranking import top_rows
from tablework.plans.registry import query, table
from tablework.storage import fresh_path


def _pieces():
    """Quantities are whole numbers: they add up exactly as integers."""
    return F.col("l_quantity").cast("bigint")


@query("""
    SELECT l_returnflag, l_linestatus, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sum_qty
    FROM lineitem GROUP BY ALL ORDER BY sum_qty DESC
""")
def group_sum_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return aggregates.group_total(lines, ["l_returnflag", "l_linestatus"], _pieces(), "sum_qty")


@query("""
    SELECT l_returnflag, l_linestatus, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sum_qty
    FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL ORDER BY sum_qty DESC
""")
def filtered_group_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    return aggregates.group_total(
        returned, ["l_returnflag", "l_linestatus"], _pieces(), "sum_qty"
    )


@query("SELECT CAST(COUNT(DISTINCT l_partkey) AS BIGINT) AS n_parts FROM lineitem "
       "WHERE l_partkey IS NOT NULL")
def count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where(F.col("l_partkey").isNotNull())
    return aggregates.distinct_count(lines, "l_partkey", "n_parts")


@query("SELECT event_type, CAST(COUNT(*) AS BIGINT) AS count FROM events "
       "WHERE event_type IS NOT NULL GROUP BY ALL ORDER BY count DESC")
def group_count_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where(F.col("event_type").isNotNull())
    return aggregates.group_counts(events, ["event_type"])


@query("""
    SELECT CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(o_totalprice) AS mean,
           MIN(o_totalprice) AS smallest, MAX(o_totalprice) AS largest
    FROM orders
""")
def global_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.summary(table(spark, sf_dir, "orders"), "o_totalprice", digits=2)


@query("""
    SELECT event_type, CAST(SUM(CAST(value * 4503599627370496 * 4096 AS HUGEINT)) AS DOUBLE)
               / 4503599627370496 / 4096 AS total, CAST(COUNT(value) AS BIGINT) AS n
    FROM events GROUP BY event_type
""")
def exact_group_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doubles added without rounding, and rounded once. In SQL: as multiples of 2 ** -64, which holds
    for values from 2 ** -11 on."""
    events = table(spark, sf_dir, "events").select("event_type", "value")
    return aggregates.exact_sums(events, ["event_type"], "value")


@query("""
    SELECT load, true AS close FROM (
        SELECT CAST(year(o_orderdate) AS VARCHAR) AS load FROM orders
        WHERE o_orderdate IS NOT NULL GROUP BY 1
        UNION ALL SELECT 'all') loads
""")
def distinct_over_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers per year of orders and over all years, from sketches kept per year; each compared
    with the exact count (three standard errors at most)."""
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderdate").isNotNull())
    orders = orders.select(F.year("o_orderdate").cast("string").alias("load"), "o_custkey")
    path = fresh_path(spark, "sketches")
    aggregates.load_sketches(orders, "load", "o_custkey").write.parquet(path)
    sketches = spark.read.parquet(path)
    exact = orders.groupBy("load").agg(F.countDistinct("o_custkey").alias("n"))
    each = sketches.select("load", F.hll_sketch_estimate("sketch").alias("about")).join(exact, "load")
    whole = aggregates.union_sketch(sketches, "sketch", "about").select(F.lit("all").alias("load"), "about")
    whole = whole.crossJoin(orders.agg(F.countDistinct("o_custkey").alias("n")))
    error = F.abs(F.col("about") - F.col("n")) / F.col("n")
    return each.union(whole).select("load", (error <= 3 * 0.0065).alias("close"))


@query("""
    SELECT o_orderstatus, o_orderpriority,
           CAST(MAX(CAST(o_totalprice AS FLOAT)) AS DOUBLE) AS highest
    FROM orders WHERE year(o_orderdate) = 1998 GROUP BY ALL ORDER BY highest DESC
""")
def group_max_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice").cast("float")
    keys = ["o_orderstatus", "o_orderpriority"]
    return (
        table(spark, sf_dir, "orders")
        .where(in_year("o_orderdate", 1998))
        .groupBy(*keys)
        .agg(F.max(price).cast("double").alias("highest"))
        .orderBy(F.desc("highest"), *keys)
    )


@query("""
    SELECT CAST(month(o_orderdate) AS BIGINT) AS order_month, CAST(COUNT(*) AS BIGINT) AS n_orders
    FROM orders WHERE year(o_orderdate) = 1998 GROUP BY 1 ORDER BY n_orders DESC
""")
def count_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where(in_year("o_orderdate", 1998))
    monthly = orders.select(calendar_part("o_orderdate", "month").alias("order_month"))
    return aggregates.group_counts(monthly, ["order_month"], "n_orders")


@query("""
    SELECT CAST(week(o_orderdate) AS BIGINT) AS order_week, CAST(COUNT(*) AS BIGINT) AS n_orders
    FROM orders WHERE year(o_orderdate) = 1998 GROUP BY 1 ORDER BY n_orders DESC, order_week LIMIT 1
""")
def top_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where(in_year("o_orderdate", 1998))
    weekly = orders.groupBy(calendar_part("o_orderdate", "week").alias("order_week"))
    counts = weekly.agg(F.count(F.lit(1)).alias("n_orders"))
    return top_rows(counts, 1, F.desc("n_orders"), F.asc("order_week"))


@query("""
    SELECT l_returnflag, l_linestatus, CAST(l_linenumber AS BIGINT) AS l_linenumber,
           CAST(COUNT(*) AS BIGINT) AS count
    FROM lineitem GROUP BY ALL ORDER BY count DESC
""")
def three_key_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = aggregates.group_counts(
        table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"]
    )
    return counts.withColumn("l_linenumber", F.col("l_linenumber").cast("bigint"))


def _mean_cell(month: int) -> str:
    in_month = f"FILTER (WHERE month(o_orderdate) = {month})"
    return (
        f"CAST(CAST(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) {in_month} AS DOUBLE) "
        f"/ NULLIF(COUNT(*) {in_month}, 0) AS DECIMAL(12,2)) AS DOUBLE)"
    )


@query(f"""
    SELECT o_orderpriority, {_mean_cell(1)} AS JAN_AvgPrice,
           MAX(o_totalprice) FILTER (WHERE month(o_orderdate) = 1) AS JAN_MaxPrice,
           {_mean_cell(2)} AS FEB_AvgPrice,
           MAX(o_totalprice) FILTER (WHERE month(o_orderdate) = 2) AS FEB_MaxPrice
    FROM orders GROUP BY o_orderpriority ORDER BY o_orderpriority
""")
def pivot_two_aggs(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = table(spark, sf_dir, "orders").select(
        "o_orderpriority", F.month("o_orderdate").alias("month"), "o_totalprice"
    )
    mean = aggregates.exact_mean("o_totalprice", 2)
    wide = aggregates.pivot_labelled(
        dated,
        ["o_orderpriority"],
        "month",
        {1: "JAN", 2: "FEB"},  # fixed values
        {
            "AvgPrice": aggregates.within(mean, 12, 2).cast("double"),
            "MaxPrice": F.max("o_totalprice"),
        },
    )
    return wide.orderBy("o_orderpriority")


@query("""
    SELECT vec_id, CAST(position - 1 AS BIGINT) AS position,
           CAST(embedding[position] AS DOUBLE) + 1 AS value
    FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS position
          FROM embeddings) items
""")
def explode_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    plus_one = F.col("item").cast("double") + 1
    rebuilt = aggregates.rebuilt_arrays(
        table(spark, sf_dir, "embeddings"), "vec_id", "embedding", plus_one, "values"
    )
    items = rebuilt.select("vec_id", F.posexplode("values").alias("position", "value"))
    return items.withColumn("position", F.col("position").cast("bigint"))


@query("SELECT DISTINCT event_type, strftime(ts, '%Y-%m-%d') AS event_day FROM events")
def distinct_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("ts", "yyyy-MM-dd").alias("event_day")
    return table(spark, sf_dir, "events").select("event_type", day).distinct()


@query("SELECT DISTINCT conv_id, turn, role, text FROM conversations")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different whole rows, which is not the same as different values of one column."""
    return table(spark, sf_dir, "conversations").distinct()


@query("SELECT DISTINCT CAST(year(o_orderdate) AS BIGINT) AS order_year FROM orders "
       "ORDER BY order_year")
def distinct_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = table(spark, sf_dir, "orders").select(
        calendar_part("o_orderdate", "year").alias("order_year")
    )
    return years.distinct().orderBy("order_year")
