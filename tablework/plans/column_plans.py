"""Projections, filters, casts, conditional columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tablework.operators import columns
from tablework.plans.registry import query, table
from tablework.storage import fresh_name

EVENT_RECORD = StructType(
    [
        StructField("value", DoubleType()),
        StructField("event_type", StringType()),
        StructField("event_id", LongType()),
        StructField("user_id", LongType()),
    ]
)


@query("SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders "
       "WHERE o_orderpriority <> '5-LOW'")
def project_filter_ne(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    return orders.where(F.col("o_orderpriority") != "5-LOW")


@query("SELECT doc_id, n_chars * 2 AS by_text, n_chars * 2 AS by_column FROM documents")
def expr_arith(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expression text and column arithmetic are the same thing."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.expr("n_chars * 2").alias("by_text"), (F.col("n_chars") * 2).alias("by_column")
    )


@query("SELECT doc_id, n_chars, CASE WHEN n_chars > 10000 THEN 'big' ELSE 'small' END AS hitter "
       "FROM documents")
def flag_big_hitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    flagged = documents.withColumn("is_big", F.expr("n_chars > 10000"))
    hitter = F.when(F.col("is_big"), "big").otherwise("small")
    return flagged.withColumn("hitter", hitter).drop("is_big")


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, "
       "CAST(CAST(value AS INTEGER) AS BIGINT) - "
       "CASE WHEN CAST(value AS INTEGER) > value THEN 1 ELSE 0 END AS value FROM events")
def cast_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text to number with NULL for dirty text, and double to integer by truncation."""
    key = F.get_json_object("props", "$.k")
    events = table(spark, sf_dir, "events").select("event_id", key.alias("k"), "value")
    clean = columns.recast(events, {"k": "bigint"}, dirty="null")
    return columns.recast(columns.recast(clean, {"value": "int"}), {"value": "bigint"})


@query("SELECT o_orderkey, CASE WHEN o_totalprice <= 100000 THEN 'regular' ELSE 'large' END "
       "AS order_class FROM orders")
def drop_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.when(F.col("o_totalprice") <= 100000, "regular").otherwise("large")
    return (
        table(spark, sf_dir, "orders")
        .withColumn("size", size)
        .drop("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
        .withColumnRenamed("size", "order_class")
    )


@query("SELECT value, event_type, event_id, user_id FROM events WHERE value > 25")
def conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.conform(table(spark, sf_dir, "events").where("value > 25"), EVENT_RECORD)


TURN_RECORD = (
    "conv_id bigint, said struct<text: string, who: struct<role: string, turn: bigint>>, "
    "sizes array<struct<chars: bigint, words: bigint>>"
)


@query(r"""
    SELECT conv_id, text, role, CAST(turn AS BIGINT) AS turn, CAST(length(text) AS BIGINT) AS chars,
           CAST(len(string_split_regex(text, '\s')) AS BIGINT) AS words
    FROM conversations
""")
def conform_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structs in a struct and in an array, whose fields stand in another order and have other types
    than those of the record."""
    turns = table(spark, sf_dir, "conversations").select(
        F.array(
            F.struct(
                F.size(F.split("text", r"\s", -1)).alias("words"), F.length("text").alias("chars")
            )
        ).alias("sizes"),
        F.struct(
            F.struct("turn", "role", F.lit(1).alias("spare")).alias("who"), "text"
        ).alias("said"),
        "conv_id",
    )
    record = columns.conform(turns, StructType.fromDDL(TURN_RECORD))
    return record.select(
        "conv_id", "said.text", "said.who.role", "said.who.turn",
        F.col("sizes")[0]["chars"].alias("chars"), F.col("sizes")[0]["words"].alias("words"),
    )


@query("SELECT event_id, user_id, event_type, value FROM events "
       "WHERE value > 30 AND ts < TIMESTAMP '2024-01-20' AND contains(event_type, 'c')")
def multi_predicate_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .where(F.col("value") > 30)
        .where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
        .where(F.col("event_type").contains("c"))
        .select("event_id", "user_id", "event_type", "value")
    )


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders "
       "WHERE o_orderstatus = 'O' AND o_orderpriority LIKE '1-%' AND o_totalprice > 1000")
def sql_text_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    condition = "o_orderstatus = 'O' AND o_orderpriority LIKE '1-%' AND o_totalprice > 1000"
    return table(spark, sf_dir, "orders").where(condition).select(
        "o_orderkey", "o_totalprice", "o_orderpriority"
    )


@query("SELECT l_returnflag, l_linestatus, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) "
       "AS sum_qty FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_linestatus IN ('F', 'O') "
       "GROUP BY ALL")
def in_list_group_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = F.col("l_returnflag").isin("A", "R") & F.col("l_linestatus").isin("F", "O")
    return (
        table(spark, sf_dir, "lineitem")
        .where(listed)
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("sum_qty"))
    )


# The tables hold no NULL, so orders without priority get one.
UNRANKED = "CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END"


@query(f"SELECT o_orderkey, {UNRANKED} AS priority FROM orders WHERE {UNRANKED} IS NOT NULL")
def not_null_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(UNRANKED).alias("priority"))
    return columns.not_null(ranked, ["priority"])


# Limits and names of the delay bands.
BANDS = """
    CASE WHEN delay > 100 THEN 'Very Long Delay' WHEN delay > 50 THEN 'Long Delay'
         WHEN delay > 10 THEN 'Medium Delay' WHEN delay > 0 THEN 'Tolerable Delay'
         WHEN delay = 0 THEN 'No Delay' ELSE 'Early' END
"""
DELAYS = """
    SELECT event_id, user_id,
           CASE WHEN event_type = 'error' THEN NULL
                WHEN event_type = 'view' THEN value - 10
                WHEN event_type = 'click' THEN 0 ELSE value END AS delay
    FROM events
"""


def _delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values as delays: NULL for errors, early or late for views, none for clicks."""
    value, kind = F.col("value"), F.col("event_type")
    delay = F.when(kind == "view", value - 10).when(kind == "click", 0.0).when(
        kind != "error", value
    )
    return table(spark, sf_dir, "events").select("event_id", "user_id", delay.alias("delay"))


@query(f"SELECT event_id, user_id, delay, {BANDS} AS band FROM ({DELAYS}) d "
       "ORDER BY event_id, delay DESC")
def case_banding_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL form: a NULL delay falls to the last label."""
    name = fresh_name("delays")
    _delays(spark, sf_dir).createOrReplaceTempView(name)
    return spark.sql(
        f"SELECT event_id, user_id, delay, {BANDS} AS band FROM {name} "
        "ORDER BY event_id, delay DESC"
    )


@query(f"SELECT event_id, user_id, delay, {BANDS} AS band FROM ({DELAYS}) d "
       "WHERE delay IS NOT NULL ORDER BY delay DESC, event_id DESC")
def case_banding_notnull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column form over rows without NULL; one expression, no pass over row objects."""
    delays = columns.not_null(_delays(spark, sf_dir), ["event_id", "user_id", "delay"])
    banded = delays.withColumn("band", columns.delay_band(F.col("delay")))
    return banded.orderBy(F.desc("delay"), F.desc("event_id"))


@query("SELECT CASE WHEN c_acctbal > 750 THEN c_acctbal * 0.15::DOUBLE "
       "ELSE c_acctbal * 0.50::DOUBLE END AS value FROM customer")
def conditional_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        columns.usage_cost(F.col("c_acctbal")).alias("value")
    )


@query("SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_acctbal > 750 "
       "THEN c_acctbal * 0.15::DOUBLE ELSE c_acctbal * 0.50::DOUBLE END AS cost FROM customer")
def usage_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return customers.withColumn("cost", columns.usage_cost(F.col("c_acctbal")))
