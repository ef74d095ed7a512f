"""Ranks, sorts, top rows and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.operators.ranking import dense_rank_all, top_dense_rank, top_rows
from tablework.plans.registry import query, table

SUPPLIER_TOTALS = """
    SELECT CAST(s_nationkey AS BIGINT) AS nation, s_suppkey AS supplier,
           CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2
"""


@query(f"""
    SELECT nation, supplier, quantity, rank FROM (
        SELECT nation, supplier, quantity,
               CAST(dense_rank() OVER (PARTITION BY nation ORDER BY quantity DESC) AS BIGINT)
                   AS rank
        FROM ({SUPPLIER_TOTALS}) totals) ranked
    WHERE rank <= 3
""")
def top3_dense_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with one of the three largest quantities of their nation. Lines are summed per
    supplier before the join, so that the join sees one row per supplier."""
    sold = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("supplier"))
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.col("s_nationkey").cast("bigint").alias("nation")
    )
    totals = sold.join(suppliers, F.col("supplier") == F.col("s_suppkey")).select(
        "nation", "supplier", "quantity"
    )
    return top_dense_rank(totals, "nation", "quantity", 3)


@query("""
    SELECT l_orderkey, l_linenumber, l_extendedprice,
           CAST(dense_rank() OVER (ORDER BY l_extendedprice DESC NULLS LAST) AS BIGINT) AS rank
    FROM lineitem
""")
def dense_rank_all_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line's rank by price among all lines."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return dense_rank_all(lines, "l_extendedprice")


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders "
       "ORDER BY o_totalprice DESC, o_orderkey")
def sort_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey")


@query("SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id DESC LIMIT 20")
def sort_desc_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return top_rows(documents, 20, F.desc("doc_id"))


@query("SELECT event_type, value, event_id FROM events "
       "ORDER BY event_type, value DESC, event_id LIMIT 10")
def multi_key_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_type", "value", "event_id")
    return top_rows(events, 10, F.asc("event_type"), F.desc("value"), F.asc("event_id"))


@query("""
    WITH urgent AS (SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
                    WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 400000),
         both_parts AS (SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
                        UNION ALL SELECT * FROM urgent)
    SELECT o_orderkey, o_orderpriority, o_totalprice FROM both_parts
    WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 400000
""")
def union_all_refilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table and its own filtered rows: filtered again, each comes twice."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    urgent = F.expr("o_orderpriority = '1-URGENT' AND o_totalprice > 400000")
    return orders.union(orders.where(urgent)).where(urgent)
