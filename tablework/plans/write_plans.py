"""Sinks, catalog objects, layout and caches."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.operators.aggregates import exact_sum
from tablework.operators.layout import cached, cached_table
from tablework.plans.registry import query, table
from tablework.plans.scan_plans import orders_by_month
from tablework.sinks import write_external_table, write_managed_table, write_parquet
from tablework.storage import fresh_name, fresh_path, run_database

WHOLE_CUSTOMER = (
    "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment "
    "FROM customer"
)


def _customers(df: DataFrame) -> DataFrame:
    return df.withColumn("c_nationkey", F.col("c_nationkey").cast("bigint"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority "
       "FROM orders")
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "parquet")
    write_parquet(table(spark, sf_dir, "orders"), path)
    return spark.read.parquet(path)


@query(WHOLE_CUSTOMER)
def compressed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "parquet")
    write_parquet(table(spark, sf_dir, "customer"), path, compression="zstd")
    return _customers(spark.read.parquet(path))


@query("SELECT CAST(year(o_orderdate) AS BIGINT) AS order_year, "
       "CAST(month(o_orderdate) AS BIGINT) AS order_month, CAST(COUNT(*) AS BIGINT) AS n_orders, "
       "CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total "
       "FROM orders GROUP BY ALL")
def partitioned_write_year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = spark.read.parquet(orders_by_month(spark, sf_dir))
    return tree.groupBy(
        F.col("order_year").cast("bigint").alias("order_year"),
        F.col("order_month").cast("bigint").alias("order_month"),
    ).agg(F.count(F.lit(1)).alias("n_orders"), exact_sum("o_totalprice", 2).alias("total"))


@query(WHOLE_CUSTOMER)
def managed_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{run_database(spark)}.{fresh_name('customer')}"
    return _customers(write_managed_table(table(spark, sf_dir, "customer"), name))


@query(WHOLE_CUSTOMER)
def external_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{run_database(spark)}.{fresh_name('customer')}"
    path = fresh_path(spark, "external")
    return _customers(write_external_table(table(spark, sf_dir, "customer"), name, path))


@query("SELECT s_nationkey, CAST(COUNT(*) AS BIGINT) AS n_suppliers FROM supplier GROUP BY ALL")
def table_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{run_database(spark)}.{fresh_name('supplier')}"
    write_managed_table(table(spark, sf_dir, "supplier"), name)
    return spark.sql(f"SELECT s_nationkey, COUNT(*) AS n_suppliers FROM {name} GROUP BY 1")


@query("SELECT c_mktsegment, CAST(COUNT(*) AS BIGINT) AS n_customers FROM customer GROUP BY ALL")
def global_view_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view that other sessions on the cluster see as well."""
    name = fresh_name("customer")
    table(spark, sf_dir, "customer").createOrReplaceGlobalTempView(name)
    return spark.newSession().sql(
        f"SELECT c_mktsegment, COUNT(*) AS n_customers FROM global_temp.{name} GROUP BY 1"
    )


def _reuse_counts(df: DataFrame) -> DataFrame:
    """Count twice: the first count fills the cache, the second reads it."""
    counts = [(df.count(), df.count())]
    return df.sparkSession.createDataFrame(counts, "first_count BIGINT, second_count BIGINT")


COUNTED_TWICE = (
    "SELECT CAST(COUNT(*) AS BIGINT) AS first_count, CAST(COUNT(*) AS BIGINT) AS second_count "
    "FROM lineitem"
)


@query(COUNTED_TWICE)
def cached_reuse_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("l_partkey").cast("decimal(19,0)")
    squares = table(spark, sf_dir, "lineitem").select("l_partkey", (key * key).alias("square"))
    with cached(squares) as kept:
        return _reuse_counts(kept)


@query(COUNTED_TWICE)
def persisted_reuse_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cubes as decimals: a bigint cube would overflow for keys above two million."""
    key = F.col("l_partkey").cast("decimal(12,0)")
    cubes = table(spark, sf_dir, "lineitem").select("l_partkey", (key * key * key).alias("cube"))
    with cached(cubes, StorageLevel.DISK_ONLY) as kept:
        return _reuse_counts(kept)


@query("SELECT CAST(COUNT(*) AS BIGINT) AS first_count, CAST(COUNT(*) AS BIGINT) AS second_count "
       "FROM orders")
def cached_table_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = fresh_name("orders")
    table(spark, sf_dir, "orders").createOrReplaceTempView(name)
    try:
        with cached_table(spark, name, lazy=True) as kept:
            return _reuse_counts(kept)
    finally:
        spark.catalog.dropTempView(name)


@query("SELECT l_returnflag, CAST(COUNT(*) AS BIGINT) AS n_lines, "
       "CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total "
       "FROM lineitem GROUP BY ALL")
def repartition_invariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another number of partitions changes files and tasks, not results. The range ends in a
    unique column, so that equal keys can be split."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_extendedprice", "l_orderkey", "l_linenumber"
    )
    width = spark.sparkContext.defaultParallelism
    ranged = lines.repartition(2 * width).repartitionByRange(
        2 * width, "l_orderkey", "l_linenumber"
    )
    return (
        ranged.coalesce(width)
        .groupBy("l_returnflag")
        .agg(F.count(F.lit(1)).alias("n_lines"), exact_sum("l_extendedprice", 2).alias("total"))
    )
