"""Sources: the tables are written in each format and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.functions.temporal import DAY_LAYOUT, SECOND_LAYOUT
from tablework.functions.text import whitespace_split
from tablework.operators.columns import recast
from tablework.plans.registry import query, table
from tablework.sinks import write_json_arrays, write_partitioned, write_tsv
from tablework.sources import (
    file_view,
    generated_rows,
    label_for,
    read_csv,
    read_json_array_lines,
    read_json_arrays,
    read_json_lines,
    read_parquet,
    read_partitions,
    read_split_json_arrays,
    read_text,
    read_tsv,
    rows_to_table,
)
from tablework.storage import fresh_name, fresh_path

DOCUMENT_RECORD = """
    doc_id BIGINT NOT NULL, words ARRAY<STRING> NOT NULL, source STRING NOT NULL,
    n_chars BIGINT NOT NULL
"""
BYTES_PER_DOCUMENT_ARRAY = 128 * 1024 * 1024  # hundreds of ranges; a file has one writer
LABELS = ("north", "east", "south", "west", "centre")


@query("SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, "
       "c_mktsegment FROM customer")
def csv_roundtrip_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "csv")
    table(spark, sf_dir, "customer").write.option("header", True).csv(path)
    inferred = read_csv(spark, path, infer=True)
    return recast(inferred, {"c_custkey": "bigint", "c_nationkey": "bigint"})


@query("SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, "
       "p_retailprice FROM part")
def csv_all_string_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "csv")
    table(spark, sf_dir, "part").write.option("header", True).csv(path)
    types = {"p_partkey": "bigint", "p_size": "bigint", "p_retailprice": "double"}
    return recast(read_csv(spark, path), types)


@query("SELECT o_orderkey, o_custkey, o_totalprice, "
       "strftime(o_orderdate, '%Y-%m-%d') AS order_day, "
       "o_orderdate + INTERVAL 13 HOUR AS closed_at, o_orderpriority FROM orders")
def csv_ddl_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "csv")
    closed = F.col("o_orderdate") + F.expr("INTERVAL 13 HOURS")
    table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        F.date_format("o_orderdate", DAY_LAYOUT).alias("order_day"),
        F.date_format(closed, SECOND_LAYOUT).alias("closed_at"),
        "o_orderpriority",
    ).write.option("header", True).csv(path)
    record = """
        o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, order_day DATE,
        closed_at TIMESTAMP_NTZ, o_orderpriority STRING
    """
    rows = read_csv(
        spark, path, schema=record, date_format=DAY_LAYOUT, timestamp_format=SECOND_LAYOUT
    )
    return recast(rows, {"order_day": "string"})


@query("SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal "
       "FROM supplier")
def tsv_cr_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "tsv")
    write_tsv(table(spark, sf_dir, "supplier"), path, line_end="\r")
    return recast(read_tsv(spark, path), {"s_suppkey": "bigint", "s_nationkey": "bigint"})


def _document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", whitespace_split("text").alias("words"), "source", "n_chars"
    )


@query(r"""
    SELECT doc_id, CAST(len(string_split_regex(text, '\s')) AS BIGINT) AS n_words, source, n_chars
    FROM documents
""")
def json_lines_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "json")
    _document_records(spark, sf_dir).write.json(path)
    rows = read_json_lines(spark, path, DOCUMENT_RECORD)
    n_words = F.size("words").cast("bigint").alias("n_words")
    return rows.select("doc_id", n_words, "source", "n_chars")


@query("SELECT * FROM events")
def json_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "json-arrays")
    events = table(spark, sf_dir, "events")
    write_json_arrays(events, path)
    return read_json_arrays(spark, path, events.schema)


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def json_array_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as arrays in large files, one file until that takes its only writer too much, with
    line ends, quotes and brackets in their texts. Each file is read by several tasks."""
    path = fresh_path(spark, "json-arrays")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    write_json_arrays(documents, path, rows_per_file=10**12, bytes_per_file=BYTES_PER_DOCUMENT_ARRAY)
    return read_split_json_arrays(spark, path, documents.schema, 256 * 1024)


@query(r"""
    SELECT doc_id, CAST(len(string_split_regex(text, '\s')) AS BIGINT) AS n_words, source, n_chars
    FROM documents
""")
def json_array_linemode_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "json-arrays")
    write_json_arrays(_document_records(spark, sf_dir), path)
    rows = read_json_array_lines(spark, path, DOCUMENT_RECORD, "doc_id")
    n_words = F.size("words").cast("bigint").alias("n_words")
    return rows.select("doc_id", n_words, "source", "n_chars")


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as text files: one row per line."""
    path = fresh_path(spark, "text")
    table(spark, sf_dir, "documents").select("text").write.text(path)
    return read_text(spark, path)


@query("""
    SELECT CAST(SUM(length(text) - length(replace(text, chr(10), '')) + 1) AS BIGINT) AS n_lines
    FROM documents
""")
def text_line_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_lines(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_lines"))


@query("SELECT CAST(COUNT(*) AS BIGINT) AS n_rows FROM lineitem")
def parquet_scan_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_parquet(spark, f"{sf_dir}/lineitem.parquet")
    return lines.agg(F.count(F.lit(1)).alias("n_rows"))


@query("SELECT o_orderstatus, o_orderpriority, CAST(COUNT(*) AS BIGINT) AS n_orders "
       "FROM orders GROUP BY ALL")
def partitioned_scan_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "tree")
    orders = table(spark, sf_dir, "orders")
    write_partitioned(orders, path, "o_orderstatus", "o_orderpriority")
    by = ["o_orderstatus", "o_orderpriority"]
    return read_parquet(spark, path).groupBy(*by).agg(F.count(F.lit(1)).alias("n_orders"))


def orders_by_month(spark: SparkSession, sf_dir: str) -> str:
    """The orders as a tree of year and month folders."""
    path = fresh_path(spark, "tree")
    dated = table(spark, sf_dir, "orders").withColumns(
        {"order_year": F.year("o_orderdate"), "order_month": F.month("o_orderdate")}
    )
    write_partitioned(dated, path, "order_year", "order_month")
    return path


@query("SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS BIGINT) AS order_year, "
       "CAST(month(o_orderdate) AS BIGINT) AS order_month FROM orders "
       "WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 1")
def partition_pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    january = (F.col("order_year") == 1998) & (F.col("order_month") == 1)
    rows = read_partitions(spark, orders_by_month(spark, sf_dir), january)
    rows = rows.select("o_orderkey", "o_totalprice", "order_year", "order_month")
    return recast(rows, {"order_year": "bigint", "order_month": "bigint"})


@query("SELECT p_brand, p_type, CAST(COUNT(*) AS BIGINT) AS n_parts FROM part GROUP BY ALL")
def sql_file_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = file_view(spark, fresh_name("part_files"), f"{sf_dir}/part.parquet")
    return parts.groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n_parts"))


@query("""
    SELECT c_custkey AS id, c_name,
           CAST(CAST(c_custkey AS DECIMAL(19,0)) * CAST(c_custkey AS DECIMAL(19,0)) AS VARCHAR)
               AS square,
           ['north', 'east', 'south', 'west', 'centre'][CAST(c_custkey % 5 AS INTEGER) + 1] AS label
    FROM customer
""")
def range_square(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated rows up to the largest customer number, joined to the customers they stand for."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    last = customers.agg(F.max("c_custkey")).first()[0]
    wide = F.col("id").cast("decimal(19,0)")
    rows = generated_rows(
        spark, last + 1, square=(wide * wide).cast("string"), label=label_for(F.col("id"), LABELS)
    )
    return rows.join(customers, rows["id"] == customers["c_custkey"]).drop("c_custkey")


@query("""
    SELECT doc_id, CASE WHEN n_chars * 1000000 <= 2147483647 THEN n_chars * 1000000 ELSE -1 END
           AS micros, source
    FROM documents
""")
def json_array_linemode_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A number that does not fit its field is NULL, and its row stays."""
    path = fresh_path(spark, "json-arrays")
    micros = (F.col("n_chars") * 1_000_000).alias("micros")
    write_json_arrays(table(spark, sf_dir, "documents").select("doc_id", micros, "source"), path)
    rows = read_json_array_lines(
        spark, path, "doc_id bigint, micros int, source string", "doc_id", corrupt="line"
    )
    micros = F.coalesce(F.col("micros").cast("bigint"), F.lit(-1)).alias("micros")
    return rows.select("doc_id", micros, "source")


@query("""
    SELECT doc_id, language, source
    FROM documents JOIN (VALUES ('en', 'English'), ('de', 'German'), ('fr', 'French'),
                                ('es', 'Spanish')) names(code, language) ON lang = code
""")
def in_memory_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A short list of names as a table, joined to the documents."""
    names = rows_to_table(
        spark,
        [("en", "English"), ("de", "German"), ("fr", "French"), ("es", "Spanish")],
        "code string, language string",
    )
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    joined = documents.join(names, documents["lang"] == names["code"])
    return joined.select("doc_id", "language", "source")
