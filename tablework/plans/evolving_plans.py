"""Tables that grow by batch and stream."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.functions.text import whitespace_split
from tablework.operators import evolving
from tablework.plans.registry import query, table
from tablework.sinks.files import write_json_lines
from tablework.storage import fresh_path
from tablework.streaming.runner import run_available, stream_session
from tablework.streaming.sources import json_stream


@query("SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal "
       "FROM supplier")
def table_create_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "growing")
    evolving.create_table(_suppliers(spark, sf_dir), path)
    return evolving.current(spark, path)


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier")
    return suppliers.withColumn("s_nationkey", F.col("s_nationkey").cast("bigint"))


@query("""
    SELECT s_suppkey, s_name, s_acctbal FROM supplier
    UNION ALL SELECT s_suppkey, s_name, CAST(NULL AS DOUBLE) FROM supplier
""")
def append_enforced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second load lacks a column, which is allowed; one too many would be refused."""
    path = fresh_path(spark, "growing")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    evolving.create_table(suppliers, path)
    evolving.append_enforced(suppliers.drop("s_acctbal"), path)
    return evolving.current(spark, path, suppliers.schema)


@query("""
    SELECT s_suppkey, s_acctbal, CAST(NULL AS DOUBLE) AS new_balance FROM supplier
    UNION ALL SELECT s_suppkey, s_acctbal, s_acctbal AS new_balance FROM supplier
""")
def append_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "growing")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    evolving.create_table(suppliers, path)
    evolving.append_evolving(suppliers.withColumn("new_balance", F.col("s_acctbal")), path)
    return evolving.current(spark, path)


@query("""
    SELECT conv_id, role, turn, text, CAST(NULL AS DOUBLE) AS n_chars, CAST(NULL AS VARCHAR) AS mark
    FROM conversations
    UNION ALL
    SELECT conv_id, role, turn, text, CAST(length(text) AS DOUBLE), upper(role) FROM conversations
""")
def append_evolve_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as structs with an array of marks. The second load has one more field in each; rows of
    the first one have NULL there."""
    path = fresh_path(spark, "growing")
    turns = table(spark, sf_dir, "conversations")
    told = [F.col("turn").alias("turn"), F.col("text").alias("text")]
    mark = [F.col("role").alias("role")]
    first = turns.select(
        "conv_id", F.struct(*told).alias("said"), F.array(F.struct(*mark)).alias("marks")
    )
    evolving.create_table(first, path)
    told.append(F.length("text").cast("double").alias("n_chars"))
    mark.append(F.upper("role").alias("mark"))
    second = turns.select(
        "conv_id", F.struct(*told).alias("said"), F.array(F.struct(*mark)).alias("marks")
    )
    evolving.append_evolving(second, path)
    return evolving.current(spark, path).select(
        "conv_id", F.col("marks")[0]["role"].alias("role"), "said.turn", "said.text", "said.n_chars",
        F.col("marks")[0]["mark"].alias("mark"),
    )


@query("SELECT * FROM orders")
def batch_plus_stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old orders are loaded in batch, newer ones by a stream into the same table."""
    orders = table(spark, sf_dir, "orders")
    # Orders without a date are history.
    newer = F.coalesce(F.col("o_orderdate") >= F.lit("2000-01-01").cast("date"), F.lit(False))
    inbox, path = fresh_path(spark, "inbox"), fresh_path(spark, "growing")
    evolving.load_once(orders.where(~newer), path, "history")
    arriving = orders.where(newer)
    write_json_lines(arriving, inbox)
    stream = json_stream(stream_session(spark), inbox, arriving.schema)
    run_available(
        stream.writeStream.option("checkpointLocation", fresh_path(spark, "checkpoint"))
        .foreachBatch(evolving.stream_loader(path, "stream"))
    )
    return evolving.loaded(spark, path)


@query(r"""
    SELECT doc_id, CAST(len(string_split_regex(text, '\s')) AS BIGINT) AS n_words
    FROM (SELECT * FROM documents UNION ALL SELECT * FROM documents) twice
""")
def append_enforced_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column of arrays; the same rows fit the table that was made from them."""
    path = fresh_path(spark, "growing")
    words = table(spark, sf_dir, "documents").select("doc_id", whitespace_split("text").alias("words"))
    evolving.create_table(words, path)
    evolving.append_enforced(words, path)
    n_words = F.size("words").cast("bigint").alias("n_words")
    return evolving.current(spark, path).select("doc_id", n_words)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def stream_load_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders are loaded in batch; a stream that brings the price as text is refused before anything
    is written, and the table reads as before."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    inbox, path = fresh_path(spark, "inbox"), fresh_path(spark, "growing")
    evolving.load_once(orders, path, "history")
    unfit = orders.withColumn("o_totalprice", F.col("o_totalprice").cast("string"))
    unfit.write.json(inbox)
    stream = json_stream(stream_session(spark), inbox, unfit.schema)
    try:
        run_available(
            stream.writeStream.option("checkpointLocation", fresh_path(spark, "checkpoint"))
            .foreachBatch(evolving.stream_loader(path, "stream", orders.schema))
        )
    except StreamingQueryException as error:
        if "types differ" not in str(error):
            raise
    else:
        raise RuntimeError("a batch that does not fit was loaded")
    return evolving.loaded(spark, path)
