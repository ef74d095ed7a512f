"""Structured Streaming: each result equals that of the batch query on the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.functions.text import leading, whitespace_split
from tablework.plans.registry import query, table
from tablework.sinks.files import write_json_lines
from tablework.storage import fresh_path
from tablework.streaming.flow import LandingFlow, gate, gated
from tablework.streaming.runner import run_available, run_every, stream_session
from tablework.streaming.running import running_totals
from tablework.streaming.sinks import (
    append_files,
    latest_complete,
    latest_update,
    publish_base,
    publish_running,
)
from tablework.streaming.sources import json_stream, parquet_stream

def _event_inbox(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    events = table(spark, sf_dir, "events")
    inbox = fresh_path(spark, "inbox")
    write_json_lines(events, inbox)
    return inbox, events


@query("SELECT * FROM events")
def stream_json_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    inbox, events = _event_inbox(spark, sf_dir)
    path = fresh_path(spark, "landing")
    stream = json_stream(stream_session(spark), inbox, events.schema)
    run_available(append_files(stream, path, fresh_path(spark, "checkpoint")))
    return spark.read.parquet(path)


def _table_stream(
    spark: SparkSession, sf_dir: str, name: str, many_keys: bool = False
) -> DataFrame:
    schema = table(spark, sf_dir, name).schema
    return parquet_stream(stream_session(spark, many_keys), f"{sf_dir}/{name}.parque[t]", schema)


@query("SELECT event_type, CAST(COUNT(*) AS BIGINT) AS count FROM events GROUP BY ALL")
def stream_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _table_stream(spark, sf_dir, "events").groupBy("event_type").count()
    path = fresh_path(spark, "result")
    run_available(publish_running(counts, path, fresh_path(spark, "checkpoint")))
    return latest_complete(spark, path)


@query(r"""
    SELECT word, CAST(COUNT(*) AS BIGINT) AS count
    FROM (SELECT unnest(string_split_regex(text, '\s')) AS word FROM documents) words
    WHERE word <> '' GROUP BY word
""")
def stream_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many keys: each batch publishes only the words whose count changed."""
    texts = _table_stream(spark, sf_dir, "documents", many_keys=True)
    words = texts.select(F.explode(whitespace_split("text")).alias("word")).where("word <> ''")
    path = fresh_path(spark, "result")
    counts = words.groupBy("word").count()
    run_available(publish_running(
        counts, path, fresh_path(spark, "checkpoint"), mode="update", keys=["word"]
    ))
    return latest_update(spark, path, ["word"])


@query("SELECT event_type, CAST(COUNT(*) AS BIGINT) AS count FROM events GROUP BY ALL")
def two_stage_stream_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    inbox, events = _event_inbox(spark, sf_dir)
    flow = LandingFlow(
        events.schema, lambda df: df.groupBy("event_type").count(), inbox, fresh_path(spark, "flow")
    )
    flow.run(stream_session(spark))
    return latest_complete(spark, flow.result)


@query("SELECT event_type, CAST(COUNT(*) AS BIGINT) AS count FROM events GROUP BY ALL")
def two_stage_stream_handover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both streams at work at once; the second stops when it has read what the first committed."""
    inbox, events = _event_inbox(spark, sf_dir)
    flow = LandingFlow(
        events.schema, lambda df: df.groupBy("event_type").count(), inbox,
        fresh_path(spark, "flow"), files_per_batch=4,
    )
    flow.run_together(stream_session(spark))
    return latest_complete(spark, flow.result)


@query(r"""
    SELECT initial, CAST(COUNT(*) AS BIGINT) AS count, CAST(SUM(strlen(word)) AS BIGINT) AS bytes
    FROM (
        SELECT word, substring(word, 1, 2) AS initial FROM (
            SELECT unnest(string_split_regex(text, '\s')) AS word FROM documents
            UNION ALL SELECT unnest(string_split_regex(html, '\s')) FROM pages
        ) both_tables
    ) words
    WHERE word <> '' GROUP BY initial
""")
def stream_totals_from_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words by their first two characters: totals of the documents are a batch result; the stream
    of pages goes on from them."""
    def words(df: DataFrame, column: str) -> DataFrame:
        found = df.select(F.explode(whitespace_split(column)).alias("word")).where("word <> ''")
        return found.withColumn("initial", leading("word", 2))

    session, path, keys = stream_session(spark, many_keys=True), fresh_path(spark, "result"), ["initial"]
    totals = {"count": F.lit(1), "bytes": F.octet_length("word")}
    sums = [F.sum(amount).cast("long").alias(name) for name, amount in totals.items()]
    publish_base(words(table(session, sf_dir, "documents"), "text").groupBy(*keys).agg(*sums), path)
    start = latest_update(session, path, keys)
    pages = parquet_stream(session, f"{sf_dir}/pages.parque[t]", table(session, sf_dir, "pages").schema)
    running = running_totals(words(pages, "html"), keys, totals, start)
    run_available(publish_running(
        running, path, fresh_path(spark, "checkpoint"), mode="update", keys=keys
    ))
    return latest_update(spark, path, keys)


@query("SELECT *, CASE WHEN value > 10 THEN 'valid' ELSE 'quarantine' END AS side "
       "FROM events")
def quality_gate_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    inbox, events = _event_inbox(spark, sf_dir)
    path = fresh_path(spark, "gated")
    stream = json_stream(stream_session(spark), inbox, events.schema)
    run_available(gate(stream, F.col("value") > 10, path, fresh_path(spark, "checkpoint")))
    sides = {"valid": gated(spark, path, True), "quarantine": gated(spark, path, False)}
    columns = [
        df.withColumn("side", F.lit(side)) for side, df in sides.items()
    ]
    return columns[0].unionByName(columns[1])


@query("SELECT * FROM events")
def stream_every_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that starts a batch every second, stopped once the inbox is consumed."""
    inbox, events = _event_inbox(spark, sf_dir)
    path = fresh_path(spark, "landing")
    stream = json_stream(stream_session(spark), inbox, events.schema)
    running = run_every(append_files(stream, path, fresh_path(spark, "checkpoint")), "1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.parquet(path)
