"""Labelled rows for training: a bounded sample, the same on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the doc_id as text, modulo n."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(n))


def labelled_sample(labels: DataFrame, label: str, rows: int, n: int, held_out: int) -> DataFrame:
    """At most ``rows`` rows (doc_id, label) that are not held out, in an order by hash."""
    own = labels.select(
        labels["doc_id"].cast("long").alias("doc_id"), labels[label].cast("int").alias("label")
    )
    own = own.where("doc_id IS NOT NULL AND label IN (0, 1)")
    own = own.where(remainder(F.col("doc_id"), n) != held_out)
    return own.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(
        F.xxhash64("doc_id"), "doc_id"
    ).limit(rows)
