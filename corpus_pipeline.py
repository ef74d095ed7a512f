"""A training corpus from raw documents: quality rules, line dedup, near-duplicate join, benchmark
decontamination, packing. Each stage reads what the one before has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablework.llm import decontaminate, jaccard_join, line_dedup, packing, quality_rules
from tablework.llm.shared import ARROW_ROWS, TEXTS_PER_BATCH, documents, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go. Whoever writes the result does so in batches of
    bounded size: ``run`` and ``written`` set them for their time, a caller of the stage keeps them."""
    rows = int(spark.conf.get(ARROW_ROWS))
    spark.conf.set(ARROW_ROWS, str(min(rows, TEXTS_PER_BATCH) if rows > 0 else TEXTS_PER_BATCH))
    return quality_rules.passing(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of many documents stay in one of them."""
    return line_dedup.without_shared_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links connect, the one with the smallest doc_id stays."""
    return jaccard_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_benchmark(docs, benchmark)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become pieces of training sequences."""
    return packing.packed(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", sequences),
]

# Near-copy components and SimHash candidates have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs, rows = documents(spark, sf_dir), spark.conf.get(ARROW_ROWS)
    try:
        for name, stage in STAGES:
            docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    finally:
        spark.conf.set(ARROW_ROWS, rows)
    return docs
