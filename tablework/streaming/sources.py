"""File streams. Schemas are given: a stream does not infer them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


# A backlog is taken in batches of this size, so that a failure repeats one of them and not all.
BYTES_PER_BATCH = 2**40


def _reader(spark: SparkSession, schema: StructType | str, files_per_batch: int | None):
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        return reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.option("maxBytesPerTrigger", BYTES_PER_BATCH)


def json_stream(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    arrays: bool = False,
    files_per_batch: int | None = None,
) -> DataFrame:
    """JSON files as they arrive in ``folder``: one object per line, or one array per file."""
    return _reader(spark, schema, files_per_batch).option("multiLine", arrays).json(folder)


def text_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    return _reader(spark, "value string", files_per_batch).text(folder)


def parquet_stream(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    files_per_batch: int | None = None,
) -> DataFrame:
    """A table that another stream appends to, or Parquet files that match a pattern."""
    return _reader(spark, schema, files_per_batch).parquet(folder)
