"""Batch file sinks."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", compression: str = "snappy"
) -> None:
    df.write.mode(mode).option("compression", compression).parquet(path)


def write_partitioned(df: DataFrame, path: str, *by: str, mode: str = "overwrite") -> None:
    """Parquet tree with one folder per value of ``by``.

    Rows are brought together by partition first, so that a task writes few files. The rebalance
    hint lets adaptive execution cut a large partition over several tasks and join small ones, so
    one partition with much of the data does not land in one task.
    """
    df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).parquet(path)


def write_tsv(df: DataFrame, path: str, line_end: str = "\n") -> None:
    df.write.option("header", True).option("sep", "\t").option("lineSep", line_end).csv(path)


ROWS_PER_ARRAY = 500_000
BYTES_PER_ARRAY = 128 * 1024 * 1024
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BYTES_PER_BATCH = 4 * 1024 * 1024  # a batch is held several times on its way through Python
# Times with all their digits; Spark's own layout ends at milliseconds.
JSON_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
JSON_OPTIONS = {"ignoreNullFields": "false", **JSON_TIMES}


def write_json_lines(df: DataFrame, path: str) -> None:
    """One JSON object per line."""
    df.write.options(**JSON_TIMES).json(path)


def write_json_arrays(
    df: DataFrame, path: str, rows_per_file: int = ROWS_PER_ARRAY, bytes_per_file: int = BYTES_PER_ARRAY
) -> None:
    """A folder of files that each hold one JSON array, one object per line.

    Spark's own reader takes such a file in one task, so rows and bytes are counted and rows dealt
    evenly to as many files as it takes for none to hold much more than either bound.
    """
    lines = df.select(F.to_json(F.struct("*"), JSON_OPTIONS).alias("value"))
    size = lines.agg(F.count("*").alias("rows"), F.sum(F.octet_length("value")).alias("bytes")).first()
    files = max(1, math.ceil(size["rows"] / rows_per_file), math.ceil((size["bytes"] or 0) / bytes_per_file))
    spark = df.sparkSession
    most = spark.conf.get(ARROW_BYTES)
    spark.conf.set(ARROW_BYTES, str(BYTES_PER_BATCH))
    try:
        lines.repartition(files).mapInArrow(_as_array_lines, "value string").write.text(path)
    finally:
        spark.conf.set(ARROW_BYTES, most)


def _as_array_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wrap the objects of one partition in brackets, with a comma after all but the last. Texts stay
    in Arrow: as Python strings they would take several times the memory."""
    last = None
    for batch in batches:
        objects = batch.column("value")
        if not len(objects):
            continue
        before = "[" if last is None else last + ","
        yield _lines(pa.array([before], objects.type))
        yield _lines(pc.binary_join_element_wise(objects[:-1], ",", ""))
        last = objects[-1].as_py()
    if last is not None:
        yield _lines(pa.array([last, "]"]))


def _lines(values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([values], ["value"])
