"""Tables by name, file views, in-memory rows and generated rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def file_view(spark: SparkSession, name: str, path: str, file_format: str = "parquet") -> DataFrame:
    """Declare files as a temporary SQL view and read it by name."""
    quoted = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW `{name}` USING {file_format} OPTIONS (path '{quoted}')"
    )
    return spark.table(name)


def rows_to_table(
    spark: SparkSession, rows: Sequence[tuple], schema: StructType | str | list[str]
) -> DataFrame:
    """Small in-memory rows as a table: ``schema`` gives names only, or names and types."""
    return spark.createDataFrame(list(rows), schema)


ROWS_PER_TASK = 10_000_000


def generated_rows(spark: SparkSession, count: int, **columns: Column) -> DataFrame:
    """``count`` rows with ids from 0, made in the executors; ``columns`` derive from ``id``."""
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(count / ROWS_PER_TASK))
    return spark.range(0, count, 1, tasks).withColumns(columns)


def label_for(number: Column, labels: Sequence[str]) -> Column:
    """One of ``labels``, chosen by ``number``; every label can occur."""
    choices = F.array(*[F.lit(label) for label in labels])
    position = F.pmod(number, F.lit(len(labels))).cast("int") + 1
    return F.element_at(choices, position)
