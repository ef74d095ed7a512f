"""Batch file scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

Schema = StructType | str


def read_csv(
    spark: SparkSession,
    path: str,
    schema: Schema | None = None,
    infer: bool = False,
    sampling_ratio: float | None = None,
    sep: str = ",",
    date_format: str | None = None,
    timestamp_format: str | None = None,
) -> DataFrame:
    """CSV with a header row.

    With ``schema`` the types are fixed and the file is read once. With ``infer`` Spark makes an
    extra pass over the share ``sampling_ratio`` of the rows. With neither, every column is text.
    Dates and timestamps in other than ISO form need their format, or they read as NULL.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if date_format:
        reader = reader.option("dateFormat", date_format)
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format)
        reader = reader.option("timestampNTZFormat", timestamp_format)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
        if sampling_ratio is not None:
            reader = reader.option("samplingRatio", sampling_ratio)
    return reader.csv(path)


def read_tsv(
    spark: SparkSession, path: str, schema: Schema | None = None, infer: bool = True
) -> DataFrame:
    """Tab-separated text with a header row, whatever the extension; LF, CRLF or bare CR lines."""
    return read_csv(spark, path, schema=schema, infer=infer, sep="\t")


def read_json_lines(spark: SparkSession, path: str, schema: Schema | None = None) -> DataFrame:
    """One JSON object per line. Files split, so any size of file scales."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_json_arrays(spark: SparkSession, path: str, schema: Schema | None = None) -> DataFrame:
    """Files that each hold one JSON document or array over several lines.

    Such a file is one task here; ``read_split_json_arrays`` reads large ones by byte ranges, and
    ``sinks.write_json_arrays`` writes a folder of bounded files.
    """
    reader = spark.read.option("multiLine", True)
    return (reader if schema is None else reader.schema(schema)).json(path)


def read_json_array_lines(
    spark: SparkSession, path: str, schema: Schema, key: str, corrupt: str | None = None
) -> DataFrame:
    """Array files with one object per line, read line by line so that they split.

    A field that does not fit its type is NULL and its row stays. Rows whose ``key`` is NULL go,
    as the lines of the brackets do. With ``corrupt`` nothing but the brackets goes: a column of
    that name has the text of lines that do not fit the schema.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if corrupt is None:
        return spark.read.schema(schema).json(path).where(F.col(key).isNotNull())
    reader = spark.read.schema(StructType([*schema.fields, StructField(corrupt, StringType())]))
    rows = reader.option("columnNameOfCorruptRecord", corrupt).json(path)
    bracket = F.trim(corrupt).isin("[", "]")
    return rows.where(F.col(key).isNotNull() | ~F.coalesce(bracket, F.lit(False)))


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line in column ``value``."""
    return spark.read.text(path)


def read_parquet(
    spark: SparkSession, path: str, schema: Schema | None = None, merge_schema: bool = False
) -> DataFrame:
    """A file, a folder or a partitioned tree; partition columns come from the folder names."""
    reader = spark.read.option("mergeSchema", merge_schema)
    return (reader if schema is None else reader.schema(schema)).parquet(path)


def read_partitions(spark: SparkSession, root: str, condition: Column | str) -> DataFrame:
    """Some partitions of a tree, with the partition columns kept.

    Only the folders that meet ``condition`` are read, as if they had been named one by one.
    """
    return spark.read.option("basePath", root).parquet(root).where(condition)
