"""Parquet tables that grow: schema-checked appends, schema evolution, batch and stream loads.

There is no transaction log: one writer at a time, and readers see a load once it has finished.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType

LOAD = "load_name"
BATCH = "load_batch"


class SchemaMismatch(ValueError):
    """Rows do not fit the table they should be appended to."""


def create_table(df: DataFrame, path: str) -> None:
    """First load; an existing table is an error."""
    df.write.mode("errorifexists").parquet(path)


def current(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The table as it is now; rows from before a column existed have NULL there.

    Without ``schema`` the file footers are read to find it, in a job of its own.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)


def append_enforced(df: DataFrame, path: str, schema: StructType | None = None) -> None:
    """Append rows that fit the table. Another column or another type is refused before anything
    is written; a missing column reads as NULL. Pass the table's ``schema`` where it is known, or
    it is found from the footers of all files."""
    _fitting(df, schema or current(df.sparkSession, path).schema).write.mode("append").parquet(path)


def append_evolving(df: DataFrame, path: str, schema: StructType | None = None) -> None:
    """Append rows that may bring new columns, and new fields inside structs, also of those in arrays
    and maps. In older rows they are NULL. A changed type is still refused, at any depth."""
    known = schema or current(df.sparkSession, path).schema
    _fitting(df, known, more=True).write.mode("append").parquet(path)


def merged_type(known: DataType, new: DataType, more: bool, path: str = "") -> DataType:
    """``new`` under the field names of ``known``, which Spark reads without regard to case.

    Changed types are refused and, unless ``more`` are allowed, new fields. Fields may be missing.
    Whether a field, element or value may be NULL is no part of a type: files hold it, tables do not
    enforce it."""
    if isinstance(known, StructType) and isinstance(new, StructType):
        table = {f.name.lower(): f for f in known.fields}
        names = [f.name.lower() for f in new.fields]
        where = f" of {path}" if path else ""
        if len(set(names)) < len(names):
            raise SchemaMismatch(f"columns{where} that differ in case only: {new.fieldNames()}")
        extra = [f.name for f in new.fields if f.name.lower() not in table]
        if extra and not more:
            raise SchemaMismatch(f"columns{where} not in the table: {extra}")
        fields = []
        for f in new.fields:
            own = table.get(f.name.lower(), f)
            inner = f"{path}.{own.name}" if path else own.name
            fields.append(StructField(own.name, merged_type(own.dataType, f.dataType, more, inner)))
        return StructType(fields)
    if isinstance(known, ArrayType) and isinstance(new, ArrayType):
        return ArrayType(merged_type(known.elementType, new.elementType, more, f"{path}[]"))
    if isinstance(known, MapType) and isinstance(new, MapType):
        key = merged_type(known.keyType, new.keyType, more, f"{path}.key")
        return MapType(key, merged_type(known.valueType, new.valueType, more, f"{path}.value"))
    if known.simpleString() != new.simpleString():
        raise SchemaMismatch(
            f"types differ from the table: {path}: {known.simpleString()} -> {new.simpleString()}"
        )
    return new


def _fitting(df: DataFrame, known: StructType, more: bool = False) -> DataFrame:
    """The rows under the table's column and field names. Types that do not fit are refused, see
    ``merged_type``. Fields keep the order they have in ``df``; readers go by name."""
    merged = merged_type(known, df.schema, more)
    columns = []
    for own, new in zip(df.schema.fields, merged.fields):
        column = F.col(f"`{own.name}`")
        if own.dataType.simpleString() != new.dataType.simpleString():
            column = column.cast(new.dataType)  # by position: other spelling of inner names only
        columns.append(column.alias(new.name))
    return df.select(columns)


def _known(spark: SparkSession, path: str) -> StructType | None:
    """Schema of the loads so far; None before the first."""
    try:
        return loaded(spark, path).schema
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def load_once(
    df: DataFrame, path: str, load: str, batch: int = 0, schema: StructType | None = None
) -> None:
    """Write rows as one named batch. Loading the same batch again replaces it. Rows that do not fit
    the table (its ``schema`` or, if not given, that of the loads so far) are refused before
    anything is written."""
    known = schema or _known(df.sparkSession, path)
    fitting = df if known is None else _fitting(df, known)
    (
        fitting.withColumns({LOAD: F.lit(load), BATCH: F.lit(batch)})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(LOAD, BATCH)
        .parquet(path)
    )


def stream_loader(
    path: str, load: str, schema: StructType | None = None
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that adds a stream to a table also loaded in batch.

    A batch that runs again after a failure replaces itself, so batch readers see each row once.
    With the table's ``schema`` no batch has to look for it in the files.
    A stream must not read such a table: it would take the replacing files for new rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        load_once(batch, path, load, batch_id, schema)

    return write


def loaded(spark: SparkSession, path: str) -> DataFrame:
    """All loads of a table, without the load columns."""
    return current(spark, path).drop(LOAD, BATCH)
