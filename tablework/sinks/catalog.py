"""Tables in the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_managed_table(df: DataFrame, name: str, mode: str = "errorifexists") -> DataFrame:
    """Managed table ``database.table``; by default an existing one is an error."""
    df.write.format("parquet").mode(mode).saveAsTable(name)
    return df.sparkSession.table(name)


def write_external_table(
    df: DataFrame, name: str, path: str, mode: str = "errorifexists"
) -> DataFrame:
    """Table whose files stay at ``path`` when the table is dropped."""
    df.write.format("parquet").mode(mode).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)
