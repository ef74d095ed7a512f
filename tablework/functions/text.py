"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined(*columns: str) -> Column:
    """Columns of any type glued together as text; NULL if one of them is NULL."""
    return F.concat(*[F.col(name).cast("string") for name in columns])


def leading(column: str, length: int) -> Column:
    """First ``length`` characters. Positions count from 1."""
    return F.substring(F.col(column), 1, length)


def whitespace_split(column: str) -> Column:
    """The pieces between single whitespace characters, empty pieces included."""
    return F.split(F.col(column), r"\s")
