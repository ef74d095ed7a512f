"""Array and struct expressions that stay inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Celsius to Fahrenheit.
FAHRENHEIT_FACTOR = 1.8
FAHRENHEIT_OFFSET = 32


def to_fahrenheit(values: Column) -> Column:
    return F.transform(values, lambda t: t * FAHRENHEIT_FACTOR + FAHRENHEIT_OFFSET)


def above(values: Column, threshold: float) -> Column:
    return F.filter(values, lambda v: v > threshold)


def any_above(values: Column, threshold: float) -> Column:
    return F.exists(values, lambda v: v > threshold)


def array_total(values: Column) -> Column:
    """Sum of a double array, added up from the left; NULL elements count as 0."""
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + F.coalesce(v, F.lit(0.0)))


def scaled_fields(record: Column, factors: Mapping[str, float]) -> Column:
    """The same struct with some numeric fields multiplied."""
    for field, factor in factors.items():
        record = record.withField(field, record[field] * F.lit(factor))
    return record
