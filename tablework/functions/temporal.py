"""Dates and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text layouts of dates and of timestamps with a half-day marker.
DAY_LAYOUT = "MM/dd/yyyy"
SECOND_LAYOUT = "MM/dd/yyyy hh:mm:ss a"


def parsed_timestamp(column: str, layout: str) -> Column:
    """Timestamp from text; NULL where the text does not fit the layout."""
    return F.try_to_timestamp(F.col(column), F.lit(layout))


def calendar_part(column: str, part: str) -> Column:
    """``year``, ``month`` or ISO ``week`` number, as bigint."""
    parts = {"year": F.year, "month": F.month, "week": F.weekofyear}
    return parts[part](F.col(column)).cast("bigint")


def in_year(column: str, year: int) -> Column:
    """Whether a date or time lies in a year, as a range that reaches the scan's row groups."""
    return (F.col(column) >= F.lit(f"{year}-01-01").cast("date")) & (
        F.col(column) < F.lit(f"{year + 1}-01-01").cast("date")
    )
