"""Order-aware deduplication of two grouped tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.operators.dedup import greedy_dedup
from tablework.plans.registry import query, table

SECOND_HALF = "2024-01-16"
DISTANCE = 5.0  # fixed value

# In DuckDB a list is folded per user: a value joins the kept ones if none of them is close.
GREEDY_SQL = f"""
    WITH ordered AS (
        SELECT user_id, list([value] ORDER BY ts >= TIMESTAMP '{SECOND_HALF}', event_id) AS steps
        FROM events GROUP BY user_id),
    folded AS (
        SELECT user_id,
               list_reduce(steps, lambda kept, one:
                   CASE WHEN len(list_filter(kept, lambda k: abs(k - one[1]) < 5)) > 0
                        THEN kept ELSE list_concat(kept, one) END,
                   []::DOUBLE[]) AS kept
        FROM ordered)
    SELECT user_id, unnest(kept) AS value FROM folded
"""


def _dedup(spark: SparkSession, sf_dir: str, method: str) -> DataFrame:
    """Events of the first half of the month come before those of the second."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    second_half = F.col("ts") >= F.lit(SECOND_HALF).cast("timestamp_ntz")
    kept = greedy_dedup(
        events.where(~second_half), events.where(second_half), "user_id", "value", "event_id",
        DISTANCE,
        method,
    )
    return kept.select("user_id", "value")


@query(GREEDY_SQL)
def cogroup_greedy_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dedup(spark, sf_dir, "native")


@query(GREEDY_SQL)
def cogroup_python_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a Python function over the two grouped sides."""
    return _dedup(spark, sf_dir, "cogroup")
