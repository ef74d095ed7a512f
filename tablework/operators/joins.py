"""Inner joins with a chosen strategy, and the interval (theta) join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 10 * 1024 * 1024
BROADCAST_ROWS = 64
# Exponent of the smallest bin width, and bits of a bin number at most.
NARROWEST_BIN = -20
DOUBLE_BITS = 50
ODD_LEVEL = -5000


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate: file sizes for scans, an upper bound for most plans above them."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def equi_join(
    left: DataFrame, right: DataFrame, on: Column | str | list[str], strategy: str | None = None
) -> DataFrame:
    """Inner equi-join; duplicate keys fan out.

    Without ``strategy`` Catalyst broadcasts a side below its size threshold and otherwise sorts
    and merges; adaptive execution revises that on real sizes and splits hot keys.

    ``broadcast``    broadcasts ``right`` if it is planned and then measured to be within
                     ``BROADCAST_BYTES``, and else merges
    ``merge``        sorts and merges, whatever the sizes
    ``shuffle_hash`` shuffles both sides and builds the hash table from ``right``, whose keys
                     should therefore be (nearly) unique
    """
    if strategy == "broadcast":
        small = planned_bytes(right) <= BROADCAST_BYTES and text_bytes(right) <= BROADCAST_BYTES
        strategy = "broadcast" if small else "merge"
    if strategy is not None:
        right = right.hint(strategy)
    return left.join(right, on)


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    value: str,
    low: str,
    high: str,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """All pairs with ``low <= value <= high``, for numeric columns.

    ``intervals`` is measured. Up to ``broadcast_rows`` of them, within ``BROADCAST_BYTES``, are
    broadcast and compared row by row. More are binned, which turns the condition into an
    equi-join whose hot bins adaptive execution can split. Both forms compare alike: NaN is above
    all other numbers and equal to itself, and a NULL meets nothing.
    """
    within = (F.col(value) >= F.col(low)) & (F.col(value) <= F.col(high))
    if _measures_small(intervals, broadcast_rows):
        return points.join(F.broadcast(intervals), within)
    return _binned_interval_join(points, intervals, value, low, high, within)


def _measures_small(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows that together are short enough to broadcast. Looks
    at no more than one row above the limit."""
    some = df.limit(rows + 1)
    return some.count() <= rows and text_bytes(some) <= BROADCAST_BYTES


def text_bytes(df: DataFrame) -> int:
    """Length of all rows as text: unlike file sizes, it does not shrink by compression."""
    length = F.octet_length(F.to_json(F.struct("*")))
    return df.agg(F.sum(length)).first()[0] or 0


def _binned_interval_join(
    points: DataFrame, intervals: DataFrame, value: str, low: str, high: str, within: Column
) -> DataFrame:
    """Bin widths are powers of two. An interval, cut to the range of the points, takes the smallest
    width that is no shorter than itself, and no narrower than doubles of its size can tell apart; so
    it touches at most three bins. A point looks into one bin per width in use. Points that are
    infinite or NaN meet intervals without a finite end in a bin of their own."""
    number = F.col(value).cast("double")
    span = points.where(_finite(number)).agg(F.min(number).alias("a"), F.max(number).alias("b"))
    span = span.first()
    first, last = F.col(low).cast("double"), F.col(high).cast("double")
    shared = intervals.where(F.col(low) <= F.col(high))
    odd = shared.where(~(_finite(first) & _finite(last))).withColumns(
        {"_level": F.lit(ODD_LEVEL), "_bin": F.lit(0).cast("bigint")}
    )
    binned = odd
    levels = [ODD_LEVEL]
    if span["a"] is not None:
        start = F.greatest(first, F.lit(span["a"]))
        end = F.least(last, F.lit(span["b"]))
        length, size = end - start, F.greatest(F.abs(start), F.abs(end))
        level = F.greatest(
            F.lit(NARROWEST_BIN),
            F.when(length > 0, F.ceil(F.log2(length)).cast("int")).otherwise(NARROWEST_BIN),
            F.when(size > 0, F.ceil(F.log2(size)).cast("int") - DOUBLE_BITS).otherwise(NARROWEST_BIN),
        )
        met = shared.where((first <= F.lit(span["b"])) & (last >= F.lit(span["a"])))
        met = met.withColumn("_level", level)
        levels += [row["_level"] for row in met.select("_level").distinct().collect()]
        bins = F.sequence(_bin(start, F.col("_level")), _bin(end, F.col("_level")))
        binned = met.withColumn("_bin", F.explode(bins)).unionByName(odd)
    in_use = F.when(_finite(number), F.array(*[F.lit(x) for x in levels[1:]]).cast("array<int>"))
    probes = points.withColumn("_level", F.explode(in_use.otherwise(F.array(F.lit(ODD_LEVEL)))))
    probes = probes.withColumn(
        "_bin",
        F.when(F.col("_level") == ODD_LEVEL, 0).otherwise(_bin(number, F.col("_level"))),
    )
    same_bin = (F.col("p._level") == F.col("i._level")) & (F.col("p._bin") == F.col("i._bin"))
    return probes.alias("p").join(binned.alias("i"), same_bin & within).drop("_level", "_bin")


def _finite(number: Column) -> Column:
    return number.isNotNull() & ~F.isnan(number) & (F.abs(number) < F.lit(float("inf")))


def _bin(number: Column, level: Column) -> Column:
    return F.floor(number / F.pow(F.lit(2.0), level))
