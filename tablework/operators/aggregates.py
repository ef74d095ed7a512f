"""Grouped and global aggregates. All of them combine before the shuffle, so a group with much of
the data costs no more than any other."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_SMALLEST = 1074  # a double is a whole number of times 2 ** -1074


def group_total(df: DataFrame, keys: Sequence[str], measure: Column, name: str) -> DataFrame:
    """Sum per group, largest first; equal sums in key order."""
    return df.groupBy(*keys).agg(F.sum(measure).alias(name)).orderBy(F.desc(name), *keys)


def group_counts(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    """Rows per group, largest group first; equal counts in key order."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), *keys)


def distinct_count(
    df: DataFrame, column: str, name: str, relative_error: float | None = None
) -> DataFrame:
    """Number of different non-NULL values: exact, or a sketch with a standard error.

    The exact form shuffles every different value once, the sketch only its registers.
    """
    if relative_error is None:
        return df.agg(F.countDistinct(column).alias(name))
    return df.agg(F.approx_count_distinct(column, relative_error).alias(name))


def exact_sum(column: str, digits: int) -> Column:
    """Sum of values that have at most ``digits`` decimals, as money has. They are added as
    decimals, so the result does not depend on the order in which tasks add them up."""
    return F.sum(F.col(column).cast(f"decimal(28,{digits})")).cast("double")


def exact_mean(column: str, digits: int) -> Column:
    return exact_sum(column, digits) / F.count(column)


def exact_sums(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Per group the sum of doubles as if added without rounding and rounded once, and their number:
    ``keys, total, n``. No result depends on partitions or order.

    Each double is a 53-bit whole number times a power of two. Whole numbers of the same power are
    added as decimals, on the map side first; a group has at most some 2,100 powers, which one small
    function then puts together. NULLs count for nothing; a group without a number has a NULL sum.
    NaN, and infinities of both signs, give NaN, infinities of one sign stay that. Sums too large
    for a double are infinite.
    """
    x = F.col(column).cast("double")
    finite = ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    # log2 may be off by one next to a power of two; one spare bit on either side bears that.
    power = F.greatest(F.floor(F.log2(F.abs(x))).cast("int") - 53, F.lit(-_SMALLEST))
    power = F.when(finite & (x != 0), power)
    half = F.floor(F.col("_power") / 2)
    whole = x * F.pow(F.lit(2.0), -half) * F.pow(F.lit(2.0), half - F.col("_power"))
    odd = F.when(x.isNotNull() & ~finite, x)
    binned = df.where(x.isNotNull()).select(*keys, power.alias("_power"), odd.alias("_odd"), x.alias(column))
    binned = binned.groupBy(*keys, "_power", "_odd").agg(
        F.sum(F.when(F.col("_power").isNotNull(), whole.cast("bigint").cast("decimal(20,0)"))).alias("_whole"),
        F.count("*").alias("_n"),
    )
    cells = F.collect_list(F.struct("_power", "_odd", F.col("_whole").cast("string").alias("_whole")))
    summed = binned.groupBy(*keys).agg(_rounded(cells).alias("total"), F.sum("_n").alias("n"))
    if not keys:
        return summed.select(F.when(F.col("n") > 0, F.col("total")).alias("total"), F.coalesce("n", F.lit(0)).alias("n"))
    groups = df.select(*keys).distinct()
    same = [groups[k].eqNullSafe(summed[k]) for k in keys]
    return groups.join(summed, same, "left").select(
        *[groups[k] for k in keys], "total", F.coalesce("n", F.lit(0)).alias("n")
    )


@F.arrow_udf(DoubleType())
def _rounded(groups: pa.Array) -> pa.Array:
    return pa.array([_sum_of_cells(cells) for cells in groups.to_pylist()], pa.float64())


def _sum_of_cells(cells) -> float:
    odd = {float(c["_odd"]) for c in cells if c["_odd"] is not None}
    if odd:
        return odd.pop() if len(odd) == 1 else math.nan
    whole = sum(int(c["_whole"]) << (int(c["_power"]) + _SMALLEST) for c in cells if c["_whole"] is not None)
    try:
        return whole / (1 << _SMALLEST)  # division of whole numbers rounds once
    except OverflowError:
        return math.inf if whole > 0 else -math.inf


def summary(df: DataFrame, column: str, digits: int | None = None) -> DataFrame:
    """Sum, mean, smallest and largest value of a numeric column. With ``digits``, of values that
    have at most so many decimals, added as decimals; without, doubles are added as ``exact_sums``
    does and whole numbers and decimals as Spark does. All three do not depend on partitions."""
    ends = [F.min(column).alias("smallest"), F.max(column).alias("largest")]
    if digits is None and dict(df.dtypes)[column] in ("double", "float"):
        total = exact_sums(df, [], column)
        mean = F.when(F.col("n") > 0, F.col("total") / F.col("n")).alias("mean")
        return total.crossJoin(df.agg(*ends)).select("total", mean, "smallest", "largest")
    return df.agg(
        (F.sum(column) if digits is None else exact_sum(column, digits)).alias("total"),
        (F.avg(column) if digits is None else exact_mean(column, digits)).alias("mean"),
        *ends,
    )


def union_sketch(sketches: DataFrame, sketch: str, name: str) -> DataFrame:
    """How many different values went into all of the sketches together, about."""
    return sketches.agg(F.hll_sketch_estimate(F.hll_union_agg(sketch)).alias(name))


def load_sketches(df: DataFrame, load: str, column: str, bits: int = 14) -> DataFrame:
    """One row per load: ``load, sketch``, a mergeable sketch of the different non-NULL values of
    ``column`` in it. Kept beside the loads, such sketches give the number of different values of
    any set of loads without reading them again (``union_sketch``). The standard error is about
    0.84 / 2 ** (bits / 2), for 14 bits 0.65 %; a sketch takes at most 2 ** bits bytes."""
    return df.groupBy(load).agg(F.hll_sketch_agg(column, bits).alias("sketch"))


def pivot_labelled(
    df: DataFrame,
    by: Sequence[str],
    pivot: str,
    labels: Mapping[object, str],
    aggregates: Mapping[str, Column],
) -> DataFrame:
    """One row per group, one column ``LABEL_aggregate`` per pivot value and aggregate.

    The value list is given, so no job is needed to find it; absent cells are NULL.
    """
    wide = (
        df.groupBy(*by)
        .pivot(pivot, list(labels))
        .agg(*[column.alias(name) for name, column in aggregates.items()])
    )
    names = {
        f"{value}_{name}" if len(aggregates) > 1 else str(value): f"{label}_{name}"
        for value, label in labels.items()
        for name in aggregates
    }
    return wide.withColumnsRenamed(names)


def within(number: Column, precision: int, scale: int) -> Column:
    """A decimal of fixed width; NULL where the number does not fit."""
    return number.try_cast(f"decimal({precision},{scale})")


def rebuilt_arrays(df: DataFrame, key: str, array: str, element: Column, name: str) -> DataFrame:
    """Explode arrays, compute ``element`` from column ``item``, and collect them in their order.
    Empty and NULL arrays stay what they are.

    ``key`` must identify a row, so that a group is no longer than its array; a key that repeats
    is an error. A transform of the array in place does the same without a shuffle.
    """
    size = F.when(F.col(array).isNotNull(), F.size(array))
    items = df.select(
        key, size.alias("n_items"), F.posexplode_outer(array).alias("position", "item")
    )
    pairs = F.collect_list(
        F.when(F.col("position").isNotNull(), F.struct("position", element.alias("item")))
    )
    n_items = F.max("n_items")
    rebuilt = F.when(n_items.isNotNull(), F.array_sort(pairs)["item"])
    alone = F.count(F.lit(1)) == F.greatest(F.coalesce(n_items, F.lit(0)), F.lit(1))
    message = F.concat(F.lit("key repeats: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
    checked = F.when(alone, rebuilt).otherwise(F.raise_error(message))
    return items.groupBy(key).agg(checked.alias(name))
