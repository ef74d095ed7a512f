"""Ranked rows and top rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablework.storage import fresh_path


def top_dense_rank(
    df: DataFrame, group: str, measure: str, ranks: int, name: str = "rank"
) -> DataFrame:
    """Rows whose ``measure`` is among the ``ranks`` largest different values of their group.

    Only different values are ranked: copies are combined before the shuffle, and each map task
    passes on at most ``ranks`` values of a group, so neither a large group nor many equal values
    meet in one task. The rows then join their rank by group and value.
    """
    values = df.select(group, measure).distinct()
    largest_first = Window.partitionBy(group).orderBy(F.desc(measure))
    ranked = values.withColumn(name, F.dense_rank().over(largest_first)).where(
        F.col(name) <= ranks
    )
    ranked = ranked.select(
        F.col(group).alias("_group"), F.col(measure).alias("_measure"), F.col(name).cast("bigint")
    )
    same = F.col(group).eqNullSafe(F.col("_group")) & F.col(measure).eqNullSafe(F.col("_measure"))
    return df.join(ranked, same).drop("_group", "_measure")


def top_rows(df: DataFrame, count: int, *order: Column) -> DataFrame:
    """First rows in ``order``. Every task keeps ``count`` rows, nothing is sorted as a whole.

    End ``order`` with a unique column, or equal rows may come and go between runs.
    """
    return df.orderBy(*order).limit(count)


def dense_rank_all(df: DataFrame, measure: str, name: str = "rank", parts: int | None = None) -> DataFrame:
    """All rows with the dense rank of ``measure`` over the whole table, largest first, NULL last.

    Different values are put into ranges by value; a value's rank is its place in its range plus the
    sizes of the ranges before. No window spans the table. ``parts`` ranges, by default one per
    shuffle partition; their sizes are all that the driver sees.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    largest_first = F.desc_nulls_last("_measure")
    values = df.select(F.col(measure).alias("_measure")).distinct()
    path = fresh_path(spark, "ranges")
    ranged = values.repartitionByRange(parts, largest_first)
    ranged.withColumn("_range", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)
    before, offsets = 0, []
    for row in ranged.groupBy("_range").count().orderBy("_range").collect():
        offsets.append((row["_range"], before))
        before += row["count"]
    offsets = spark.createDataFrame(offsets, "_range int, _before bigint")
    within = Window.partitionBy("_range").orderBy(largest_first)
    ranked = ranged.join(F.broadcast(offsets), "_range").select(
        "_measure", (F.row_number().over(within) + F.col("_before")).alias(name)
    )
    return df.join(ranked, F.col(measure).eqNullSafe(F.col("_measure"))).drop("_measure")
