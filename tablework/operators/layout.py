"""Data layout: bucketed table pairs and caches."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tablework.operators.joins import BROADCAST_BYTES, text_bytes
from tablework.storage import fresh_path

ROWS_PER_BUCKET = 16_000_000
BROADCAST_KEYS = 200_000
SKETCH_KEYS = 65_536
NAMED_KEYS = 10_000
SALT = "bucket_salt"


def bucket_count(rows: int, at_least: int = 8) -> int:
    return max(at_least, math.ceil(rows / ROWS_PER_BUCKET))


def write_bucketed(df: DataFrame, name: str, buckets: int, *keys: str) -> DataFrame:
    """Managed table hashed into buckets by ``keys`` and sorted within each file.

    Rows are brought to their bucket first, so that a bucket is one file or few. The rebalance hint
    lets adaptive execution cut a bucket with much of the rows over several tasks and join small ones.
    """
    (
        df.hint("rebalance", buckets, *keys)
        .write.format("parquet")
        .mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


@dataclass(frozen=True)
class BucketedPair:
    """Two tables bucketed alike, to be joined by key as often as needed without a shuffle."""

    large: DataFrame
    small: DataFrame
    large_key: str
    small_key: str

    def join(self) -> DataFrame:
        """Inner join bucket by bucket; the hint keeps small tables from being broadcast instead."""
        same = (F.col(f"l.{self.large_key}") == F.col(f"s.{self.small_key}")) & (
            F.col(f"l.{SALT}") == F.col(f"s.{SALT}")
        )
        joined = self.large.alias("l").join(self.small.hint("merge").alias("s"), same)
        return joined.drop(F.col(f"l.{SALT}"), F.col(f"s.{SALT}"))


def write_bucketed_pair(
    large: DataFrame,
    small: DataFrame,
    large_key: str,
    small_key: str,
    large_name: str,
    small_name: str,
    buckets: int | None = None,
    heavy_rows: int | None = None,
) -> BucketedPair:
    """Bucket two tables by their join key for repeated joins.

    A join of buckets has no shuffle at which adaptive execution could split a hot key, so it is
    split here. A key with more than ``heavy_rows`` rows in either table (by default half a bucket's
    share of that table) gets a grid of salts, as many rows of salts as its rows in ``large`` need
    and as many columns as those in ``small`` need. A row of ``large`` goes to one grid row, in all
    its columns, and a row of ``small`` to one column, in all its rows: each pair meets once.

    One pass over a table counts its rows and keeps a sketch of frequent keys; only keys that the
    sketch names are counted exactly. Rows of heavy keys, and of NULL, which meets nothing, are dealt
    to the salts by turns, whatever they hold. For that they are written first: a row's turn is its
    place in files that do not change, so a task that runs again deals alike.
    """
    sketched = [_sketched(df, key) for df, key in ((large, large_key), (small, small_key))]
    buckets = buckets or bucket_count(max(rows for rows, _ in sketched))
    limits = [heavy_rows or max(1, math.ceil(rows / buckets / 2)) for rows, _ in sketched]
    down = _heavy_keys(large, large_key, limits[0], *sketched[0]).withColumnRenamed("salts", "down")
    across = _heavy_keys(small, small_key, limits[1], *sketched[1]).withColumnRenamed("salts", "across")
    heavy = _saved(down.join(across, "heavy_key", "full_outer"), "heavy-keys")
    heavy_count = heavy.count()
    if heavy_count <= BROADCAST_KEYS and text_bytes(heavy) <= BROADCAST_BYTES:
        heavy = F.broadcast(heavy)
    tables = []
    for df, key, own, other in ((large, large_key, "down", "across"), (small, small_key, "across", "down")):
        light, odd = df.where(F.col(key).isNotNull()), df.where(F.col(key).isNull())
        unknown = F.lit(None).cast("bigint")
        odd = odd.withColumns({"down": unknown, "across": unknown})
        if heavy_count:
            same = F.col(key) == F.col("heavy_key")
            odd = light.join(heavy, same).drop("heavy_key").unionByName(odd)
            light = light.join(heavy, same, "left_anti")
        odd = _saved(odd, "heavy-rows").withColumn("_turn", F.monotonically_increasing_id())
        odd = odd.withColumns({c: F.coalesce(c, F.lit(1)) for c in ("down", "across")})
        odd = odd.withColumn("_mine", F.pmod("_turn", own)).withColumn(
            "_other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other).cast("bigint") - 1))
        )
        row, column = ("_mine", "_other") if own == "down" else ("_other", "_mine")
        salt = F.col(row) * F.col("across") + F.col(column)
        salt = F.when(F.col(key).isNull(), F.pmod("_turn", F.lit(buckets))).otherwise(salt)
        odd = odd.withColumn(SALT, salt.cast("int")).select(*df.columns, SALT)
        tables.append(light.withColumn(SALT, F.lit(0)).unionByName(odd))
    return BucketedPair(
        write_bucketed(tables[0], large_name, buckets, large_key, SALT),
        write_bucketed(tables[1], small_name, buckets, small_key, SALT),
        large_key,
        small_key,
    )


def _saved(df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _sketched(df: DataFrame, key: str) -> tuple[int, dict[int, int]]:
    """Rows of a table, and its most frequent keys as hashes with their estimated numbers of rows.
    The sketch tracks SKETCH_KEYS keys; an estimate is off by less than rows / SKETCH_KEYS * 1.5."""
    frequent = F.expr(f"approx_top_k(IF(`{key}` IS NULL, NULL, xxhash64(`{key}`)), {NAMED_KEYS}, {SKETCH_KEYS})")
    row = df.agg(F.count(F.lit(1)).alias("rows"), frequent.alias("keys")).first()
    return row["rows"], {k["item"]: k["count"] for k in row["keys"] or []}


def _heavy_keys(df: DataFrame, key: str, most: int, rows: int, frequent: dict[int, int]) -> DataFrame:
    """Keys with more than ``most`` rows, and the number of salts that brings them below that.

    Where the limit is too small a share of the rows for the sketch to name every such key, all keys
    are counted."""
    error = math.ceil(1.5 * rows / SKETCH_KEYS)
    counted = df.where(F.col(key).isNotNull())
    if most > 2 * error and rows // most < NAMED_KEYS // 2:
        named = [h for h, n in frequent.items() if n > most - error]
        if not named:
            empty = df.select(F.col(key).alias("heavy_key")).schema.add("salts", LongType())
            return df.sparkSession.createDataFrame([], empty)
        hashes = df.sparkSession.createDataFrame([(h,) for h in named], "h bigint")
        counted = counted.join(F.broadcast(hashes), F.xxhash64(key) == F.col("h"), "left_semi")
    counts = counted.groupBy(F.col(key).alias("heavy_key")).count().where(F.col("count") > most)
    return counts.select("heavy_key", F.ceil(F.col("count") / most).alias("salts"))


@contextmanager
def cached(
    df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK_DESER
) -> Iterator[DataFrame]:
    """Keep ``df`` at a storage level inside the block; the first action fills it."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


@contextmanager
def cached_table(spark: SparkSession, name: str, lazy: bool = False) -> Iterator[DataFrame]:
    """Keep a table or view cached inside the block, filled at once or on first use."""
    spark.sql(f"CACHE {'LAZY ' if lazy else ''}TABLE {name}")
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"UNCACHE TABLE IF EXISTS {name}")
