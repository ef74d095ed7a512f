"""Streaming sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

VERSION = "result_version"
BASE = "result_base"
MERGE_EVERY = 10


def append_files(
    stream: DataFrame, path: str, checkpoint: str, name: str | None = None, by: Sequence[str] = ()
) -> DataStreamWriter:
    """Append to a Parquet table that only streams write to.

    The file sink logs which batch wrote which files, so a batch that runs again adds nothing, for
    batch readers and for streams that read the table.
    """
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    if by:
        writer = writer.partitionBy(*by)
    return writer if name is None else writer.queryName(name)


def publish_running(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "complete",
    name: str | None = None,
    keys: Sequence[str] = (),
) -> DataStreamWriter:
    """Publish a running aggregate, one version per batch.

    ``complete`` writes the whole result each time and suits few keys; versions before the last one
    go. ``update`` writes only the keys that changed; every MERGE_EVERY batches the versions are
    merged by ``keys`` into a base, and those merged before the last time go. A batch that runs
    again replaces its version.
    """
    if mode == "update" and not keys:
        raise ValueError("updates are merged by keys")
    writer = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(_version_writer(path, keys if mode == "update" else None))
    )
    return writer if name is None else writer.queryName(name)


def publish_base(start: DataFrame, path: str) -> None:
    """What was there before the first batch of a result published as ``update``."""
    start.write.mode("overwrite").parquet(f"{path}/{BASE}=-1")


def _version_writer(
    path: str, keys: Sequence[str] | None
) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if any(base >= batch_id for base in _finished(spark, path, BASE)):
            return  # merged already: the batch runs again
        batch.write.mode("overwrite").parquet(f"{path}/{VERSION}={batch_id}")
        if keys is None:
            # Readers of the version before this one may still be at work.
            _remove(spark, path, VERSION, batch_id - 1)
        elif batch_id % MERGE_EVERY == MERGE_EVERY - 1:
            merged = latest_update(spark, path, keys)
            merged.write.mode("overwrite").parquet(f"{path}/{BASE}={batch_id}")
            _remove(spark, path, VERSION, batch_id - MERGE_EVERY + 1)
            _remove(spark, path, BASE, batch_id - MERGE_EVERY)

    return write


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the folders of a kind. Only folder names are read."""
    place, files = _folder(spark, path)
    if not files.exists(place):
        return []
    names = [one.getPath().getName() for one in files.listStatus(place)]
    return sorted(int(x.split("=")[1]) for x in names if x.startswith(f"{kind}="))


def _finished(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Of those, the ones whose writing has ended."""
    return [
        n
        for n in _numbers(spark, path, kind)
        if _folder(spark, path)[1].exists(_folder(spark, f"{path}/{kind}={n}/_SUCCESS")[0])
    ]


def _remove(spark: SparkSession, path: str, kind: str, before: int) -> None:
    for n in _numbers(spark, path, kind):
        if n < before:
            place, files = _folder(spark, f"{path}/{kind}={n}")
            files.delete(place, True)


def latest_complete(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of a result published as ``complete``."""
    return spark.read.parquet(f"{path}/{VERSION}={_finished(spark, path, VERSION)[-1]}")


def latest_update(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest row per key of a result published as ``update``: of the newest base and the
    versions after it."""
    base = _finished(spark, path, BASE)[-1:]
    after = [n for n in _finished(spark, path, VERSION) if not base or n > base[0]]
    folders = [(BASE, n) for n in base] + [(VERSION, n) for n in after]
    versions = None
    for kind, n in folders:
        rows = spark.read.parquet(f"{path}/{kind}={n}").withColumn(VERSION, F.lit(n))
        versions = rows if versions is None else versions.unionByName(rows)
    others = [name for name in versions.columns if name not in (*keys, VERSION)]
    newest = [F.max_by(name, VERSION).alias(name) for name in others]
    return versions.groupBy(*keys).agg(*newest)
