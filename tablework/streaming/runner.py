"""Starting streams and waiting for them."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(
    spark: SparkSession,
    many_keys: bool = False,
    state_partitions: int | None = None,
    idle_batches: bool = True,
) -> SparkSession:
    """A session for streams, with settings of its own on the same cluster.

    The shuffle width of a stateful query is fixed for the life of its checkpoint, and adaptive
    execution does not change it: a stream that is to last needs ``state_partitions`` for the keys
    it will have one day. Without it the width set for the batch session is taken, never what
    executors happen to be there. A state of ``many_keys`` is kept in RocksDB, off the heap, with
    only changes written to the checkpoint. A stream without news says so every second.
    State that expires by the clock asks for batches without rows for ever; without
    ``idle_batches`` such a stream can be run until its input is read.
    """
    own = spark.newSession()
    width = state_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.shuffle.partitions", str(width))
    own.conf.set("spark.sql.streaming.noDataProgressEventInterval", "1s")
    own.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(idle_batches).lower())
    if many_keys:
        own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        own.conf.set(
            "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
        )
    return own


def run_available(
    writer: DataStreamWriter, timeout_seconds: float | None = None
) -> StreamingQuery:
    """Process what has arrived, in as many batches as the source asks for, and stop."""
    query = writer.trigger(availableNow=True).start()
    if timeout_seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_seconds):
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} ran over {timeout_seconds} s")
    return query


def run_every(writer: DataStreamWriter, interval: str | None = "1 second") -> StreamingQuery:
    """Start a stream that keeps running: a batch per interval, or one after the other."""
    if interval is not None:
        writer = writer.trigger(processingTime=interval)
    return writer.start()
