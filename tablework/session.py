"""Session settings: adaptive execution on, ANSI on, UTC, shuffle width from the input size."""

from __future__ import annotations

import math
import os

from pyspark.sql import SparkSession

MIB = 1024 * 1024
TASK_BYTES = 200 * MIB
DEFAULT_WIDTH = 200


def shuffle_width(cores: int | None, shuffled_bytes: int | None = None) -> int:
    """Initial shuffle partitions: one per 200 MiB of the largest shuffle, uncompressed, and at
    least one per core. Without a size, one per core; without both, Spark's default.

    Adaptive execution joins small partitions afterwards, so some too many cost little; it does not
    split the partitions of an aggregate, so too few would let tasks grow with the data.
    """
    if shuffled_bytes is None:
        return cores or DEFAULT_WIDTH
    return max(cores or 1, math.ceil(shuffled_bytes / TASK_BYTES))


def split_bytes(input_bytes: int | None = None) -> int:
    """Bytes per scan task: 128 MiB, and 512 MiB from a TiB on to keep the task count down."""
    return 512 * MIB if input_bytes and input_bytes >= 1024 * 1024 * MIB else 128 * MIB


def session_settings(
    cores: int | None, input_bytes: int | None = None, shuffled_bytes: int | None = None
) -> dict[str, str]:
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a hot join key even where the aggregate after the join then needs a shuffle.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.files.maxPartitionBytes": str(split_bytes(input_bytes)),
        "spark.sql.shuffle.partitions": str(shuffle_width(cores, shuffled_bytes)),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }


def build_session(
    app_name: str = "tablework",
    master: str | None = None,
    cores: int | None = None,
    input_bytes: int | None = None,
    shuffled_bytes: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session. Without ``master`` the cluster's own setting is used.

    ``input_bytes`` are the compressed bytes that scans read, ``shuffled_bytes`` the uncompressed
    ones of the largest shuffle. Only a local session takes its cores from this machine."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = (
                builder.config("spark.driver.bindAddress", "127.0.0.1")
                .config("spark.driver.host", "127.0.0.1")
                .config("spark.ui.enabled", "false")
            )
    if cores is None and master is not None and master.startswith("local"):
        cores = os.cpu_count()
    settings = session_settings(cores, input_bytes, shuffled_bytes)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
