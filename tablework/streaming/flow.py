"""Two streams in a row: land files in a table, then transform what has landed."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from threading import Event

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from tablework.operators.columns import flag_valid
from tablework.streaming.handover import HandOver
from tablework.streaming.runner import run_available, run_every
from tablework.streaming.sinks import append_files, publish_running
from tablework.streaming.sources import json_stream, parquet_stream


@dataclass(frozen=True)
class LandingFlow:
    """JSON files in ``inbox`` are appended to a landing table; ``transform`` of that table is kept
    up to date as a running result. Each of the two streams has a checkpoint of its own, so each
    goes on where it stopped."""

    schema: StructType
    transform: Callable[[DataFrame], DataFrame]
    inbox: str
    home: str
    arrays: bool = False
    files_per_batch: int | None = None

    @property
    def landing(self) -> str:
        return f"{self.home}/landing"

    @property
    def result(self) -> str:
        return f"{self.home}/result"

    def run(self, spark: SparkSession, timeout_seconds: float | None = None) -> None:
        """Take in what has arrived. The second stream starts when the first has its rows in the
        table, so there is nothing to wait for or to guess."""
        run_available(self._lander(spark), timeout_seconds)
        if self._has_landed(spark):
            run_available(self._publisher(spark), timeout_seconds)

    def run_together(
        self,
        spark: SparkSession,
        timeout_seconds: float | None = None,
        interval: str | None = "1 second",
    ) -> None:
        """Take in what has arrived with both streams at work at once: the second follows the first
        batch by batch, and is stopped when it has read all that the first committed. Failures of
        either are raised."""
        deadline = None if timeout_seconds is None else time.monotonic() + timeout_seconds

        def wait(event: Event) -> None:
            if not event.wait(None if deadline is None else max(0.0, deadline - time.monotonic())):
                raise TimeoutError(f"flow to {self.home} ran over {timeout_seconds} s")

        over, queries = HandOver("land", "publish"), []
        spark.streams.addListener(over)
        try:
            queries.append(self._lander(spark).trigger(availableNow=True).start())
            if not self._has_landed(spark):
                wait(over.landed)
            if self._has_landed(spark):
                queries.append(run_every(self._publisher(spark), interval))
                wait(over.caught_up)
        finally:
            for running in queries:
                running.stop()
            spark.streams.removeListener(over)
        for ended in queries:
            if ended.exception() is not None:
                raise ended.exception()

    def start(
        self, spark: SparkSession, interval: str | None = "1 second"
    ) -> tuple[StreamingQuery, StreamingQuery]:
        """Keep both streams running side by side. Something must have arrived in the inbox."""
        lander = run_every(self._lander(spark), interval)
        lander.processAllAvailable()
        return lander, run_every(self._publisher(spark), interval)

    def _lander(self, spark: SparkSession) -> DataStreamWriter:
        arrived = json_stream(spark, self.inbox, self.schema, self.arrays, self.files_per_batch)
        return append_files(arrived, self.landing, f"{self.home}/checkpoints/land", "land")

    def _publisher(self, spark: SparkSession) -> DataStreamWriter:
        result = self.transform(parquet_stream(spark, self.landing, self.schema))
        checkpoint = f"{self.home}/checkpoints/publish"
        return publish_running(result, self.result, checkpoint, name="publish")

    def _has_landed(self, spark: SparkSession) -> bool:
        try:
            spark.read.schema(self.schema).parquet(self.landing)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
        return True


def gate(stream: DataFrame, rule: Column, path: str, checkpoint: str) -> DataStreamWriter:
    """Writer that splits a stream into rows that meet ``rule`` and a quarantine of the others.

    Both are partitions of one table, so a batch is computed and committed once.
    """
    return append_files(flag_valid(stream, rule), path, checkpoint, by=["is_valid"])


def gated(spark: SparkSession, path: str, valid: bool) -> DataFrame:
    """One side of a gated table; only its partition is read. Folder names are text."""
    side = F.col("is_valid") == str(valid).lower()
    return spark.read.parquet(path).where(side).drop("is_valid")
