"""Running totals whose state starts from a batch result."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

KEYS_HELD = 100_000


def running_totals(
    stream: DataFrame,
    keys: Sequence[str],
    totals: Mapping[str, Column],
    start: DataFrame | None = None,
    forget_after_ms: int | None = None,
) -> DataFrame:
    """The totals of each key that a batch changes, for ``publish_running(mode="update")``.

    ``totals`` names whole numbers to add up; a null adds nothing, and a null key is a key. Totals
    must fit in 64 bits. ``start`` has the same columns and is where the first batch begins: its rows
    are added by key and put into the state, not into the output (``sinks.publish_base`` does that).
    Later batches and restarts go on from the checkpoint. With ``forget_after_ms`` a key that was not
    seen for that long, by the clock, loses its state and starts from nothing; ``run_available`` then needs a session without
    ``idle_batches``.

    Rows are added up by key on the map side before the shuffle, so a key that holds most rows sends
    a few rows per task. Each changed key then costs a few calls between Python and the state store,
    so this suits keys by the thousand per task and batch; a plain ``groupBy`` has no such cost but
    cannot start from a batch result. The session must keep its state in RocksDB (``stream_session(many_keys=True)``).
    """
    names = list(totals)
    amounts = [F.coalesce(totals[n].cast("long"), F.lit(0)).cast("long").alias(n) for n in names]
    rows = stream.select(*keys, *amounts)
    fields = [(k, rows.schema[k].dataType) for k in keys] + [(n, LongType()) for n in names]
    schema = StructType([StructField(name, kind) for name, kind in fields])
    combined = rows.mapInArrow(_combiner(list(keys), names), schema)
    begun = None
    if start is not None:
        begun = start.groupBy(*keys).agg(*[F.sum(n).cast("long").alias(n) for n in names]).groupBy(*keys)
    return combined.groupBy(*keys).transformWithState(
        statefulProcessor=_Totals(list(keys), names, forget_after_ms),
        outputStructType=schema,
        outputMode="Update",
        timeMode="None" if forget_after_ms is None else "ProcessingTime",
        initialState=begun,
    )


def _combiner(keys: list[str], names: list[str]):
    def add_up(held: list[pa.Table]) -> pa.Table:
        rows = pa.concat_tables(held, promote_options="default")  # sums may be null, rows not
        summed = rows.group_by(keys).aggregate([(n, "sum") for n in names])
        return summed.rename_columns([*keys, *names])

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        waiting = kept = 0  # rows not added up yet, and keys held
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            waiting += batch.num_rows
            if waiting >= max(KEYS_HELD, kept):
                held = [add_up(held)]
                waiting, kept = 0, held[0].num_rows
                if kept >= KEYS_HELD:
                    yield from held[0].to_batches()
                    held, kept = [], 0
        if held:
            yield from add_up(held).to_batches()

    return combine


class _Totals(StatefulProcessor):
    def __init__(self, keys: list[str], names: list[str], forget_after_ms: int | None):
        self.keys, self.names, self.forget_after_ms = keys, names, forget_after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = StructType([StructField(n, LongType()) for n in self.names])
        if self.forget_after_ms is None:
            self.totals = handle.getValueState("totals", schema)
        else:
            self.totals = handle.getValueState("totals", schema, self.forget_after_ms)
        self.row = Row(*self.keys, *self.names)

    def _add(self, rows) -> tuple:
        sums = list(self.totals.get() or [0] * len(self.names))
        for row in rows:
            for i, name in enumerate(self.names):
                sums[i] += row[name] or 0
        self.totals.update(tuple(sums))
        return tuple(sums)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._add([initialState])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        yield self.row(*key, *self._add(rows))

    def close(self) -> None:
        pass
