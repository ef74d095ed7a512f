"""Order-aware deduplication across two tables grouped by a key.

Rows of the left table come before rows of the right one, and within a table ``order`` decides.
A row is kept unless an earlier kept row of its group lies closer than ``distance`` in ``value``.
"Closer than" is not transitive, so the order matters and the rule cannot be a plain distinct.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.storage import fresh_path

# Different values of a group that are collected into one array; larger groups are cut into blocks.
HEAD_ROWS = 1000
# Different values of a block, about. A block is streamed, so this bounds time and not memory.
BLOCK_ROWS = 1_000_000
LAST_CELL = 2.0**61


def greedy_dedup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    value: str,
    order: str,
    distance: float,
    method: str = "native",
    head_rows: int = HEAD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Kept rows of both tables. ``order`` must be unique within a table. No row is closer than
    ``distance`` to one whose value is NULL, NaN or infinite, so all of those are kept, and all rows
    are if the distance is not above 0.

    1. Of equal values in a group only the first row can be kept, so they are combined by key and
       value before the shuffle. Copies never meet in one task.
    2. What is decided on are triples of key, value and place; whole rows are joined at the end.
       Groups of up to ``head_rows`` values are decided by ``method``: ``native`` array functions, or
       ``cogroup`` with a Python function over the two grouped sides.
    3. Larger groups are cut along the value axis into blocks of about ``block_rows`` values, each
       with what lies within reach of its ends. A task streams a block in the order of places and
       decides all that depends on nothing outside; the few values that do go to the next round, in
       which the blocks begin elsewhere. Where places rise with the values all the way, a round
       decides one block of a group: then there are as many rounds as blocks.
    """
    names = left.columns
    if "side" in names:
        raise ValueError("column side is what the result calls the table a row comes from")
    if distance != distance:
        raise ValueError("distance is NaN")
    sides = _on_side(left, 0).unionByName(_on_side(right, 1))
    if distance <= 0:
        return sides.select("side", *names)
    number = F.col(value).cast("double")
    ordinary = F.coalesce(
        ~F.isnan(number) & (F.abs(number) < F.lit(float("inf"))), F.lit(False)
    )
    place = [F.min(F.when(F.col("side") == side, F.col(order))) for side in (0, 1)]
    firsts = (
        sides.where(ordinary)
        .groupBy(F.col(key).alias("k"), F.col(value).alias("v"))
        .agg(place[0].alias("l"), place[1].alias("r"))
        .select(
            "k", "v",
            F.struct(
                F.when(F.col("l").isNull(), 1).otherwise(0).alias("side"),
                F.coalesce("l", "r").alias("ordinal"),
            ).alias("place"),
        )
    )
    pool = _saved(firsts, "dedup-pool")
    decide = _decide_cogrouped if method == "cogroup" else _decide_native
    counts = pool.groupBy("k").count().where(F.col("count") > head_rows)
    large = _saved(counts.select("k"), "dedup-large")
    if large.isEmpty():
        kept = decide(pool, distance)
    else:
        few = decide(_matching(pool, large, "left_anti", ["k"]), distance)
        many = _decide_in_blocks(_matching(pool, large, "left_semi", ["k"]), distance, block_rows)
        kept = few.select("k", "v", "place").union(many)
    chosen = kept.select("k", "place.side", "place.ordinal")
    same = (
        F.col(f"s.{key}").eqNullSafe(F.col("c.k"))
        & (F.col("s.side") == F.col("c.side"))
        & (F.col(f"s.{order}") == F.col("c.ordinal"))
    )
    rows = sides.where(ordinary).alias("s").join(chosen.alias("c"), same, "left_semi")
    return rows.select("side", *names).unionByName(sides.where(~ordinary).select("side", *names))


def _saved(df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _on_side(df: DataFrame, side: int) -> DataFrame:
    return df.withColumn("side", F.lit(side))


def _decide_native(pool: DataFrame, distance: float) -> DataFrame:
    """Walk each group in order, keeping what no kept row is close to, in array functions."""
    in_order = F.array_sort(F.collect_list(F.struct("place", "v")))

    def step(kept: Column, one: Column) -> Column:
        taken = F.exists(kept, lambda other: F.abs(other["v"] - one["v"]) < distance)
        return F.when(taken, kept).otherwise(F.concat(kept, F.array(one)))

    nothing = F.filter("in_order", lambda one: F.lit(False))
    kept = F.aggregate("in_order", nothing, step)
    return (
        pool.groupBy("k")
        .agg(in_order.alias("in_order"))
        .select("k", F.explode(kept).alias("one"))
        .select("k", "one.v", "one.place")
    )


def _decide_cogrouped(pool: DataFrame, distance: float) -> DataFrame:
    """The same decision by a function that gets both sides of a group as Arrow tables."""

    def keep(first: pa.Table, second: pa.Table) -> pa.Table:
        kept: list[float] = []  # sorted, so only two neighbours can be close
        chosen = []
        for side in (first, second):
            side = side.sort_by("ordinal")
            free = [_take(kept, one, distance) for one in side["v"].to_pylist()]
            chosen.append(side.filter(pa.array(free, pa.bool_())).drop_columns("v"))
        return pa.concat_tables(chosen)

    def grouped(side: int):
        # Each side names its columns anew; a cogroup of one table with itself mixes them up.
        rows = pool.where(F.col("place.side") == side).select(
            F.col("k").alias("k"),
            F.col("v").alias("v"),
            F.col("place.side").alias("side"),
            F.col("place.ordinal").alias("ordinal"),
        )
        return rows.groupBy("k")

    places = pool.select("k", "place.side", "place.ordinal").schema
    chosen = grouped(0).cogroup(grouped(1)).applyInArrow(keep, places)
    chosen = chosen.select("k", F.struct("side", "ordinal").alias("place"))
    return _matching(pool, chosen, "left_semi", ["k", "place"])


def _take(kept: list[float], one: float, distance: float) -> bool:
    """Add a value to the sorted kept ones unless one of them is close."""
    at = bisect_left(kept, one)
    if any(abs(one - other) < distance for other in kept[max(at - 1, 0) : at + 1]):
        return False
    kept.insert(at, one)
    return True


def _decide_in_blocks(pool: DataFrame, distance: float, block_rows: int) -> DataFrame:
    """Rounds over blocks of the value axis, until nothing is open.

    A round sees the open values and those that the last round kept; what a kept value reaches is
    then gone. A block begins at the first open cell of its group and is as many cells long as keep
    its fullest cells within ``block_rows``. Its own values have all that is within reach in view,
    because the cells next to its ends are copied to it."""
    rounds: list[DataFrame] = []
    seen = _saved(pool.select("k", "v", "place", F.lit(False).alias("kept")), "dedup-open")
    while True:
        celled = seen.withColumn("cell", _cell("v", distance))
        cells = celled.where("NOT kept").groupBy("k", "cell").count()
        spans = cells.groupBy("k").agg(
            F.min("cell").alias("base"),
            F.greatest(F.lit(1), F.expr(f"{block_rows} div max(count)")).alias("length"),
        )
        spans = _saved(spans, "dedup-spans")
        if spans.isEmpty():
            return _union(rounds)
        at = F.col("cell") - F.col("base")
        block, place_in = F.expr("(cell - base) div length"), F.pmod(at, F.col("length"))
        blocks = F.array_compact(
            F.array(
                block,
                F.when(place_in == 0, block - 1),
                F.when(place_in == F.col("length") - 1, block + 1),
            )
        )
        same = F.col("r.k").eqNullSafe(F.col("s.k"))
        placed = celled.alias("r").join(spans.alias("s"), same).where(at >= -1)
        placed = placed.select(
            F.col("r.k").alias("k"), "v", "place", "kept", "cell",
            F.floor(at / F.col("length")).alias("home"), F.explode(blocks).alias("block"),
        )
        placed = placed.withColumn("own", F.col("home") == F.col("block"))
        dealt = placed.repartition("k", "block").sortWithinPartitions("k", "block", "place")
        columns = ["k", "v", "place", "kept"]
        decided = dealt.select(*columns, "cell", "block", "own").mapInArrow(
            _block_decider(distance), seen.schema
        )
        seen = _saved(decided, "dedup-open")
        rounds.append(seen.where("kept").select("k", "v", "place"))


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.union(frame)
    return whole


def _block_decider(distance: float):
    """Streams blocks in the order of places. Of each block it remembers kept values by cell, three
    a cell at most, and the cells with an open value. A value is open if it is not the block's own,
    so that it may depend on values out of view, or if an earlier open value may reach it."""

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kept, open_ = None, {}, set()
        for batch in batches:
            keys, values, before, cells, blocks, own = (
                batch.column(c).to_pylist() for c in ("k", "v", "kept", "cell", "block", "own")
            )
            stay, marks = [], []
            for i, cell in enumerate(cells):
                block = (blocks[i], keys[i] if keys[i] == keys[i] else "NaN")
                if block != now:
                    now, kept, open_ = block, {}, set()
                around = (cell - 1, cell, cell + 1)
                v = values[i]
                if before[i]:
                    kept.setdefault(cell, []).append(v)
                elif any(abs(v - other) < distance for c in around for other in kept.get(c, ())):
                    continue
                elif not own[i] or not open_.isdisjoint(around):
                    open_.add(cell)
                    if own[i]:
                        stay.append(i)
                        marks.append(False)
                else:
                    kept.setdefault(cell, []).append(v)
                    stay.append(i)
                    marks.append(True)
            rows = batch.select(["k", "v", "place"]).take(pa.array(stay, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(marks, pa.bool_())], ["k", "v", "place", "kept"]
            )

    return decide


def _cell(value: str, distance: float) -> Column:
    """Cell of the value axis, twice as wide as the distance: two values closer than the distance
    lie in one cell or in neighbouring ones, rounding included. Infinite values go to the ends."""
    cells = F.col(value).cast("double") / F.lit(2.0 * distance)
    return F.floor(F.greatest(F.least(cells, F.lit(LAST_CELL)), F.lit(-LAST_CELL)))


def _matching(rows: DataFrame, chosen: DataFrame, how: str, columns: list[str]) -> DataFrame:
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}")) for c in columns]
    return rows.alias("r").join(chosen.alias("c"), same, how)
