"""Large files that each hold one JSON array over many lines, read by many tasks.

Whether a byte is inside a string, and how deep it is nested, depends on everything before it. So a
first job looks at each byte range by itself and tells what it would change for either beginning
(inside a string or not); a few numbers per range, added up in order, then give the state in which
each range begins. A second job reads, range by range, the elements that begin in it, the last one on
into the next ranges. Brackets, braces, quotes and backslashes inside strings do no harm.

Files are opened by ``pyarrow.fs``. A file must be UTF-8 and hold one array (each element is a row) or
one object (one row).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

RANGE_BYTES = 64 * 1024 * 1024
PIECE_BYTES = 4 * 1024 * 1024
QUOTE, BACKSLASH = 0x22, 0x5C
_STEP = np.zeros(256, np.int8)
_STEP[[0x7B, 0x5B]] = 1
_STEP[[0x7D, 0x5D]] = -1
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0D, 0xEF, 0xBB, 0xBF]] = True  # and the bytes of a byte order mark


def quotes(data: np.ndarray, before: int) -> np.ndarray:
    """Which bytes are quotes that begin or end a string; ``before`` backslashes precede the data."""
    found = data == QUOTE
    slash = data == BACKSLASH
    if before or slash.any():
        place = np.arange(len(data))
        last_other = np.maximum.accumulate(np.where(slash, -1 - before, place))
        run = np.empty(len(data), np.int64)  # backslashes right before each byte
        run[0] = before
        run[1:] = place[:-1] - last_other[:-1]
        found &= run % 2 == 0
    return found


def trailing_slashes(data: np.ndarray, before: int) -> int:
    other = np.flatnonzero(data != BACKSLASH)
    return before + len(data) if not len(other) else len(data) - 1 - int(other[-1])


def depths(data: np.ndarray, before: int, inside: bool, depth: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """For each byte whether it lies outside strings, the depth after it, and whether the data ends
    inside a string."""
    marks = quotes(data, before)
    odd = np.cumsum(marks) % 2 == 1
    within = odd ^ inside | marks  # both quotes count as part of the string
    steps = np.where(within, 0, _STEP[data])
    return ~within, depth + np.cumsum(steps), bool(odd[-1] ^ inside) if len(data) else inside


def _pieces(source, start: int, end: int) -> Iterator[np.ndarray]:
    source.seek(start)
    while start < end:
        data = source.read(min(PIECE_BYTES, end - start))
        if not data:
            return
        start += len(data)
        yield np.frombuffer(data, np.uint8)


def _slashes_before(source, start: int) -> int:
    """Length of the run of backslashes that ends at ``start``."""
    found, size = 0, 4096
    while start > found:
        low = max(0, start - size)
        source.seek(low)
        data = np.frombuffer(source.read(start - low), np.uint8)
        found = trailing_slashes(data, 0)
        if found < len(data):
            break
        size *= 8
    return found


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int
    inside: bool = False
    depth: int = 0


def effect(part: Range) -> tuple[bool, int, int]:
    """What a range does: whether it changes between inside and outside of strings, and by how much
    depth changes if it begins outside or inside."""
    store, path = fs.FileSystem.from_uri(part.path)
    with store.open_input_file(path) as source:
        slashes = _slashes_before(source, part.start)
        ends, changes = [False, True], [0, 0]
        for data in _pieces(source, part.start, part.end):
            for i in (0, 1):
                _, depth, ends[i] = depths(data, slashes, ends[i], changes[i])
                changes[i] = int(depth[-1])
            slashes = trailing_slashes(data, slashes)
    return ends[0], changes[0], changes[1]


def elements(part: Range) -> Iterator[list[bytes]]:
    """Texts of the elements that begin in a range, whose first byte is in state ``part.inside`` and
    ``part.depth``. An element is an object or array at depth 1, or a whole file's object."""
    store, path = fs.FileSystem.from_uri(part.path)
    with store.open_input_file(path) as source:
        size = source.size()
        single = _first_sign(source) == b"{"
        level = 0 if single else 1
        slashes = _slashes_before(source, part.start)
        inside, depth, at, open_ = part.inside, part.depth, part.start, None
        for data in _pieces(source, part.start, size):
            outside, after, inside = depths(data, slashes, inside, depth)
            change = np.diff(after, prepend=depth)
            begins = np.flatnonzero((change == 1) & (after == level + 1))
            ends = np.flatnonzero((change == -1) & (after == level)) + 1
            begins = begins[at + begins < part.end]
            found, raw = [], data.tobytes()
            if open_ is not None:
                if not len(ends):
                    open_.append(raw)
                else:
                    found.append(b"".join([*open_, raw[: ends[0]]]))
                    open_ = None
            for begin in begins.tolist():
                stop = np.searchsorted(ends, begin, "right")
                if stop < len(ends):
                    found.append(raw[begin : ends[stop]])
                else:
                    open_ = [raw[begin:]]
            if found:
                yield found
            slashes = trailing_slashes(data, slashes)
            depth, at = int(after[-1]), at + len(data)
            if at >= part.end and open_ is None:
                return
        if open_ is not None:
            raise ValueError(f"{part.path} ends inside an element")


def _first_sign(source) -> bytes:
    """The first byte of a file that is not white space."""
    source.seek(0)
    while data := source.read(4096):
        signs = np.flatnonzero(~_BLANK[np.frombuffer(data, np.uint8)])
        if len(signs):
            return data[signs[0] : signs[0] + 1]
    return b""


def _files(path: str) -> list[tuple[str, int]]:
    """Data files under a path with their sizes, as URIs or local paths like the one given."""
    store, inner = fs.FileSystem.from_uri(path)
    if store.get_file_info(inner).type == fs.FileType.File:
        return [(path, store.get_file_info(inner).size)]
    prefix = path[: len(path) - len(inner)] if path.endswith(inner) else path.split("/", 3)[0] + "//"
    found = store.get_file_info(fs.FileSelector(inner, recursive=True))
    return sorted(
        (prefix + f.path, f.size)
        for f in found
        if f.type == fs.FileType.File and f.size and not f.base_name.startswith(("_", "."))
    )


def ranges(path: str, range_bytes: int) -> list[Range]:
    return [
        Range(name, start, min(size, start + range_bytes))
        for name, size in _files(path)
        for start in range(0, size, range_bytes)
    ]


class _Reader(DataSourceReader):
    def __init__(self, parts: list[Range]):
        self.parts = parts

    def partitions(self) -> list[InputPartition]:
        return list(self.parts)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, Range):  # an empty folder has no ranges
            return
        for found in elements(partition):
            yield pa.RecordBatch.from_pydict({"value": pa.array(found, pa.binary()).cast(pa.string())})


class JsonElements(DataSource):
    """``format("json_elements")``: the text of each element, in column ``value``. Options ``path``,
    and ``states``: for each range its file, start, end, state and depth."""

    @classmethod
    def name(cls) -> str:
        return "json_elements"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> DataSourceReader:
        parts = []
        for line in self.options["states"].splitlines():
            name, start, end, inside, depth = line.rsplit("\t", 4)
            parts.append(Range(name, int(start), int(end), inside == "1", int(depth)))
        return _Reader(parts)


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            (i, *effect(Range(path, start, end)))
            for i, path, start, end in zip(*(batch.column(c).to_pylist() for c in ("i", "path", "start", "end")))
        ]
        columns = list(zip(*rows)) or [()] * 4
        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["i", "turns", "outside", "inside"]
        )


def read_json_elements(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The text of every element of the arrays under ``path``. The driver sees a few numbers per
    range."""
    parts = ranges(path, range_bytes)
    if parts:
        rows = [(i, p.path, p.start, p.end) for i, p in enumerate(parts)]
        asked = spark.createDataFrame(rows, "i long, path string, start long, end long")
        asked = asked.repartition(min(len(parts), 10_000), "i")
        told = asked.mapInArrow(_effects, "i long, turns boolean, outside long, inside long")
        inside, depth = False, 0
        for row in sorted(told.collect(), key=lambda r: r.i):
            part = parts[row.i]
            if part.start == 0:
                inside, depth = False, 0
            part.inside, part.depth = inside, depth
            depth += row.inside if inside else row.outside
            inside ^= row.turns
    spark.dataSource.register(JsonElements)
    states = "\n".join(f"{p.path}\t{p.start}\t{p.end}\t{int(p.inside)}\t{p.depth}" for p in parts)
    return spark.read.format("json_elements").option("states", states).load()


def read_split_json_arrays(
    spark: SparkSession, path: str, schema: StructType | str, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Rows of JSON array files, whatever their size; elements that do not fit are NULL where they do
    not, as in Spark's own reader."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    rows = read_json_elements(spark, path, range_bytes)
    return rows.select(F.from_json("value", schema).alias("row")).select("row.*")
