"""Token-ID files: a binary format of its own, written and read by Spark as ``token_files``.

Ids are replaced by their rank in the whole corpus, so that frequent ones are small, and coded in one
to four bytes each. The lengths, two bits each, stand apart from the bytes as control bytes of four
ids; a document begins with a control byte of its own. Decoding is a look-up of every control byte in
tables of lengths and byte places, with no loop over ids.

A folder holds
    _ranks      the ids by falling frequency, little-endian unsigned 32-bit
    _manifest   JSON: the data files in ascending order of their documents, with their counts
    *.tok       data files, one per task: blocks one after another
and a block holds
    3 unsigned 64-bit numbers: documents, control bytes, data bytes
    1 byte per document: whether it has a doc_id;  its doc_id, signed 64-bit;  its ids, unsigned 64-bit
    the control bytes of all documents;  the data bytes of all documents

Data files get a name that no other attempt of a task uses, and only those whose task was committed
get into the manifest, so a lost executor or a task that runs twice changes nothing. Files are opened
by ``pyarrow.fs``, so the folder may be in any store that it knows by URI (or a local path).
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from tablework.llm.shared import ARROW_ROWS, TEXTS_PER_BATCH, documents, id_and_text, written
from tablework.llm.token_ids import token_ids
from tablework.llm.words import parts
from tablework.storage import fresh_path

END = 2
VOCABULARY = "word_bpe_49k.json"
BLOCK_BYTES = 2 << 20
RANKS, MANIFEST = "_ranks", "_manifest"

CODED = "doc_id long, place long, n_tokens long, control binary, data binary"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"

# For each control byte: the bytes of its four ids, and for each byte of the four decoded 32-bit
# numbers its place in the data, with 255 for a byte that is not stored.
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1
_ENDS = np.cumsum(_LENGTHS, axis=1)
_PLACES = np.where(
    np.arange(4) < _LENGTHS[:, :, None], (_ENDS - _LENGTHS)[:, :, None] + np.arange(4), 255
).reshape(256, 16)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Control and data bytes of numbers, whose count is a multiple of four, and the length of each."""
    code = (values >= 1 << 8).astype(np.uint8)
    code += values >= 1 << 16
    code += values >= 1 << 24
    four = code.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    raw = values.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control, raw[np.arange(4) <= code[:, None]], code.astype(np.int64) + 1


def decode(control: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The numbers of control and data bytes."""
    sizes = _ENDS[control, 3]
    if sizes.sum() != len(data):
        raise ValueError("damaged block: control bytes do not fit the data")
    places = _PLACES[control]
    absent = places == 255
    places += (np.cumsum(sizes) - sizes)[:, None]
    places[absent] = len(data)
    return np.append(data, np.uint8(0))[places].view("<u4").ravel()


def _binary(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    places = pa.py_buffer(offsets.astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, places, pa.py_buffer(data.tobytes())])


def _raw_ids(path: str, end: int, kind: str):
    """Ids of every text with the end id, as they come."""

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = token_ids(path)
        for batch in batches:
            for part in parts(batch.column("text")):
                found, rows = store.of(part)
                ids = np.insert(found, rows[1:], end).astype(kind)
                at = (rows + np.arange(len(rows))) * ids.itemsize
                own = batch.slice(part.first, len(part))
                yield pa.RecordBatch.from_arrays(
                    [own.column("doc_id"), own.column("place"), _binary(at, ids)],
                    ["doc_id", "place", "ids"],
                )

    return raw


def _ids_of(batch: pa.RecordBatch, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch, and where each row begins and ends."""
    column = batch.column("ids")
    _, places, values = column.buffers()
    wide = pa.types.is_large_binary(column.type)
    at = np.frombuffer(places, np.int64 if wide else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].astype(np.int64)
    size = np.dtype(kind).itemsize
    ids = np.frombuffer(values, kind, (at[-1] - at[0]) // size, at[0])
    return ids, (at - at[0]) // size


def _counts(kind: str, vocabulary: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            if batch.num_rows:
                total += np.bincount(_ids_of(batch, kind)[0], minlength=vocabulary)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": pa.array(seen), "n": pa.array(total[seen])})

    return count


def _coded(kind: str, rank: np.ndarray):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, rows = _ids_of(batch, kind)
            n = np.diff(rows)
            fours = np.append(0, np.cumsum(-(-n // 4)))
            values = np.zeros(4 * fours[-1], np.uint32)  # a document is filled up with rank 0
            values[np.repeat(4 * fours[:-1] - rows[:-1], n) + np.arange(rows[-1])] = rank[ids]
            control, data, lengths = encode(values)
            at = np.append(0, np.cumsum(lengths))[4 * fours]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("place"), pa.array(n, pa.int64()),
                    _binary(fours, control), _binary(at, data),
                ],
                ["doc_id", "place", "n_tokens", "control", "data"],
            )

    return code


@dataclass
class _Written(WriterCommitMessage):
    name: str
    first: tuple
    documents: int
    ids: int


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, folder = _opened(self.path)
        name, out = f"{uuid.uuid4().hex}.tok", None
        held: list[tuple] = []
        size = n_documents = n_ids = 0
        first: tuple = ()

        def flush() -> None:
            numbers = (len(held), sum(len(c) for *_, c, _ in held), sum(len(d) for *_, d in held))
            out.write(np.array(numbers, "<u8").tobytes())
            out.write(np.array([x is not None for x, *_ in held], np.uint8).tobytes())
            out.write(np.array([x or 0 for x, *_ in held], "<i8").tobytes())
            out.write(np.array([n for _, n, _, _ in held], "<u8").tobytes())
            out.write(b"".join(c for *_, c, _ in held))
            out.write(b"".join(d for *_, d in held))

        for batch in iterator:
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "place", "n_tokens", "control", "data")]
            for doc_id, place, n, control, data in zip(*columns):
                if out is None:
                    first = (doc_id is not None, doc_id or 0, place)
                    out = store.open_output_stream(f"{folder}/{name}", compression=None)
                held.append((doc_id, n, control, data))
                size += len(control) + len(data) + 17
                n_documents, n_ids = n_documents + 1, n_ids + n
                if size >= BLOCK_BYTES:
                    flush()
                    held, size = [], 0
        if held:
            flush()
        if out is not None:
            out.close()
        return _Written(name, first, n_documents, n_ids)

    def commit(self, messages: list) -> None:
        store, folder = _opened(self.path)
        made = sorted((m for m in messages if m is not None and m.documents), key=lambda m: m.first)
        files = [{"name": m.name, "documents": m.documents, "ids": m.ids} for m in made]
        with store.open_output_stream(f"{folder}/{MANIFEST}", compression=None) as out:
            out.write(json.dumps({"files": files}).encode())


@dataclass
class _File(InputPartition):
    name: str
    start: int


class _Reader(DataSourceReader):
    def __init__(self, path: str, ids: bool):
        self.path, self.ids = path, ids
        store, folder = _opened(path)
        with store.open_input_stream(f"{folder}/{RANKS}", compression=None) as source:
            self.by_rank = np.frombuffer(source.read(), "<u4")
        with store.open_input_stream(f"{folder}/{MANIFEST}", compression=None) as source:
            self.files = json.loads(source.read())["files"]

    def partitions(self) -> list[InputPartition]:
        found, start = [], 0
        for file in self.files:
            found.append(_File(file["name"], start))
            start += file["ids"]
        return found

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, _File):  # an empty folder has no files
            return
        store, folder = _opened(self.path)
        start = partition.start
        with store.open_input_stream(f"{folder}/{partition.name}", compression=None) as source:
            while head := source.read(24):
                n, n_control, n_data = np.frombuffer(head, "<u8").tolist()
                body = source.read(17 * n + n_control + n_data)
                if len(body) != 17 * n + n_control + n_data:
                    raise ValueError(f"{partition.name} ends inside a block")
                has_id = np.frombuffer(body, np.uint8, n).astype(bool)
                doc_ids = np.frombuffer(body, "<i8", n, n)
                lengths = np.frombuffer(body, "<u8", n, 9 * n).astype(np.int64)
                control = np.frombuffer(body, np.uint8, n_control, 17 * n)
                data = np.frombuffer(body, np.uint8, n_data, 17 * n + n_control)
                ids = self.by_rank[decode(control, data)].astype("<u4")
                raw = memoryview(ids).cast("B")
                at = 16 * (np.cumsum(-(-lengths // 4)) - -(-lengths // 4))
                own = [raw[a : a + 4 * k] for a, k in zip(at.tolist(), lengths.tolist())]
                columns = {
                    "doc_id": pa.array(doc_ids, pa.int64(), mask=~has_id),
                    "start": pa.array(start + np.cumsum(lengths) - lengths, pa.int64()),
                    "n_tokens": pa.array(lengths, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(x) for x in own], pa.int64()),
                }
                if self.ids:
                    columns["ids"] = pa.array([bytes(x) for x in own], pa.binary())
                start += int(lengths.sum())
                yield pa.RecordBatch.from_pydict(columns)


class TokenFiles(DataSource):
    """``spark.read.format("token_files").load(folder)``: one row per document with the place of its
    first id, its number of ids and their checksum; with option ``ids`` also the ids themselves,
    little-endian unsigned 32-bit."""

    @classmethod
    def name(cls) -> str:
        return "token_files"

    def schema(self) -> str:
        return f"{READ}, ids binary" if self._ids() else READ

    def _ids(self) -> bool:
        return str(self.options.get("ids", "false")).lower() == "true"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], self._ids())

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"])


def write_token_files(
    docs: DataFrame, folder: str, path: str | None = None, end: int = END
) -> None:
    """Write the ids of every row of ``docs`` in ascending doc_id order to a folder that is new.

    A null or empty text is the end id alone. Rows without a doc_id come first and keep a null one;
    rows that share a doc_id stand side by side in any order. No rows give a folder without data
    files. The table of ranks is no longer than the vocabulary.
    """
    spark, path = docs.sparkSession, path or public_tokenizers.path(VOCABULARY)
    vocabulary = max(token_ids(path).size, end + 1)
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"
    rows = id_and_text(docs).withColumn("place", F.monotonically_increasing_id())
    raw = rows.mapInArrow(_raw_ids(path, end, kind), "doc_id long, place long, ids binary")
    raw = written(raw, "ids", "zstd")
    counts = raw.select("ids").mapInArrow(_counts(kind, vocabulary), "id long, n long")
    counts = counts.groupBy("id").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "id").collect()
    by_rank = np.array([r.id for r in counts], "<u4")
    rank = np.zeros(vocabulary, np.uint32)
    rank[by_rank] = np.arange(len(by_rank))

    store, place = _opened(folder)
    store.create_dir(place)
    with store.open_output_stream(f"{place}/{RANKS}", compression=None) as out:
        out.write(by_rank.tobytes())
    spark.dataSource.register(TokenFiles)
    coded = raw.mapInArrow(_coded(kind, rank), CODED)
    ordered = coded.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place")
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(min(int(before), TEXTS_PER_BATCH)))
    try:
        ordered.write.format("token_files").mode("append").save(folder)
    finally:
        spark.conf.set(ARROW_ROWS, before)


def read_token_files(spark: SparkSession, folder: str, ids: bool = False) -> DataFrame:
    spark.dataSource.register(TokenFiles)
    return spark.read.format("token_files").option("ids", ids).load(folder)


def op12_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "tokens")
    write_token_files(documents(spark, sf_dir), folder)
    return read_token_files(spark, folder)
