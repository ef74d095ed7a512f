"""Best-fit packing of token sequences.

Every document becomes token ids, ends in an id of its own and is cut only where it is longer than a
sequence. Pieces go, largest first, into the open sequence with the least room that still holds
them; a segment tree over room sizes finds it in logarithmic time. Pieces are dealt by hash into
groups of about GROUP_TOKENS tokens, or GROUP_PIECES pieces where these are short, that are packed
independently: each group can leave one badly filled sequence, about one in a thousand.

Only ids, lengths and checksums of pieces are shuffled, never text or tokens.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.llm.shared import documents, id_and_text, written
from tablework.llm.token_ids import token_ids
from tablework.llm.words import parts

SEQUENCE = 4096
END = 1
GROUP_TOKENS = 4 << 20
GROUP_PIECES = 200_000
PART_BYTES = 256 << 10  # text at once; the arrays for it are some thirty times as large
VOCABULARY = "word_bpe_49k.json"

PIECES = "doc_id long, place long, piece int, start long, length long, ids_crc32 long"
PLACED = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
)


def _pieces(path: str, sequence: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, end = token_ids(path), np.array([END], "<u4").tobytes()
        for batch in batches:
            doc_ids, places = batch.column("doc_id").to_pylist(), batch.column("place").to_pylist()
            for part in parts(batch.column("text"), PART_BYTES):
                found, rows = store.of(part)
                raw = memoryview(found.astype("<u4")).cast("B")
                made: list[tuple] = []
                for i in range(len(part)):
                    own, n = raw[4 * rows[i] : 4 * rows[i + 1]], int(rows[i + 1] - rows[i]) + 1
                    at = part.first + i
                    for piece, start in enumerate(range(0, n, sequence)):
                        crc = zlib.crc32(own[4 * start : 4 * (start + sequence)])
                        length = min(sequence, n - start)
                        if start + length == n:
                            crc = zlib.crc32(end, crc)
                        made.append((doc_ids[at], places[at], piece, start, length, crc))
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*made), kinds)],
                    ["doc_id", "place", "piece", "start", "length", "ids_crc32"],
                )

    return cut


def best_fit(lengths: np.ndarray, sequence: int) -> tuple[list[int], list[int]]:
    """Sequence number and offset for each length, given in falling order."""
    size = 1 << sequence.bit_length()
    open_ = [0] * (2 * size)  # segment tree: open sequences whose room lies below this node
    with_room: list[list[int]] = [[] for _ in range(sequence + 1)]

    def count(room: int, by: int) -> None:
        at = room + size
        while at:
            open_[at] += by
            at >>= 1

    def tightest(least: int) -> int:
        at = least + size
        if open_[at]:
            return least
        while at > 1 and (at & 1 or not open_[at + 1]):
            at >>= 1
        if at <= 1:
            return -1
        at += 1
        while at < size:
            at = 2 * at if open_[2 * at] else 2 * at + 1
        return at - size

    numbers, offsets, made = [], [], 0
    for length in lengths.tolist():
        room = tightest(length)
        if room < 0:
            number, room, made = made, sequence, made + 1
        else:
            number = with_room[room].pop()
            count(room, -1)
        numbers.append(number)
        offsets.append(sequence - room)
        left = room - length
        if left:
            with_room[left].append(number)
            count(left, 1)
    return numbers, offsets


def _packed(groups: int, sequence: int):
    def pack(table: pa.Table) -> pa.Table:
        ties = [(name, "ascending") for name in ("doc_id", "place", "piece")]
        table = table.sort_by([("length", "descending"), *ties])
        numbers, offsets = best_fit(table.column("length").to_numpy(), sequence)
        first = table.column("bin")[0].as_py()
        ids = np.array(numbers, np.int64) * groups + first
        return table.drop_columns(["bin", "place"]).append_column("sequence_id", pa.array(ids)).append_column(
            "offset", pa.array(offsets, pa.int64())
        )

    return pack


def packed(docs: DataFrame, path: str | None = None, sequence: int = SEQUENCE) -> DataFrame:
    """One row per piece of each row of ``docs``: where it lies in its document and in which
    sequence, with a checksum of its ids. A null or empty text is the end id alone; rows that repeat
    are packed each; a missing doc_id stays missing. No documents, no sequences."""
    path = path or public_tokenizers.path(VOCABULARY)
    # A number of its own for each row, kept with its pieces: rows without or with the same doc_id
    # are dealt to all groups.
    rows = id_and_text(docs).withColumn("place", F.monotonically_increasing_id())
    pieces = written(rows.mapInArrow(_pieces(path, sequence), PIECES), "pieces")
    total, count = pieces.agg(F.sum("length"), F.count("*")).first()
    groups = max(1, -(-(total or 0) // GROUP_TOKENS), -(-count // GROUP_PIECES))
    dealt = pieces.withColumn("bin", F.pmod(F.xxhash64("place", "piece"), F.lit(groups)))
    return dealt.groupBy("bin").applyInArrow(_packed(groups, sequence), PLACED)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))
