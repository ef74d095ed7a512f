"""Quality rules: counts of symbols and repetition, and compression bands.

zstandard ratios (bytes over compressed bytes) of the whole text and of fixed chunks. Ordinary prose
lies in a band that depends on the length: short texts hardly compress, long ones do. A text above
the band repeats itself, one below it is noise; a text is rejected as well if a third of its bytes lie
in chunks outside theirs. The last chunk counts like the others, with the band of its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from tablework.llm import words as W
from tablework.llm.shared import documents, id_and_text

LEVEL = 3
CHUNK = 4096
# Up to so many bytes: least and largest ratio of ordinary text.
BANDS = [(256, 0.5, 2.6), (1024, 1.1, 2.8), (4096, 1.4, 3.2), (16384, 1.5, 3.6), (2**62, 1.5, 4.5)]
CHUNK_BAND = (1.4, 4.0)
WINDOW = 8
MIN_WORDS, MAX_REPEATED = 20, 30

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, ratio double, odd_chunks double, kept boolean"
)


def sums(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many marks lie in each row."""
    total = np.append(0, np.cumsum(marks, dtype=np.int64))
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated_words(found: W.Words, window: int = WINDOW) -> np.ndarray:
    """Per row the words that lie in a run of ``window`` words found twice or more in the row."""
    every, counts = W.runs(found.hashes, window), []
    for a, b in zip(found.rows[:-1].tolist(), found.rows[1:].tolist()):
        own = every[a : max(a, b - window + 1)]
        order = np.sort(own)
        again = order[1:][order[1:] == order[:-1]]
        if not len(again):
            counts.append(0)
            continue
        hit = np.flatnonzero(np.isin(own, again))
        cover = np.zeros(b - a + 1, np.int64)
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + window, -1)
        counts.append(int((np.cumsum(cover) > 0).sum()))
    return np.array(counts, np.int64)


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def band(size: int) -> tuple[float, float]:
    """Least and largest ratio of ordinary text of so many bytes."""
    return next((low, high) for most, low, high in BANDS if size <= most)


def in_bands(text: bytes, press: zstandard.ZstdCompressor) -> tuple[float, float, bool]:
    """Ratio of the whole text, share of its bytes in odd chunks, and whether both are as in ordinary
    text. The last chunk, which may be shorter, has the band of its own length."""
    if not text:
        return 0.0, 0.0, False
    ratio = len(text) / len(press.compress(text))
    odd = 0  # bytes in chunks outside their band
    for i in range(0, len(text), CHUNK):
        chunk = text[i : i + CHUNK]
        own = len(chunk) / len(press.compress(chunk)) if len(text) > CHUNK else ratio
        low, high = CHUNK_BAND if len(chunk) == CHUNK and len(text) > CHUNK else band(len(chunk))
        odd += len(chunk) * (not low <= own <= high)
    low, high = band(len(text))
    return ratio, odd / len(text), low <= ratio <= high and 3 * odd < len(text)


def _rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    with np.errstate(over="ignore"):
        for batch in batches:
            for part in W.parts(batch.column("text")):
                found = W.words(part, fold=False)
                n_words = np.diff(found.rows)
                inside = ~W.SPACE[part.data] & ((part.data & 0xC0) != 0x80)
                repeated = repeated_words(found)
                texts = [part.text(i) for i in range(len(part))]
                bands = [in_bands(x, press) for x in texts]
                failed = (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEATED * n_words)
                good = np.array([x[2] for x in bands], bool)
                columns = [
                    n_words, sums(inside, part.offsets), sums(_SYMBOL[part.data], part.offsets),
                    np.array([repeated_lines(x) for x in texts], np.int64), repeated, failed,
                    np.array([x[0] for x in bands]), np.array([x[1] for x in bands]), good & ~failed,
                ]
                rest = batch.slice(part.first, len(part))
                names = [c.split()[0] for c in FIELDS.split(", ")]
                kept = [c for c in batch.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*(rest.column(c) for c in kept), *(pa.array(c) for c in columns)], kept + names
                )


def rule_results(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: the counts, ``base_failed``, the ratios and ``kept``. A null text
    has no words and fails, as every text of fewer than MIN_WORDS words does."""
    return id_and_text(docs).mapInArrow(_rules, f"doc_id long, {FIELDS}")


def _passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = pa.RecordBatch.from_arrays([batch.column("text")], ["text"])
        for result in _rules(iter([text])):
            rows = batch.slice(0, result.num_rows)
            batch = batch.slice(result.num_rows)
            yield rows.filter(result.column("kept"))


def passing(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep; all columns."""
    return docs.mapInArrow(_passing, docs.schema)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_results(documents(spark, sf_dir))
