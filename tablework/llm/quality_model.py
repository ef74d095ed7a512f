"""Quality: a generalised additive model with pairwise interactions over text statistics.

Every feature is cut into bins at quantiles. Boosting goes round the features in turn: each turn
fits a tree of at most four leaves on one feature's bins to what is still unexplained and adds a
small part of it to that feature's table. Then the pairs of features that explain most of the rest
get tables of their own in the same way. A score is the sum of looked-up table values.

Training reads at most TRAIN_ROWS labelled rows; every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.llm import words as W
from tablework.llm.labels import labelled_sample, remainder
from tablework.llm.quality_rules import repeated_lines, repeated_words, sums
from tablework.llm.shared import documents, id_and_text

TRAIN_ROWS = 40_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE = 120, 60, 0.15
LEAST_LEAF = 5.0
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7

FEATURES = [
    "words", "word_length", "symbols", "punctuation", "exclamations", "digits", "capitals",
    "beyond_ascii", "line_words", "repeated_lines", "repeated_words", "different_words",
    "word_repeats", "ratio",
]


def _marks(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_TABLES = {
    "symbols": _marks(b"#*$%&|<>@^~_=+\\{}[]"),
    "punctuation": _marks(b".,;:?!"),
    "exclamations": _marks(b"!"),
    "digits": _marks(b"0123456789"),
    "capitals": _marks(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "beyond_ascii": _marks(bytes(range(0xC0, 256))),
}


def statistics(part: W.Part, press: zstandard.ZstdCompressor) -> np.ndarray:
    """One row of FEATURES for each row of a part; shares are of characters, words or lines."""
    found = W.words(part, fold=False)
    n_words = np.diff(found.rows)
    words = np.maximum(n_words, 1)
    chars = np.maximum(sums((part.data & 0xC0) != 0x80, part.offsets), 1)
    texts = [part.text(i) for i in range(len(part))]
    lines = np.array([x.count(b"\n") + 1 for x in texts])
    different, neighbours = [], []
    for a, b in zip(found.rows[:-1].tolist(), found.rows[1:].tolist()):
        own = found.hashes[a:b]
        order = np.sort(own)
        different.append(1 + np.count_nonzero(order[1:] != order[:-1]) if b > a else 0)
        neighbours.append(np.count_nonzero(own[1:] == own[:-1]))
    columns = {
        "words": np.log1p(n_words),
        "word_length": sums(~W.SPACE[part.data] & ((part.data & 0xC0) != 0x80), part.offsets) / words,
        "line_words": np.log1p(n_words / lines),
        "repeated_lines": np.array([repeated_lines(x) for x in texts]) / lines,
        "repeated_words": repeated_words(found) / words,
        "different_words": np.array(different) / words,
        "word_repeats": np.array(neighbours) / words,
        "ratio": np.array([len(x) / len(press.compress(x)) if x else 0.0 for x in texts]),
    }
    columns |= {name: sums(t[part.data], part.offsets) / chars for name, t in _TABLES.items()}
    return np.column_stack([columns[c] for c in FEATURES]).astype(np.float64)


class Tables:
    """A fitted model: bin edges, a table per feature, and a table per chosen pair."""

    def __init__(self, edges, mains, coarse, pairs, intercept):
        self.edges, self.mains, self.coarse, self.pairs = edges, mains, coarse, pairs
        self.intercept = intercept

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        rough = {}
        for j, (edges, table) in enumerate(zip(self.edges, self.mains)):
            total += table[np.searchsorted(edges, x[:, j], "right")]
            rough[j] = np.searchsorted(self.coarse[j], x[:, j], "right")
        for (i, j), table in self.pairs.items():
            total += table[rough[i], rough[j]]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain of the best cut of a row of bins in two, and where; no gain if no cut is allowed."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1) - g.sum() ** 2 / (h.sum() + 1)
    gain[(left_h < LEAST_LEAF / 4) | (right_h < LEAST_LEAF / 4)] = 0
    if not len(gain):
        return 0.0, 0
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A tree of depth two over the bins of a feature: the value it gives to each bin."""
    values = np.zeros(len(g))

    def grow(low: int, high: int, depth: int) -> None:
        gain, cut = _best_cut(g[low:high], h[low:high]) if depth else (0.0, 0)
        if gain > 1e-9:
            grow(low, low + cut, depth - 1)
            grow(low + cut, high, depth - 1)
        else:
            values[low:high] = g[low:high].sum() / (h[low:high].sum() + 1)

    grow(0, len(g), 2)
    return values


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """A tree that cuts a grid along one axis and each side along the other; its gain and values."""
    best = (0.0, np.zeros(g.shape))
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        for cut in range(1, len(a)):
            gain, values = 0.0, np.zeros(a.shape)
            for rows in (slice(0, cut), slice(cut, None)):
                own_g, own_h = a[rows].sum(axis=0), b[rows].sum(axis=0)
                _, at = _best_cut(own_g, own_h)
                for columns in (slice(0, at), slice(at, None)):
                    total, weight = own_g[columns].sum(), own_h[columns].sum() + 1
                    gain += total**2 / weight
                    values[rows, columns] = total / weight
            if gain > best[0]:
                best = (gain, values.T if turned else values)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> Tables:
    n, k = x.shape

    def edges_of(bins: int) -> list[np.ndarray]:
        cuts = np.linspace(0, 1, bins + 1)[1:-1]
        return [np.unique(np.quantile(x[:, j], cuts)) if n else np.zeros(0) for j in range(k)]

    edges, coarse = edges_of(BINS), edges_of(PAIR_BINS)
    mains = [np.zeros(len(e) + 1) for e in edges]
    rate = np.clip((y.sum() + 1) / (n + 2), 0.01, 0.99)
    intercept = float(np.log(rate / (1 - rate)))
    if not n:
        return Tables(edges, mains, coarse, {}, intercept)
    fine = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    rough = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(coarse)]
    total = np.full(n, intercept)

    def slopes():
        p = 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))
        return y - p, p * (1 - p)

    def grid(i: int, j: int, g: np.ndarray, h: np.ndarray):
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        cell, size = rough[i] * shape[1] + rough[j], shape[0] * shape[1]
        return np.bincount(cell, g, size).reshape(shape), np.bincount(cell, h, size).reshape(shape)

    for _ in range(ROUNDS):
        for j in range(k):
            g, h = slopes()
            size = len(mains[j])
            values = RATE * _tree(np.bincount(fine[j], g, size), np.bincount(fine[j], h, size))
            mains[j] += values
            total += values[fine[j]]
    g, h = slopes()
    ranked = sorted(
        ((_pair_tree(*grid(i, j, g, h))[0], i, j) for i in range(k) for j in range(i)), reverse=True
    )
    pairs = {
        (i, j): np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1)) for _, i, j in ranked[:PAIRS]
    }
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in pairs.items():
            g, h = slopes()
            values = RATE * _pair_tree(*grid(i, j, g, h))[1]
            table += values
            total += values[rough[i], rough[j]]
    return Tables(edges, mains, coarse, pairs, intercept)


def _statistics_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=1)
    with np.errstate(over="ignore"):
        for batch in batches:
            for part in W.parts(batch.column("text")):
                rest = batch.slice(part.first, len(part))
                values = statistics(part, press)
                yield pa.RecordBatch.from_arrays(
                    [
                        rest.column("doc_id"), rest.column("label"),
                        *(pa.array(values[:, j]) for j in range(len(FEATURES))),
                    ],
                    ["doc_id", "label", *FEATURES],
                )


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Tables:
    sample = labelled_sample(labels, "quality", rows, FOLDS, HELD_OUT)
    texts = id_and_text(docs).join(F.broadcast(sample), "doc_id")  # the sample has a fixed bound
    schema = "doc_id long, label int, " + ", ".join(f"{c} double" for c in FEATURES)
    found = texts.select("doc_id", "label", "text").mapInArrow(_statistics_rows, schema).toPandas()
    found = found.sort_values(["doc_id", "label", *FEATURES])
    return fit(found[FEATURES].to_numpy(np.float64), found["label"].to_numpy(np.float64))


def _scores(model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, tables = zstandard.ZstdCompressor(level=1), model.value
        with np.errstate(over="ignore"):
            for batch in batches:
                for part in W.parts(batch.column("text")):
                    scores = tables.score(statistics(part, press))
                    rest = batch.slice(part.first, len(part))
                    yield pa.RecordBatch.from_arrays(
                        [rest.column("doc_id"), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))],
                        ["doc_id", "score", "predicted"],
                    )

    return score


def scored(docs: DataFrame, model: Tables) -> DataFrame:
    """One row per row of ``docs``: doc_id, score, predicted. A null text is scored as an empty one;
    without labelled rows every score is the same."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return id_and_text(docs).mapInArrow(_scores(shared), "doc_id long, score double, predicted int")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held_out = remainder(F.col("doc_id"), FOLDS) == HELD_OUT
    return scored(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted"
    )
