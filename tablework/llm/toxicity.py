"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a document are the different single words, neighbouring pairs and pairs with one word
between, hashed to SLOTS places. FTRL-proximal keeps a learning rate per place and sets weights
without enough evidence to exactly zero, so what every task is told is a short list of places.
Training reads at most TRAIN_ROWS labelled rows; every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.llm import words as W
from tablework.llm.labels import labelled_sample, remainder
from tablework.llm.shared import documents, id_and_text

SLOTS = 1 << 20
TRAIN_ROWS = 12_000
EPOCHS = 10
ALPHA, BETA, L1, L2 = 2.0, 1.0, 10.0, 0.0
FOLDS, HELD_OUT = 5, 0


def features(part: W.Part) -> list[np.ndarray]:
    """Sorted different feature slots of each row."""
    found = W.words(part, gaps=W.NOT_ALNUM)
    h = found.hashes
    pairs = W.mix(h[:-1] * np.uint64(3) + h[1:])
    skips = W.mix(h[:-2] * np.uint64(5) + h[2:])
    mask, rows = np.uint64(SLOTS - 1), []
    one, two, three = ((x & mask).astype(np.int32) for x in (h, pairs, skips))
    for a, b in zip(found.rows[:-1].tolist(), found.rows[1:].tolist()):
        own = np.sort(np.concatenate([one[a:b], two[a : max(a, b - 1)], three[a : max(a, b - 2)]]))
        rows.append(own[np.append(True, own[1:] != own[:-1])] if len(own) else own)
    return rows


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            for part in W.parts(batch.column("text")):
                rest = batch.slice(part.first, len(part))
                rows = [x.tobytes() for x in features(part)]
                yield pa.RecordBatch.from_arrays(
                    [rest.column("doc_id"), rest.column("label"), pa.array(rows, pa.binary())],
                    ["doc_id", "label", "slots"],
                )


def fit(rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Places with a weight, their weights, and the intercept."""
    z, n = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)  # the last place is the intercept
    rows = [np.append(x, SLOTS) for x in rows]
    order = np.random.default_rng(5)
    l1 = np.full(SLOTS + 1, L1)
    l1[-1] = 0.0

    def weights(at):
        keep = np.abs(z[at]) > l1[at]
        rate = (BETA + np.sqrt(n[at])) / ALPHA + L2
        return np.where(keep, -(z[at] - np.sign(z[at]) * l1[at]) / rate, 0.0)

    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            at = rows[i]
            w = weights(at)
            p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = p - labels[i]
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    w = weights(np.arange(SLOTS + 1))
    places = np.flatnonzero(w[:-1])
    return places.astype(np.int32), w[places].astype(np.float32), float(w[-1])


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS):
    sample = labelled_sample(labels, "toxic", rows, FOLDS, HELD_OUT)
    texts = id_and_text(docs).join(F.broadcast(sample), "doc_id")  # the sample has a fixed bound
    found = texts.select("doc_id", "label", "text").mapInArrow(
        _training_rows, "doc_id long, label int, slots binary"
    ).toPandas()
    found = found.sort_values(["doc_id", "label", "slots"])
    return fit([np.frombuffer(x, np.int32) for x in found["slots"]], found["label"].to_numpy())


def _scores(model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, values, intercept = model.value
        weights = np.zeros(SLOTS, np.float32)
        weights[places] = values
        with np.errstate(over="ignore"):
            for batch in batches:
                for part in W.parts(batch.column("text")):
                    rest = batch.slice(part.first, len(part))
                    logits = np.array([weights[x].sum() for x in features(part)], np.float64) + intercept
                    scores = 1.0 / (1.0 + np.exp(-np.clip(logits, -35, 35)))
                    yield pa.RecordBatch.from_arrays(
                        [rest.column("doc_id"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                        ["doc_id", "score", "predicted"],
                    )

    return score


def scored(docs: DataFrame, model) -> DataFrame:
    """One row per row of ``docs``: doc_id, score, predicted. A null or empty text gets the score of
    a text without features; without labelled rows the score is 0.5 for all."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return id_and_text(docs).mapInArrow(_scores(shared), "doc_id long, score double, predicted int")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held_out = remainder(F.col("doc_id"), FOLDS) == HELD_OUT
    return scored(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted"
    )
