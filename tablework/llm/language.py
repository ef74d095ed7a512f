"""Language identification by a bidirectional gated recurrent network over bytes.

A text is read as UTF-8 bytes in chunks of CHUNK bytes; within a chunk one network runs forward and
one backward. At every byte the two states give probabilities of all languages; a document's
probabilities are their mean over all its bytes. The network is trained here, in numpy, by
backpropagation through time, on chunks of TRAIN_ROWS documents at most (one of each language at least).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablework.llm.labels import remainder
from tablework.llm.shared import documents, id_and_text, written
from tablework.llm.words import Part, parts

CHUNK = 48
HIDDEN = 6
TRAIN_ROWS, TRAIN_CHUNKS = 3000, 4  # documents, and chunks taken from each at even distances
STEPS, BATCH, RATE = 260, 384, 0.02
RARE_SHARE = 0.5
LANES = 4096  # chunks that go through the network at once
FOLDS, HELD_OUT = 4, 2


class Direction:
    """Weights of one direction. Gates are kept in the form tanh(x / 2), so that one tanh serves
    the update gate, the reset gate and the candidate."""

    def __init__(self, random: np.random.Generator, hidden: int):
        self.x = (random.normal(0, 0.3, (3 * hidden, 256))).astype(np.float32)
        self.u = (random.normal(0, 0.5 / np.sqrt(hidden), (3 * hidden, hidden))).astype(np.float32)


class Network:
    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 11):
        random = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        self.ways = [Direction(random, hidden), Direction(random, hidden)]
        self.v = random.normal(0, 0.3, (len(languages), 2 * hidden)).astype(np.float32)
        self.c = np.zeros((len(languages), 1), np.float32)

    def weights(self) -> list[np.ndarray]:
        return [w for d in self.ways for w in (d.x, d.u)] + [self.v, self.c]

    def states(self, way: int, ids: np.ndarray, real: np.ndarray, keep: list | None = None):
        """States after each byte: (bytes, hidden, lanes). ``ids`` is (bytes, lanes); where ``real``
        is 0 there is no byte and the state stays as it is."""
        d, n = self.ways[way], self.hidden
        steps, lanes = ids.shape
        h = np.zeros((n, lanes), np.float32)
        out = np.empty((steps, n, lanes), np.float32)
        for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
            g = d.x.take(ids[t], axis=1)
            inner = d.u @ h
            g[: 2 * n] += inner[: 2 * n]
            gates = np.tanh(g[: 2 * n], out=g[: 2 * n])
            gates *= 0.5
            gates += 0.5
            g[2 * n :] += gates[n:] * inner[2 * n :]
            new = np.tanh(g[2 * n :], out=g[2 * n :])
            z = gates[:n]
            z *= real[t]
            if keep is not None:
                keep.append((t, h, z, gates[n:], new, inner[2 * n :]))
            h = h + z * (new - h)
            out[t] = h
        return out

    def probabilities(self, ids: np.ndarray, real: np.ndarray) -> np.ndarray:
        """Sums over the real bytes of each lane: (languages, lanes)."""
        n = self.hidden
        one, two = self.states(0, ids, real), self.states(1, ids, real)
        total = np.zeros((len(self.languages), ids.shape[1]), np.float32)
        for t in range(len(ids)):
            p = self.v[:, :n] @ one[t]
            p += self.v[:, n:] @ two[t]
            p += self.c
            np.exp(p, out=p)
            p *= real[t] / p.sum(axis=0)
            total += p
        return total

    def slopes(self, ids: np.ndarray, real: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross-entropy over all real bytes, in the order of weights()."""
        n, (steps, lanes) = self.hidden, ids.shape
        kept: list[list] = [[], []]
        states = [self.states(w, ids, real, kept[w]) for w in (0, 1)]
        aim = np.zeros((len(self.languages), lanes), np.float32)
        aim[target, np.arange(lanes)] = 1
        share = 1.0 / max(real.sum(), 1)
        dv, dc = np.zeros_like(self.v), np.zeros_like(self.c)
        into = [np.empty((steps, n, lanes), np.float32) for _ in (0, 1)]
        for t in range(steps):
            both = np.concatenate([states[0][t], states[1][t]])
            p = self.v @ both + self.c
            p = np.exp(p - p.max(axis=0))
            p = (p / p.sum(axis=0) - aim) * (real[t] * share)
            dv += p @ both.T
            dc += p.sum(axis=1, keepdims=True)
            back = self.v.T @ p
            into[0][t], into[1][t] = back[:n], back[n:]
        found = []
        for w, d in enumerate(self.ways):
            dx, du = np.zeros_like(d.x), np.zeros_like(d.u)
            dh = np.zeros((n, lanes), np.float32)
            for t, h, z, r, new, inner in reversed(kept[w]):
                dh = dh + into[w][t]
                dnew = dh * z * (1 - new * new)
                full = np.where(real[t] > 0, z, 0)
                dz = dh * (new - h) * full * (1 - full)
                dr = dnew * inner * r * (1 - r)
                dg = np.concatenate([dz, dr, dnew])
                dinner = np.concatenate([dz, dr, dnew * r])
                du += dinner @ h.T
                dh = dh * (1 - z) + d.u.T @ dinner
                for row in range(3 * n):
                    dx[row] += np.bincount(ids[t], dg[row], 256)
            # The gates' inputs are halved inside tanh.
            dx[: 2 * n] *= 2
            du[: 2 * n] *= 2
            found += [dx, du]
        return found + [dv, dc]


def lanes_of(data: np.ndarray, offsets: np.ndarray, chunk: int = CHUNK):
    """Chunks of all rows side by side: ids and presence (chunk, lanes), and the row of each lane."""
    sizes = np.diff(offsets)
    many = -(-sizes // chunk)
    row = np.repeat(np.arange(len(sizes)), many)
    within = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    start = offsets[:-1][row] + within * chunk
    at = start[None, :] + np.arange(chunk)[:, None]
    real = at < offsets[1:][row][None, :]
    ids = np.where(real, data[np.minimum(at, len(data) - 1)], 0) if len(data) else at.astype(np.uint8)
    return ids, real.astype(np.float32), row


def fit(chunks: list[bytes], target: np.ndarray, languages: list[str]) -> Network:
    """Adam over random batches of chunks. Each language gets at least a RARE_SHARE of an equal share
    of the draws, however few chunks it has."""
    network = Network(languages)
    if len(languages) < 2 or not chunks:
        return network
    ends = np.cumsum([0, *(len(c) for c in chunks)])
    ids, real, _ = lanes_of(np.frombuffer(b"".join(chunks), np.uint8), ends)
    random, weights = np.random.default_rng(3), network.weights()
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    counts = np.bincount(target, minlength=len(languages)).astype(float)
    share = np.maximum(counts / counts.sum(), RARE_SHARE / len(languages))
    chance = (share / share.sum() / np.maximum(counts, 1))[target]
    chance /= chance.sum()
    for step in range(1, STEPS + 1):
        some = random.choice(len(chunks), BATCH, p=chance)
        rate = RATE * min(1.0, 2.0 * (1 - step / (STEPS + 1)))
        for w, g, m, s in zip(weights, network.slopes(ids[:, some], real[:, some], target[some]), first, second):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return network


def _training_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, lang, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "lang", "text"))):
            data = text.encode()
            for i in range(TRAIN_CHUNKS):
                at = max(0, len(data) - CHUNK) * i // max(1, TRAIN_CHUNKS - 1)
                if data:
                    rows.append((doc_id, i, lang, data[at : at + CHUNK]))
        columns = list(zip(*rows)) or [()] * 4
        kinds = (pa.int64(), pa.int32(), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "i", "lang", "chunk"]
        )


def train(docs: DataFrame, rows: int = TRAIN_ROWS) -> Network:
    """Reads documents that have a language and are not held out: of each language the first by hash,
    as many as give ``rows`` in all if every language has so many, and at least one. So each language
    that any of them has is learnt."""
    named = docs.where(docs["lang"].isNotNull() & docs["doc_id"].isNotNull())
    named = named.where(remainder(F.col("doc_id"), FOLDS) != HELD_OUT)
    counts = written(named.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    each = max(1, rows // max(1, counts.count()))
    # Far more than ``each`` documents of a language lie below its share of all hashes; only those
    # are put in order.
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31))
    share = counts.select("lang", (F.least(F.lit(1.0), (4 * each + 100) / F.col("n")) * (1 << 31)).alias("most"))
    some = named.select("doc_id", "lang", place.alias("place")).join(F.broadcast(share), "lang")
    some = some.where(F.col("place") < F.col("most")).select("doc_id", "lang", "place").distinct()
    by_hash = Window.partitionBy("lang").orderBy("place", "doc_id")
    chosen = some.withColumn("rank", F.row_number().over(by_hash)).where(F.col("rank") <= each)
    chosen = chosen.select("doc_id").distinct()
    own = named.select(
        named["doc_id"].cast("long").alias("doc_id"), named["lang"].cast("string").alias("lang"),
        F.coalesce(named["text"].cast("string"), F.lit("")).alias("text"),
    )
    found = own.join(F.broadcast(chosen), "doc_id").mapInArrow(
        _training_chunks, "doc_id long, i int, lang string, chunk binary"
    ).toPandas()
    found = found.sort_values(["doc_id", "i", "lang", "chunk"])
    languages = sorted(set(found["lang"]))
    target = found["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(np.int64)
    return fit(found["chunk"].tolist(), target, languages)


def _has_letter(part: Part, row: int) -> bool:
    text = part.text(row).decode()
    return any(map(str.isalpha, text[:256])) or any(map(str.isalpha, text[256:]))


def _predictions(shared):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        for batch in batches:
            for part in parts(batch.column("text"), LANES * CHUNK):
                total = np.zeros((len(part), len(network.languages)))
                for ids, real, row in _lane_runs(part):
                    found = network.probabilities(ids, real).astype(np.float64)
                    for k in range(len(network.languages)):
                        total[:, k] += np.bincount(row, found[k], len(part))
                total /= np.maximum(total.sum(axis=1, keepdims=True), 1e-9)
                letters = np.array([_has_letter(part, i) for i in range(len(part))], bool)
                if network.languages:
                    best = total.argmax(axis=1)
                    score = np.where(letters, total.max(axis=1), 0.0)
                    names = [network.languages[k] if ok else "und" for k, ok in zip(best, letters)]
                else:
                    score, names = np.zeros(len(part)), ["und"] * len(part)
                rest = batch.slice(part.first, len(part))
                yield pa.RecordBatch.from_arrays(
                    [rest.column("doc_id"), pa.array(names, pa.string()), pa.array(np.minimum(score, 1.0))],
                    ["doc_id", "lang_pred", "score"],
                )

    return predict


def _lane_runs(part: Part):
    """Lanes of a part, LANES at a time; a row longer than that comes in several runs."""
    step = LANES * CHUNK
    if len(part) > 1 or len(part.data) <= step:
        yield lanes_of(part.data, part.offsets)
        return
    for low in range(0, len(part.data), step):
        piece = part.data[low : low + step]
        yield lanes_of(piece, np.array([0, len(piece)]))


def identified(docs: DataFrame, network: Network) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score. A text that is null or has no letter is
    ``und`` with score 0, as is every text if no document has a language to learn from."""
    shared = docs.sparkSession.sparkContext.broadcast(network)
    return id_and_text(docs).mapInArrow(
        _predictions(shared), "doc_id long, lang_pred string, score double"
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = remainder(F.col("doc_id"), FOLDS) == HELD_OUT
    return identified(docs, train(docs)).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
