"""The three models against plain loops over words, rows and bytes."""

import bisect
import math
import random
import re
import zlib

import numpy as np
import pytest

from tablework.llm import language, quality_model, toxicity


def sigmoid(x):
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


def terms(text):
    """Different words, pairs and pairs with one word between."""
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall("[0-9A-Za-z\x80-\U0010ffff]+", text or "")]
    found = {("one", w) for w in words}
    found |= {("two", *x) for x in zip(words, words[1:])}
    return found | {("skip", *x) for x in zip(words, words[2:])}


def loop_ftrl(rows):
    """Weights of terms by one coordinate at a time; None is the intercept."""
    z, n, order = {}, {}, np.random.default_rng(5)

    def weight(t):
        own, l1 = z.get(t, 0.0), 0.0 if t is None else toxicity.L1
        if abs(own) <= l1:
            return 0.0
        return -(own - math.copysign(l1, own)) / ((toxicity.BETA + math.sqrt(n[t])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for i in order.permutation(len(rows)):
            own, label = [*rows[i][0], None], rows[i][1]
            w = {t: weight(t) for t in own}
            g = sigmoid(sum(w.values())) - label
            for t in own:
                before = n.get(t, 0.0)
                rate = (math.sqrt(before + g * g) - math.sqrt(before)) / toxicity.ALPHA
                z[t] = z.get(t, 0.0) + g - rate * w[t]
                n[t] = before + g * g
    return {t: weight(t) for t in z}


def test_toxicity_equals_loops(spark):
    rng = random.Random(61)
    calm, bad = [f"calm{i}" for i in range(40)], ["Vile", "rotten", "scum", "naïve-fool"]
    rows, labels = [], []
    for i in range(500):
        toxic = int(rng.random() < 0.4)
        words = rng.choices(calm, k=rng.randint(3, 30)) + rng.choices(bad, k=3 * toxic)
        rng.shuffle(words)
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(words)))
        labels.append((i, toxic))
    docs = spark.createDataFrame(rows + [(500, ""), (501, None)], "doc_id bigint, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    learnt = [i for i in range(500) if zlib.crc32(str(i).encode()) % toxicity.FOLDS != toxicity.HELD_OUT]
    assert 0 < len(learnt) < 500
    weights = loop_ftrl([(terms(rows[i][1]), labels[i][1]) for i in learnt])
    assert len(model[0]) == sum(w != 0 for t, w in weights.items() if t is not None) > 3
    for r in toxicity.scored(docs, model).collect():
        text = rows[r.doc_id][1] if r.doc_id < 500 else ""
        expected = sigmoid(sum(weights.get(t, 0.0) for t in [*terms(text), None]))
        assert r.score == pytest.approx(expected, abs=1e-4) and r.predicted == (r.score >= 0.5)


def loop_cut(g, h):
    """Gain and place of the best cut of a row of bins."""
    best, total_g, total_h = (0.0, 0), sum(g), sum(h)
    least = quality_model.LEAST_LEAF / 4
    for cut in range(1, len(g)):
        a, b = sum(g[:cut]), sum(h[:cut])
        c, d = total_g - a, total_h - b
        gain = a * a / (b + 1) + c * c / (d + 1) - total_g**2 / (total_h + 1)
        if b >= least and d >= least and gain > best[0]:
            best = (gain, cut)
    return best


def loop_tree(g, h, depth=2):
    gain, cut = loop_cut(g, h) if depth else (0.0, 0)
    if gain > 1e-9:
        return loop_tree(g[:cut], h[:cut], depth - 1) + loop_tree(g[cut:], h[cut:], depth - 1)
    return [sum(g) / (sum(h) + 1)] * len(g)


def test_tables_equal_loops():
    """Cyclic boosting of the tables of single features, row by row."""
    rng = np.random.default_rng(62)
    n, k = 300, 3
    x = rng.normal(size=(n, k))
    y = (x[:, 0] + 0.5 * np.sin(3 * x[:, 1]) + 0.3 * rng.normal(size=n) > 0).astype(float)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(quality_model, "ROUNDS", 6)
        patch.setattr(quality_model, "PAIR_ROUNDS", 0)
        model = quality_model.fit(x, y)
    bins = [[bisect.bisect_right(list(model.edges[j]), v) for v in x[:, j]] for j in range(k)]
    tables = [[0.0] * (len(e) + 1) for e in model.edges]
    total = [model.intercept] * n
    assert model.intercept == pytest.approx(math.log((y.sum() + 1) / (n + 1 - y.sum())))
    for _ in range(6):
        for j in range(k):
            g, h = [0.0] * len(tables[j]), [0.0] * len(tables[j])
            for i in range(n):
                p = sigmoid(total[i])
                g[bins[j][i]] += y[i] - p
                h[bins[j][i]] += p * (1 - p)
            values = [quality_model.RATE * v for v in loop_tree(g, h)]
            tables[j] = [a + b for a, b in zip(tables[j], values)]
            total = [t + values[b] for t, b in zip(total, bins[j])]
    for own, expected in zip(model.mains, tables):
        assert np.allclose(own, expected, atol=1e-9)


def test_pair_tables_equal_loops():
    """The best tree over a grid by trying every cut, and scores by looking up every table."""
    rng = np.random.default_rng(63)
    for _ in range(20):
        g, h = rng.normal(size=(5, 6)) * 20, rng.random((5, 6)) * 30
        best = 0.0
        for a, b in ((g, h), (g.T, h.T)):
            for cut in range(1, len(a)):
                gain = 0.0
                for rows in (range(cut), range(cut, len(a))):
                    own = [[sum(m[r][c] for r in rows) for c in range(a.shape[1])] for m in (a, b)]
                    at = loop_cut(*own)[1]
                    for some in (slice(0, at), slice(at, None)):
                        gain += sum(own[0][some]) ** 2 / (sum(own[1][some]) + 1)
                best = max(best, gain)
        gain, values = quality_model._pair_tree(g, h)
        assert gain == pytest.approx(best)
        assert len(np.unique(values.round(9))) <= 4
    x = rng.normal(size=(400, 3))
    model = quality_model.fit(x, (x[:, 0] * x[:, 1] > 0).astype(float))
    assert model.pairs
    for row, score in zip(x, model.score(x)):
        total = model.intercept
        for j in range(3):
            total += model.mains[j][sum(row[j] >= e for e in model.edges[j])]
        for (i, j), table in model.pairs.items():
            total += table[sum(row[i] >= e for e in model.coarse[i])][sum(row[j] >= e for e in model.coarse[j])]
        assert score == pytest.approx(sigmoid(total))


def loop_states(way, data, n):
    """States of one direction after each byte, one number at a time."""
    h, out = [0.0] * n, []
    for byte in data:
        inner = [sum(way.u[i][j] * h[j] for j in range(n)) for i in range(3 * n)]
        z = [sigmoid(2 * (way.x[i][byte] + inner[i])) for i in range(n)]
        r = [sigmoid(2 * (way.x[n + i][byte] + inner[n + i])) for i in range(n)]
        new = [math.tanh(way.x[2 * n + i][byte] + r[i] * inner[2 * n + i]) for i in range(n)]
        h = [h[i] + z[i] * (new[i] - h[i]) for i in range(n)]
        out.append(h)
    return out


def loop_language(network, text):
    """Mean probabilities over all bytes, the network begun anew in each chunk."""
    data, n = text.encode(), network.hidden
    totals = [0.0] * len(network.languages)
    for low in range(0, len(data), language.CHUNK):
        chunk = data[low : low + language.CHUNK]
        ahead = loop_states(network.ways[0], chunk, n)
        back = loop_states(network.ways[1], chunk[::-1], n)[::-1]
        for a, b in zip(ahead, back):
            p = [math.exp(sum(w * s for w, s in zip(row, a + b)) + c[0]) for row, c in zip(network.v, network.c)]
            totals = [t + x / sum(p) for t, x in zip(totals, p)]
    return [t / len(data) for t in totals]


def test_language_equals_loops(spark):
    network = language.Network(["aa", "bb", "cc"], seed=64)
    rng = random.Random(65)
    texts = ["".join(rng.choices("abc déß日本\n.,", k=rng.choice([1, 47, 48, 49, 150]))) + "x" for _ in range(25)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in language.identified(docs, network).collect():
        p = loop_language(network, texts[r.doc_id])
        assert r.score == pytest.approx(max(p), abs=1e-4)
        assert p[network.languages.index(r.lang_pred)] == pytest.approx(max(p), abs=1e-4)
