"""Packing, quality rules, secrets, and the three models."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer
import public_tokenizers

from tablework.llm import automaton, language, packing, quality_model, quality_rules, secrets, toxicity
from tablework.llm import words as W

SF = "/root/testdata/sf0.01"


def test_words_and_shingles_do_not_depend_on_parts():
    texts = ["One two  THREE\tfour five six", "", None, "é ß " * 40, "x" * 5000, "a b", " lead and trail "]
    whole = [x for p in W.parts(pa.array(texts)) for x in W.shingle_sets(W.words(p))]
    single = [x for t in texts for p in W.parts(pa.array([t], pa.string()), 3) for x in W.shingle_sets(W.words(p))]
    assert [x.tolist() for x in whole] == [x.tolist() for x in single]
    assert [len(x) for x in whole] == [2, 0, 0, 2, 1, 1, 1]
    small = [p for p in W.parts(pa.array(texts), 10)]
    assert [p.first for p in small] == sorted(p.first for p in small) and sum(map(len, small)) == len(texts)


def test_packing(docs, rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    expected = Counter()
    for doc_id, value, *_ in rows:
        ids = [*tokenizer.encode(value or "", add_special_tokens=False).ids, packing.END]
        for k in range(0, len(ids), 4096):
            part = np.array(ids[k : k + 4096], "<u4")
            expected[(doc_id, k // 4096, k, len(part), zlib.crc32(part.tobytes()))] += 1
    found = packing.packed(docs).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(sequences) == -(-sum(r.length for r in found) // 4096)


def test_best_fit_takes_the_tightest_open_sequence():
    rng = random.Random(1)
    lengths = sorted((rng.randint(1, 50) for _ in range(300)), reverse=True)
    numbers, offsets = packing.best_fit(np.array(lengths), 64)
    rooms: list[int] = []
    for length, number, offset in zip(lengths, numbers, offsets):
        fitting = [r for r in rooms if r >= length]
        if not fitting:
            assert number == len(rooms) and offset == 0
            rooms.append(64)
        assert rooms[number] == (min(fitting) if fitting else 64)
        assert offset == 64 - rooms[number]
        rooms[number] -= length


def test_packing_of_nothing(nothing):
    assert packing.packed(nothing).count() == 0


def base_counts(value):
    words = re.findall(r"[^\x20\x09-\x0D]+", value)
    lines = [x for x in value.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {
        i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)
    }
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", value)),
        len(lines) - len(set(lines)), len(covered),
        len(words) < 20 or 100 * len(covered) > 30 * len(words),
    )


def test_quality_rules(docs, rows):
    found = quality_rules.rule_results(docs).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter((r.doc_id, *(r[c] for c in names)) for r in found) == Counter(
        (r[0], *base_counts(r[1] or "")) for r in rows
    )
    assert all(not r.kept for r in found if r.base_failed)
    passing = quality_rules.passing(docs)
    assert passing.columns == docs.columns
    assert Counter(r.doc_id for r in passing.collect()) == Counter(r.doc_id for r in found if r.kept)


def test_compression_bands(spark):
    rng = random.Random(2)
    prose = " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(900))
    noise = " ".join("".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(9)) for _ in range(300))
    templates = "\n".join(f"the item number {i} of our list" for i in range(400))
    docs = spark.createDataFrame(enumerate([prose, noise, templates]), "doc_id bigint, text string")
    kept = {r.doc_id: (r.kept, r.base_failed) for r in quality_rules.rule_results(docs).collect()}
    assert kept[0] == (True, False) and not kept[1][0] and kept[2] == (False, False)


def test_quality_rules_of_nothing(nothing):
    assert quality_rules.rule_results(nothing).count() == 0 and quality_rules.passing(nothing).count() == 0


ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def base_spans(value):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(value) if len(m[1]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", value) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", value) if len(m[0]) >= 32]
    return sorted(found)


def test_secrets(spark):
    rng = random.Random(6)
    pieces = ["password", "token", "Secret", "api_key", "APIKEY", "AKIA", ":", "=", " ", "'", '"', "abc",
              "0123456789abcdef", "ABCDEFGH1234", "é", "\n", "-", ".", "x", "deadbeef"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(1, 60))) for _ in range(1500)]
    texts += ["secret: token: abcdefghij", "password" + " " * 9000 + ":abcdefgh9", "token=" + "a" * 70_000, "", None]
    texts += ["ghp_" + "a1B2" * 9, "-----BEGIN RSA PRIVATE KEY-----"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in secrets.secret_spans(docs).collect():
        spans = base_spans(texts[r.doc_id] or "")
        joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), texts[r.doc_id]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for _, k, _ in spans) for x in range(3)]
        base = [x for x in r.spans.split(",") if x.split(":")[0] in ("assign", "access", "hex")]
        assert ",".join(base) == joined
        if r.doc_id >= len(texts) - 2:
            assert r.spans.startswith(("github:0:40", "private:0:31"))


def test_secrets_of_nothing(nothing, docs, rows):
    assert secrets.secret_spans(nothing).count() == 0
    assert secrets.secret_spans(docs).count() == len(rows)


def test_automaton_equals_regexes():
    patterns = ["ab+c", "(?:x|yz){2,3}", "[0-4]{3}", "b?c"]
    table = automaton.compile_rules(patterns, anywhere=True)
    rng = random.Random(8)
    data = "".join(rng.choices("abcxyz0123é", k=9000)).encode()
    ends = table.scan(np.frombuffer(data, np.uint8))
    for i in range(1, len(data) + 1):
        near = data[max(0, i - 30) : i]
        expected = sum(
            1 << k for k, p in enumerate(patterns) if re.search(b"(?:" + p.encode() + b")\\Z", near)
        )
        assert ends[i - 1] == expected


def test_backwards_and_longest_equal_regexes():
    """Where matches begin, and their first and last ends, by trying every stretch."""
    patterns = ["ab+c", "(?:x|yz){2,3}", "[0-4]{3,}", "b?c+"]
    rng = random.Random(9)
    data = "".join(rng.choices("abcxyz0123é", weights=[3] * 3 + [2] * 8, k=3000)).encode()
    data = np.frombuffer(data + bytes([automaton.RESET]), np.uint8)
    back = automaton.compile_rules(patterns, anywhere=True, backwards=True)
    begins = back.scan(data[::-1])[::-1]
    ahead = automaton.compile_rules(patterns, anywhere=False)
    first, last = ahead.longest(data, np.arange(len(data)), len(patterns))
    for k, pattern in enumerate(patterns):
        whole = re.compile(pattern.encode())
        for i in range(len(data)):
            near = data[i : i + 40].tobytes()
            ends = [i + j for j in range(1, len(near) + 1) if whole.fullmatch(near, 0, j)]
            assert (begins[i] >> k & 1 == 1) == bool(ends)
            assert (first[k, i], last[k, i]) == ((ends[0], ends[-1]) if ends else (-1, -1))


def test_starts_are_taken_in_blocks(monkeypatch):
    """Matches across a border of blocks, and runs of a million bytes, in few steps."""
    rng = random.Random(10)
    pieces = ["deadbeef", "0123456789", "token=", "secret:", "AKIA", "ABCD1234", " ", "x", "-", "gh", "p_"]
    text = "".join(rng.choices(pieces, k=4000)) + "token=" + "a" * 1_000_000 + " "
    data = np.frombuffer(text.encode() + bytes([automaton.RESET]), np.uint8)
    bits = np.full(len(data), 63, np.uint8)
    whole = sorted(secrets.spans_in(data, bits, secrets.automata()))
    expected = sorted((a, k, b) for a, k, b in base_spans(text))
    assert [x for x in whole if x[1] < secrets.BASE] == expected
    monkeypatch.setattr(secrets, "STARTS", 997)
    short = np.append(data[: len(text) - 1_000_000], data[-1])
    a = sorted(secrets.spans_in(short, bits[: len(short)], secrets.automata()))
    monkeypatch.setattr(secrets, "STARTS", 1 << 30)
    assert a == sorted(secrets.spans_in(short, bits[: len(short)], secrets.automata()))


def held_out(spark, query, label):
    found = query(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    return found, [tuple(r) for r in found.join(labels, "doc_id").select("held_out", label, "predicted").collect()]


def test_toxicity(spark):
    found, rows = held_out(spark, toxicity.op2_toxicity, "toxic")
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    own = [(a, b) for h, a, b in rows if h]
    assert sum(a == b for a, b in own) >= 0.94 * len(own)
    assert all(h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found.collect() for h in [r.held_out])


def test_quality_model(spark):
    found, rows = held_out(spark, quality_model.op5_quality_classifier, "quality")
    own = [(a, b) for h, a, b in rows if h]
    assert sum(a == b for a, b in own) >= 0.95 * len(own)
    assert found.where("score < 0 OR score > 1 OR predicted <> CAST(score >= 0.7 AS INT)").count() == 0


def test_language(spark):
    found = language.op7_language_id(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = [tuple(r) for r in found.join(docs, "doc_id").where("held_out").select("lang", "lang_pred").collect()]
    assert sum(a == b for a, b in rows) >= 0.97 * len(rows)


def test_models_bear_every_text(spark, docs, rows, nothing):
    labels = spark.createDataFrame(
        [(r[0], i % 2, (i + 1) % 2) for i, r in enumerate(rows)] + [(None, 1, 1), (5, None, None), (10**9, 1, 0)],
        "doc_id bigint, quality int, toxic int",
    )
    for module in (toxicity, quality_model):
        for own in (labels, labels.limit(0)):
            model = module.train(docs, own)
            found = module.scored(docs, model).collect()
            assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
            assert module.scored(nothing, model).count() == 0
    network = language.train(docs)
    found = language.identified(docs, network).collect()
    assert len(found) == len(rows) and {r.lang_pred for r in found} == {"en", "und"}
    und = {r.doc_id for r in found if r.lang_pred == "und"}
    assert und == {r[0] for r in rows if not any(map(str.isalpha, r[1] or ""))}
    assert language.identified(nothing, language.train(nothing)).count() == 0


def test_gradients_of_the_network():
    random_ = np.random.default_rng(0)
    network = language.Network(["a", "b", "c"], 3)
    ids = random_.integers(0, 256, (5, 4))
    real = np.ones((5, 4), np.float32)
    real[3:, 1] = 0
    target = np.array([0, 1, 2, 1])

    def loss():
        one, two = network.states(0, ids, real), network.states(1, ids, real)
        total = 0.0
        for t in range(5):
            p = np.exp(network.v[:, :3] @ one[t] + network.v[:, 3:] @ two[t] + network.c)
            total -= (np.log(p[target, np.arange(4)] / p.sum(axis=0)) * real[t]).sum()
        return total / real.sum()

    for w, g in zip(network.weights(), network.slopes(ids, real, target)):
        for at in np.argwhere(np.abs(g) > 0.5 * np.abs(g).max())[:3]:
            at = tuple(at)
            before = w[at]
            w[at] = before + 0.02
            up = loss()
            w[at] = before - 0.02
            down = loss()
            w[at] = before
            assert abs((up - down) / 0.04 - g[at]) < 0.05 * np.abs(g).max() + 1e-4


@pytest.mark.parametrize("table", [False, True])
def test_pipeline(spark, docs, rows, tmp_path, table):
    """Every stage works on what the one before kept; decisions are those of the operators."""
    import corpus_pipeline
    from tablework.llm.shared import written
    from tests.llm.conftest import SCHEMA, item_texts

    own = rows if table else []
    spark.createDataFrame(own, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    items = spark.createDataFrame(list(enumerate(item_texts())), "item_id bigint, text string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    stages = [name for name, _ in corpus_pipeline.STAGES]
    assert len(stages) == 5
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = [now.count()]
    for name, stage in corpus_pipeline.STAGES:
        columns = now.columns
        now = written(stage(spark, now, str(tmp_path)), "stage")
        if name != stages[-1]:
            assert now.columns == columns
            kept.append(now.count())
    assert kept == sorted(kept, reverse=True)
    pieces = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(tuple, pieces.select("doc_id", "piece", "ids_crc32").fillna(-1).collect())) == sorted(
        map(tuple, now.select("doc_id", "piece", "ids_crc32").fillna(-1).collect())
    )
    if table:
        assert kept[0] > kept[1] and kept[2] > kept[3] > kept[4] > 0


def test_the_last_chunk_is_judged(spark):
    rng = random.Random(41)
    prose = " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(900))
    noise = "".join(rng.choices([chr(c) for c in range(33, 127)], k=3800))
    noise = " ".join(noise[i : i + 7] for i in range(0, len(noise), 7))
    rows = enumerate([prose[:4200] + " " + noise, prose[:8000], prose[:4200], noise])
    found = quality_rules.rule_results(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.kept for r in found} == {0: False, 1: True, 2: True, 3: False}


def test_a_rare_language_is_learnt(spark):
    """Eight labelled rows of 8,008, some of them held out."""
    rng = random.Random(42)
    sounds = {"aa": "the of and in to is was he".split(), "bb": "ka ko ku ki mo ne ru shi".split(), "zz": "xq zv qx vz qz zx".split()}

    def words(lang):
        return " ".join("".join(rng.choices(sounds[lang], k=2)) for _ in range(60))

    rows = [(i, words("aa" if i % 2 else "bb"), "aa" if i % 2 else "bb") for i in range(8000)]
    rows += [(8000 + i, words("zz"), "zz") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    network = language.train(docs, rows=600)
    assert network.languages == ["aa", "bb", "zz"]
    tests = [(i, words(lang)) for i, lang in enumerate(["zz"] * 20 + ["aa"] * 20)]
    found = language.identified(spark.createDataFrame(tests, "doc_id bigint, text string"), network).collect()
    assert sum(r.lang_pred == ("zz" if r.doc_id < 20 else "aa") for r in found) >= 38
