"""What a Python worker holds while it works: it keeps most of it between tasks."""

import os
import random
import subprocess
import sys
import tracemalloc

import pyarrow as pa
import pytest

import corpus_pipeline
from tablework.llm import jaccard_join, quality_rules, token_ids
from tablework.llm import words as W
from tablework.llm.shared import ARROW_ROWS, TEXTS_PER_BATCH
from tests.llm.conftest import sentence


@pytest.fixture(scope="module")
def batch():
    rng = random.Random(5)
    texts = [sentence(rng, 250) for _ in range(3000)]
    ids = pa.array(range(len(texts)), pa.int64())
    return pa.RecordBatch.from_arrays([ids, pa.array(texts)], ["doc_id", "text"])


@pytest.mark.parametrize(
    "step", [quality_rules._rules, jaccard_join._classes, jaccard_join._token_counts(7)]
)
def test_arrays_for_a_batch_are_bounded(batch, step, monkeypatch):
    assert batch.nbytes > 4 << 20
    monkeypatch.setattr(W, "_powers", {})
    tracemalloc.start()
    try:
        for _ in step(iter([batch])):
            pass
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 24 << 20


def test_token_ids_start_no_threads():
    code = (
        "import os, pyarrow as pa, public_tokenizers\n"
        "from tablework.llm.token_ids import token_ids\n"
        "from tablework.llm.words import parts\n"
        "threads = lambda: len(os.listdir('/proc/self/task'))\n"
        "store = token_ids(public_tokenizers.path('word_bpe_49k.json'))\n"
        "(part,) = parts(pa.array([' '.join(f'word{chr(97 + i % 26)}{chr(97 + i // 26)} {i}x' for i in range(600))]))\n"
        "before = threads()\n"
        "store.of(part)\n"
        "print(threads() - before)\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"}
    env["PYTHONPATH"] = os.pathsep.join(sys.path)
    made = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=100)
    assert made.stdout.strip() == "0", made.stderr
    assert 4 * token_ids.POOL_IDS <= 8 << 20


def test_the_pipeline_bounds_batches_of_its_first_stage_too(spark, docs, monkeypatch):
    before = spark.conf.get(ARROW_ROWS)
    try:
        spark.conf.set(ARROW_ROWS, "10000")
        corpus_pipeline.quality(spark, docs, "")
        assert int(spark.conf.get(ARROW_ROWS)) == TEXTS_PER_BATCH
        spark.conf.set(ARROW_ROWS, "5000")
        monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[:1])
        monkeypatch.setattr(corpus_pipeline, "documents", lambda *_: docs)
        corpus_pipeline.run(spark, "")
        assert spark.conf.get(ARROW_ROWS) == "5000"
    finally:
        spark.conf.set(ARROW_ROWS, before)
