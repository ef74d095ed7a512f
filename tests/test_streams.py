import json
import shutil

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from tablework.functions.text import whitespace_split
from tablework.operators import evolving
from tablework.streaming.flow import LandingFlow, gate, gated
from tablework.streaming.runner import run_available, run_every, stream_session
from tablework.streaming.running import running_totals
from tablework.streaming.sinks import (
    MERGE_EVERY,
    _version_writer,
    append_files,
    latest_complete,
    latest_update,
    publish_base,
    publish_running,
)
from tablework.streaming.sources import json_stream, parquet_stream, text_stream

ORDERS = (
    StructType().add("id", IntegerType()).add("name", StringType()).add("quantity", IntegerType())
)
LIMIT = 180


@pytest.fixture(scope="module")
def streams(spark):
    return stream_session(spark, state_partitions=2)


def drop(folder, name, rows, array=False):
    folder.mkdir(exist_ok=True)
    text = json.dumps(rows, indent=1) if array else "\n".join(map(json.dumps, rows))
    (folder / name).write_text(text)


def order(name, quantity=1, i=1):
    return {"id": i, "name": name, "quantity": quantity}


def names(df):
    return {r["name"]: r["count"] for r in df.collect()}


@pytest.mark.parametrize("files_per_batch", [None, 1])
def test_two_streams_in_a_row(spark, streams, tmp_path, files_per_batch):
    """Arrays land, counts follow; what comes later is added to both, however it is cut."""
    inbox = tmp_path / "inbox"
    drop(inbox, "a.json", [order("Pizza", 3), order("Pizza", 5)], array=True)
    flow = LandingFlow(
        ORDERS, lambda df: df.groupBy("name").count(), str(inbox), str(tmp_path / "home"),
        arrays=True, files_per_batch=files_per_batch,
    )
    flow.run(streams, LIMIT)
    assert names(latest_complete(spark, flow.result)) == {"Pizza": 2}
    drop(inbox, "b.json", [order("Pasta")], array=True)
    drop(inbox, "c.json", [order("Pizza")], array=True)
    flow.run(streams, LIMIT)
    flow.run(streams, LIMIT)
    assert spark.read.parquet(flow.landing).count() == 4
    assert names(latest_complete(spark, flow.result)) == {"Pizza": 3, "Pasta": 1}


def test_two_streams_side_by_side(spark, streams, tmp_path):
    inbox = tmp_path / "inbox"
    flow = LandingFlow(
        ORDERS, lambda df: df.groupBy("name").count(), str(inbox), str(tmp_path / "home")
    )
    inbox.mkdir()
    flow.run(streams, LIMIT)  # nothing has arrived yet
    drop(inbox, "a.json", [order("Pizza"), order("Pizza")])
    queries = flow.start(streams)
    try:
        assert [q.name for q in queries] == ["land", "publish"]
        drop(inbox, "b.json", [order("Pasta")])
        for q in queries:
            q.processAllAvailable()
        assert all(q.isActive for q in queries)
    finally:
        for q in queries:
            q.stop()
    assert names(latest_complete(spark, flow.result)) == {"Pizza": 2, "Pasta": 1}


def test_hand_over_between_two_streams(spark, streams, tmp_path):
    """Three deliveries, cut into batches of one file: the second stream ends with all rows read."""
    inbox = tmp_path / "inbox"
    flow = LandingFlow(
        ORDERS, lambda df: df.groupBy("name").count(), str(inbox), str(tmp_path / "home"),
        files_per_batch=1,
    )
    inbox.mkdir()
    flow.run_together(streams, LIMIT)  # nothing has arrived yet
    for i in range(1, 4):
        for j in range(3):
            drop(inbox, f"{i}{j}.json", [order("Pizza"), order("Pasta")])
        flow.run_together(streams, LIMIT)
        assert names(latest_complete(spark, flow.result)) == {"Pizza": 3 * i, "Pasta": 3 * i}
    assert not streams.streams.active


def test_a_failed_first_stream_is_raised_by_the_hand_over(spark, streams, tmp_path):
    inbox = tmp_path / "inbox"
    drop(inbox, "a.json", [order("Pizza")])
    broken = F.udf(lambda n: 1 // 0, "string")
    flow = LandingFlow(
        ORDERS, lambda df: df.groupBy(broken("name").alias("name")).count(), str(inbox),
        str(tmp_path / "home"),
    )
    with pytest.raises(StreamingQueryException):
        flow.run_together(streams, LIMIT)
    assert not streams.streams.active


KEYED = "id int, name string, quantity long"


def _totals(df):
    return {(r.name, r.id): (r.n, r.quantity) for r in df.collect()}


def test_running_totals_go_on_from_a_batch(spark, tmp_path):
    """Starts from a batch result, survives a restart and a batch that runs again; null keys and
    null amounts."""
    streams = stream_session(spark, many_keys=True, state_partitions=2)
    inbox, path, checkpoint = tmp_path / "in", str(tmp_path / "r"), tmp_path / "c"
    before = [("Pizza", 1, 2, 7), ("Pizza", 1, 1, 3), ("Soup", 1, 1, 1), (None, None, 1, 1)]
    start = spark.createDataFrame(before, "name string, id int, n long, quantity long")
    keys = ["name", "id"]
    start = start.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("quantity").alias("quantity"))
    publish_base(start, path)

    def load():
        rows = json_stream(streams, str(inbox), KEYED, files_per_batch=1)
        totals = {"n": F.lit(1), "quantity": F.col("quantity")}
        running = running_totals(rows, keys, totals, streams.read.parquet(f"{path}/result_base=-1"))
        run_available(publish_running(running, path, str(checkpoint), "update", keys=keys), LIMIT)
        return _totals(latest_update(spark, path, keys))

    big = 2**53 + 1  # no float in between
    drop(inbox, "a.json", [order("Pizza", 5), order("Pizza", None), order("Pasta", big)])
    drop(inbox, "b.json", [order(None, 4, None), order("Pizza", 2, 2)])
    expected = {
        ("Pizza", 1): (5, 15), ("Soup", 1): (1, 1), (None, None): (2, 5),
        ("Pasta", 1): (1, big), ("Pizza", 2): (1, 2),
    }
    assert load() == expected
    (checkpoint / "commits" / "1").unlink()
    (checkpoint / "commits" / ".1.crc").unlink(missing_ok=True)
    assert load() == expected
    drop(inbox, "c.json", [order("Soup", 9)])
    assert load() == expected | {("Soup", 1): (2, 10)}


def test_running_totals_forget(spark, tmp_path):
    """A key that was not seen for the given time starts from nothing."""
    streams = stream_session(spark, many_keys=True, state_partitions=2, idle_batches=False)
    inbox, path, checkpoint = tmp_path / "in", str(tmp_path / "r"), str(tmp_path / "c")

    def load(forget):
        rows = json_stream(streams, str(inbox), KEYED)
        running = running_totals(rows, ["name"], {"n": F.lit(1)}, forget_after_ms=forget)
        run_available(publish_running(running, path, checkpoint, "update", keys=["name"]), LIMIT)
        return {r.name: r.n for r in latest_update(spark, path, ["name"]).collect()}

    drop(inbox, "a.json", [order("Pizza"), order("Pizza")])
    assert load(1) == {"Pizza": 2}
    drop(inbox, "b.json", [order("Pizza")])
    assert load(1) == {"Pizza": 1}


def test_totals_are_combined_before_the_shuffle(spark, tmp_path):
    """One hot key of many rows leaves a task as one row; many keys leave in bounded lots."""
    import pyarrow as pa

    from tablework.streaming import running

    combine = running._combiner(["k"], ["n"])
    never_null = pa.schema([pa.field("k", pa.string(), False), pa.field("n", pa.int64(), False)])
    hot = [pa.record_batch([["x"] * 10_000, [1] * 10_000], never_null) for _ in range(50)]
    assert pa.Table.from_batches(combine(iter(hot))).to_pylist() == [{"k": "x", "n": 500_000}]
    many = [pa.record_batch({"k": range(i, i + 10_000), "n": [1] * 10_000}) for i in range(0, 400_000, 10_000)]
    out = list(combine(iter(many)))
    assert sum(b.num_rows for b in out) == 400_000 and len(out) > 1
    assert list(combine(iter([]))) == []


def test_a_batch_that_runs_again_lands_once(spark, streams, tmp_path):
    """As if the driver was lost between writing a batch and committing it."""
    inbox, path, checkpoint = tmp_path / "in", str(tmp_path / "t"), tmp_path / "c"
    drop(inbox, "a.json", [order("Pizza"), order("Pasta")])

    def land():
        stream = json_stream(streams, str(inbox), ORDERS)
        run_available(append_files(stream, path, str(checkpoint)), LIMIT)

    land()
    (checkpoint / "commits" / "0").unlink()
    shutil.rmtree(checkpoint / "commits")
    land()
    assert spark.read.parquet(path).count() == 2
    counts = parquet_stream(streams, path, ORDERS).groupBy("name").count()
    run_available(publish_running(counts, str(tmp_path / "r"), str(tmp_path / "c2")), LIMIT)
    assert names(latest_complete(spark, str(tmp_path / "r"))) == {"Pizza": 1, "Pasta": 1}


def test_batch_and_stream_share_a_table(spark, streams, tmp_path):
    inbox, path, checkpoint = tmp_path / "in", str(tmp_path / "t"), tmp_path / "c"
    evolving.load_once(spark.createDataFrame([(1, "Soup", 1)], ORDERS), path, "history")
    drop(inbox, "a.json", [order("Pizza"), order("Pasta")])

    def load():
        stream = json_stream(streams, str(inbox), ORDERS)
        writer = stream.writeStream.option("checkpointLocation", str(checkpoint))
        run_available(writer.foreachBatch(evolving.stream_loader(path, "stream")), LIMIT)

    load()
    shutil.rmtree(checkpoint / "commits")
    load()
    loaded = evolving.loaded(spark, path).collect()
    assert sorted(r.name for r in loaded) == ["Pasta", "Pizza", "Soup"]


@pytest.mark.parametrize("mode, many_keys", [("complete", False), ("update", True)])
def test_word_counts(spark, tmp_path, mode, many_keys):
    """Without explode the key is the whole list of words, with it each word."""
    streams = stream_session(spark, many_keys, state_partitions=2)
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "1.txt").write_text("a b\na b\n")
    (inbox / "2.txt").write_text("b c\n")
    lines = text_stream(streams, str(inbox), files_per_batch=1)
    lists = lines.groupBy(whitespace_split("value").alias("word")).count()
    words = lines.select(F.explode(whitespace_split("value")).alias("word")).groupBy("word").count()
    results = []
    for i, counts in enumerate((lists, words)):
        path = str(tmp_path / f"r{i}")
        run_available(publish_running(counts, path, str(tmp_path / f"c{i}"), mode, keys=["word"]), LIMIT)
        if mode == "complete":
            newest = latest_complete(spark, path)
        else:
            newest = latest_update(spark, path, ["word"])
        results.append({str(r.word): r["count"] for r in newest.collect()})
    assert results == [{"['a', 'b']": 2, "['b', 'c']": 1}, {"a": 2, "b": 3, "c": 1}]


@pytest.mark.parametrize("keys", [None, ["word"]])
def test_versions_do_not_pile_up(spark, tmp_path, keys):
    """What is stored and read stays the same however many batches there were."""
    path, n = str(tmp_path / "r"), 24
    write = _version_writer(path, keys)
    for i in range(n):
        words = spark.createDataFrame([(f"w{i % 3}", i)], "word string, n int").coalesce(1)
        write(words, i)
    write(words, n - 1)
    if keys is None:
        assert [tuple(r) for r in latest_complete(spark, path).collect()] == [(f"w{(n - 1) % 3}", n - 1)]
        assert len(list((tmp_path / "r").iterdir())) == 2
    else:
        newest = {r.word: r.n for r in latest_update(spark, path, keys).collect()}
        assert newest == {"w0": 21, "w1": 22, "w2": 23}
        assert len(list((tmp_path / "r").iterdir())) <= 2 * MERGE_EVERY + 2


def test_gate(spark, streams, tmp_path):
    inbox, path = tmp_path / "in", str(tmp_path / "t")
    drop(inbox, "a.json", [order("Pizza", 3), order("Pasta", 0), order("Soup", None)])
    stream = json_stream(streams, str(inbox), ORDERS)
    run_available(gate(stream, F.col("quantity") > 0, path, str(tmp_path / "c")), LIMIT)
    assert [r.name for r in gated(spark, path, True).collect()] == ["Pizza"]
    assert sorted(r.name for r in gated(spark, path, False).collect()) == ["Pasta", "Soup"]
    assert gated(spark, path, True).columns == ORDERS.fieldNames()


@pytest.mark.parametrize("interval", ["1 second", None])
def test_stream_that_keeps_running(spark, streams, tmp_path, interval):
    inbox, path = tmp_path / "in", str(tmp_path / "t")
    drop(inbox, "a.json", [order("Pizza")])
    stream = json_stream(streams, str(inbox), ORDERS)
    query = run_every(append_files(stream, path, str(tmp_path / "c"), "keeps_running"), interval)
    try:
        query.processAllAvailable()
        drop(inbox, "b.json", [order("Pasta")])
        query.processAllAvailable()
        assert query.isActive and query.name == "keeps_running"
    finally:
        query.stop()
    assert spark.read.parquet(path).count() == 2


def test_a_stream_over_its_time_is_stopped(streams, tmp_path):
    inbox = tmp_path / "in"
    drop(inbox, "a.json", [order("Pizza")])
    slow = F.udf(lambda n: __import__("time").sleep(20) or n)
    stream = json_stream(streams, str(inbox), ORDERS).select(slow("name").alias("name"))
    writer = append_files(stream, str(tmp_path / "t"), str(tmp_path / "c"), "slow")
    with pytest.raises(TimeoutError, match="slow"):
        run_available(writer, 1)


def test_state_of_many_keys_is_kept_off_the_heap(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    assert "RocksDB" in stream_session(spark, many_keys=True).conf.get(key)
    assert "RocksDB" not in stream_session(spark).conf.get(key)


def test_stream_settings_stay_in_their_session(spark, streams):
    assert streams.conf.get("spark.sql.shuffle.partitions") == "2"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
