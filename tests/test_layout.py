import pytest
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tablework.operators.layout import (
    SALT,
    bucket_count,
    cached,
    cached_table,
    write_bucketed,
    write_bucketed_pair,
)
from tablework.plans.explain import plan_text
from tablework.sinks import write_external_table, write_managed_table, write_parquet
from tablework.storage import create_database, fresh_name, fresh_path, run_database, shared_root


def bucketed(spark, orders, users, **options):
    database = run_database(spark)
    names = [f"{database}.{fresh_name(n)}" for n in ("orders", "users")]
    return write_bucketed_pair(orders, users, "user", "uid", *names, **options)


def test_bucketed_join_has_no_shuffle(spark):
    orders = spark.range(1000).select("id", (F.col("id") % 100).alias("user"))
    users = spark.range(100).select(F.col("id").alias("uid"), F.lit("CA").alias("state"))
    pair = bucketed(spark, orders, users)
    joined = pair.join()
    plan = plan_text(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.columns == ["id", "user", "uid", "state"]
    assert joined.count() == 1000


def test_a_hot_key_is_spread_over_buckets(spark):
    """A third of the rows under one key, another tenth under NULL."""
    user = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 != 1, F.col("id") % 50)
    orders = spark.range(6000).select("id", user.alias("user"))
    users = spark.range(50).select(F.col("id").alias("uid"))
    pair = bucketed(spark, orders, users, buckets=8)
    expected = sorted(r.id for r in orders.where("user IS NOT NULL").collect())
    assert sorted(r.id for r in pair.join().collect()) == expected
    sizes = pair.large.groupBy("user", SALT).count()
    assert sizes.agg(F.max("count")).first()[0] < 6000 / 8
    assert pair.large.where("user = 7").select(SALT).distinct().count() >= 5
    assert pair.large.where("user IS NULL").select(SALT).distinct().count() == 8
    assert pair.small.where("uid <> 7").count() == 49


def test_bucket_count_follows_the_rows():
    assert [bucket_count(n) for n in (0, 10**9, 10**14)] == [8, 63, 6_250_000]


def test_cache_is_filled_once_and_released(spark):
    df = spark.range(100).withColumn("square", F.col("id") * F.col("id"))
    with cached(df, StorageLevel.DISK_ONLY) as kept:
        assert kept.storageLevel.useDisk and not kept.storageLevel.useMemory
        assert kept.count() == kept.count() == 100
        assert "InMemoryTableScan" in plan_text(kept)
    assert "InMemoryTableScan" not in plan_text(df.select("square"))
    with pytest.raises(RuntimeError), cached(df):
        raise RuntimeError("released even so")
    assert not df.is_cached


@pytest.mark.parametrize("lazy", [False, True])
def test_cached_table(spark, lazy):
    spark.range(10).createOrReplaceTempView("ten")
    with cached_table(spark, "ten", lazy) as kept:
        assert spark.catalog.isCached("ten")
        assert kept.count() == 10
    assert not spark.catalog.isCached("ten")


@pytest.mark.parametrize(
    "spread",
    [
        lambda df: df.repartition(1),
        lambda df: df.repartition(7),
        lambda df: df.repartitionByRange(5, "k", "id"),
        lambda df: df.coalesce(2),
    ],
)
def test_partitions_do_not_change_results(spark, spread):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("k"))
    by_key = df.groupBy("k").agg(F.sum("id").alias("s"))
    assert spread(df).groupBy("k").agg(F.sum("id").alias("s")).exceptAll(by_key).isEmpty()


def test_managed_and_external_tables(spark):
    name = f"{run_database(spark)}.{fresh_name('t')}"
    assert write_managed_table(spark.range(3), name).count() == 3
    with pytest.raises(AnalysisException):
        write_managed_table(spark.range(3), name)
    assert write_managed_table(spark.range(4), name, mode="overwrite").count() == 4
    path = fresh_path(spark, "external")
    outside = f"{run_database(spark)}.{fresh_name('t')}"
    write_external_table(spark.range(5), outside, path)
    spark.sql(f"DROP TABLE {outside}")
    assert spark.read.parquet(path).count() == 5


def test_database_can_be_created_twice(spark):
    name = fresh_name("db")
    create_database(spark, name)
    create_database(spark, name)
    assert spark.catalog.databaseExists(name)
    assert spark.catalog.currentDatabase() == "default"
    spark.sql(f"DROP DATABASE `{name}`")


@pytest.mark.parametrize("codec", ["snappy", "zstd"])
def test_codec(spark, tmp_path, codec):
    write_parquet(spark.range(3).coalesce(1), str(tmp_path / "t"), compression=codec)
    assert list((tmp_path / "t").glob(f"*.{codec}.parquet"))


def test_global_view_is_seen_by_other_sessions(spark):
    spark.range(6).createOrReplaceGlobalTempView("six")
    assert spark.newSession().table("global_temp.six").count() == 6


def test_shared_folder_is_the_one_the_cluster_names(monkeypatch, tmp_path):
    class Session:
        """As much of a session as the folder is chosen by."""

        def __init__(self, folder, master):
            self.conf = {"spark.checkpoint.dir": folder}
            self.sparkContext = self
            self.applicationId = folder or master
            self.master = master

        def getCheckpointDir(self):
            return None

    monkeypatch.setattr("tablework.storage._delete_at_exit", lambda spark, path: None)
    on_cluster = shared_root(Session("hdfs://shared/dir/", "yarn"))
    assert on_cluster.startswith("hdfs://shared/dir/tablework-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(Session(None, "yarn"))
    monkeypatch.setattr("tempfile.mkdtemp", lambda prefix: str(tmp_path))
    assert shared_root(Session(None, "local[4]")).startswith(f"{tmp_path}/")


@pytest.mark.parametrize("hot", ["large", "small", "both", "null"])
def test_hot_keys_are_spread_whatever_their_rows_hold(spark, hot):
    database = run_database(spark)
    n = 2000
    one = spark.range(n).selectExpr("CAST(id AS INT) AS k", "'x' AS v").withColumn("k", F.col("k") % 200)
    two = spark.range(200).selectExpr("CAST(id AS INT) AS k", "'y' AS w")
    same = spark.range(n).selectExpr("7 AS k", "'same' AS v")
    if hot in ("large", "both"):
        one = one.union(same)
    if hot in ("small", "both"):
        two = two.union(same.limit(n if hot == "small" else 100))
    if hot == "null":
        nulls = spark.range(n).selectExpr("CAST(NULL AS INT) AS k", "'n' AS v")
        one, two = one.union(nulls), two.union(nulls)
    names = [f"{database}.{fresh_name(x)}" for x in ("a", "b")]
    pair = write_bucketed_pair(one, two, "k", "k", *names, buckets=8, heavy_rows=300)
    expected_rows = one.join(two, "k").count()
    assert pair.join().count() == expected_rows
    for table in (pair.large, pair.small):
        most = table.groupBy("k", "bucket_salt").count().agg(F.max("count")).first()[0]
        assert most <= 600


def test_rows_that_come_in_another_order_after_a_retry_are_dealt_alike(spark):
    """The rows of heavy keys come from a shuffle, whose order may differ when a task runs again. What
    decides their salts is read from files, so the plan of a bucketed write holds no row number of
    the shuffle."""
    rows = spark.range(3000).selectExpr("id", "IF(id % 3 = 0, 7, id % 50) AS user").repartition(5)
    users = spark.range(50).selectExpr("id AS uid")
    pair = bucketed(spark, rows, users, buckets=8)
    one = sorted(map(tuple, pair.large.collect()))
    assert len(one) == len({r[0] for r in one}) == 3000
    again = bucketed(spark, rows, users, buckets=8)
    assert pair.join().count() == again.join().count() == 3000


def test_more_limits_than_the_sketch_can_tell(spark, monkeypatch):
    """Where a heavy key is too small a share for the sketch, all keys are counted."""
    monkeypatch.setattr("tablework.operators.layout.SKETCH_KEYS", 64)
    monkeypatch.setattr("tablework.operators.layout.NAMED_KEYS", 32)
    rows = spark.range(4000).selectExpr("id", "IF(id % 4 = 0, 7, id % 500) AS user")
    pair = bucketed(spark, rows, spark.range(500).selectExpr("id AS uid"), buckets=8, heavy_rows=100)
    assert pair.large.where("user = 7").select(SALT).distinct().count() >= 9
    assert pair.join().count() == 4000


def test_a_bucket_with_a_hot_key_is_written_by_several_tasks(spark):
    rows = spark.range(200_000).selectExpr("id", "7 AS user", "sha2(CAST(id AS STRING), 256) AS text")
    name = f"{run_database(spark)}.{fresh_name('hot')}"
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",)}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        table = write_bucketed(rows.repartition(4), name, 8, "user")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(table.inputFiles()) > 1 and table.count() == 200_000
