"""Results do not depend on how the input tables are cut into files and partitions."""

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.oracle import TABLES, connect, rows

SF_DIR = "/root/testdata/sf0.001"
NAMES = [
    "array_exists_reduce",
    "bucketed_join",
    "case_banding_sql",
    "cogroup_greedy_dedup",
    "cogroup_python_dedup",
    "explode_collect",
    "global_agg",
    "json_array_linemode_clean",
    "multi_key_topk",
    "pivot_two_aggs",
    "sort_desc_limit",
    "stream_group_count",
    "stream_word_count",
    "top3_dense_rank",
    "union_all_refilter",
]


@pytest.fixture(scope="module")
def scattered(spark, tmp_path_factory):
    """The tables as folders of seven files, rows dealt out in turn."""
    root = tmp_path_factory.mktemp("tables")
    for name in TABLES:
        table = spark.read.parquet(f"{SF_DIR}/{name}.parquet")
        table.repartition(7).write.parquet(f"{root}/{name}.parquet")
    return str(root)


@pytest.mark.parametrize("name", NAMES)
def test_scattered_tables_give_the_same_rows(spark, scattered, name):
    expected = rows(connect(SF_DIR).execute(oracle_sql()[name]).df())
    assert rows(queries()[name](spark, scattered).toPandas()) == expected
