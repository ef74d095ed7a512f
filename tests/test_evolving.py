import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tablework.operators import evolving

LOANS = "loan_id bigint, funded float, paid float, state string, closed boolean"
ROWS = [(111111, 1000.0, 1000.0, "TX", False), (22222, 2000.0, 0.0, "CA", True)]


@pytest.fixture
def loans(spark, tmp_path):
    df = spark.createDataFrame(ROWS, LOANS)
    path = str(tmp_path / "loans")
    evolving.create_table(df, path)
    return df, path


def test_create_refuses_an_existing_table(loans):
    df, path = loans
    with pytest.raises(AnalysisException):
        evolving.create_table(df, path)


def test_enforced_append(spark, loans):
    df, path = loans
    evolving.append_enforced(df, path)
    assert evolving.current(spark, path).count() == 4
    with pytest.raises(evolving.SchemaMismatch, match="new_amount"):
        evolving.append_enforced(df.withColumn("new_amount", F.col("funded")), path)
    with pytest.raises(evolving.SchemaMismatch, match="float -> double"):
        evolving.append_enforced(df.withColumn("paid", F.col("paid").cast("double")), path)
    assert evolving.current(spark, path).count() == 4
    evolving.append_enforced(df.drop("state"), path)
    assert evolving.current(spark, path).where("state IS NULL").count() == 2


def test_evolving_append(spark, loans):
    df, path = loans
    evolving.append_evolving(df.withColumn("new_amount", F.col("funded")), path)
    table = evolving.current(spark, path)
    assert table.columns == [*df.columns, "new_amount"]
    assert table.count() == 4 and table.where("new_amount IS NULL").count() == 2
    with pytest.raises(evolving.SchemaMismatch):
        evolving.append_evolving(df.withColumn("closed", F.lit("no")), path)
    # Once the column is there, the enforced append takes it.
    evolving.append_enforced(df.withColumn("new_amount", F.col("funded")), path)
    assert evolving.current(spark, path).count() == 6


def test_a_load_that_runs_again_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame(ROWS, LOANS)
    evolving.load_once(df, path, "history")
    write = evolving.stream_loader(path, "stream")
    for batch_id in (0, 0, 1):
        write(df, batch_id)
    table = evolving.loaded(spark, path)
    assert table.columns == df.columns and table.count() == 6


def test_rows_of_a_table_fit_it_whatever_may_be_null_in_them(spark, tmp_path):
    path = str(tmp_path / "nested")
    df = spark.sql(
        "SELECT array('a') AS tags, map('k', 1) AS m, struct(1 AS x, array(1) AS ys) AS s"
    )
    evolving.create_table(df, path)
    evolving.append_enforced(df, path)
    evolving.append_evolving(df, path)
    assert evolving.current(spark, path).count() == 3
    for unfit in ("array(1) AS tags", "map('k', 'v') AS m", "struct(1 AS x, array('a') AS ys) AS s"):
        with pytest.raises(evolving.SchemaMismatch):
            evolving.append_enforced(spark.sql(f"SELECT {unfit}"), path)


def test_names_in_another_case_are_the_same_column(spark, tmp_path):
    path = str(tmp_path / "t")
    evolving.create_table(spark.sql("SELECT 1L AS id"), path)
    evolving.append_evolving(spark.sql("SELECT 2L AS ID"), path)
    assert sorted(r.id for r in evolving.current(spark, path).collect()) == [1, 2]
    with pytest.raises(evolving.SchemaMismatch):
        evolving.append_enforced(spark.sql("SELECT 'x' AS ID"), path)


def test_unfit_loads_are_refused_and_the_table_still_reads(spark, tmp_path):
    path = str(tmp_path / "t")
    evolving.load_once(spark.sql("SELECT 1L AS n"), path, "history")
    for unfit in ("SELECT 'x' AS n", "SELECT 1L AS n, 2 AS more"):
        with pytest.raises(evolving.SchemaMismatch):
            evolving.stream_loader(path, "stream")(spark.sql(unfit), 0)
    assert evolving.loaded(spark, path).count() == 1


def nested(spark, rows, inner):
    return spark.createDataFrame(rows, f"id int, s struct<{inner}>, l array<struct<{inner}>>, m map<string,struct<{inner}>>")


def nested_row(i, *values):
    return (i, values, [values], {"k": values})


def test_new_fields_inside_structs_arrays_and_maps(spark, tmp_path):
    path = str(tmp_path / "t")
    evolving.create_table(nested(spark, [nested_row(1, 10)], "x int"), path)
    evolving.append_evolving(nested(spark, [nested_row(2, "new", 20), (3, None, None, None)], "Y string, X int"), path)
    evolving.append_evolving(nested(spark, [nested_row(4, 40)], "x int"), path)
    rows = {r.id: r for r in evolving.current(spark, path).collect()}
    for i, x, y in ((1, 10, None), (2, 20, "new"), (4, 40, None)):
        for one in (rows[i].s, rows[i].l[0], rows[i].m["k"]):
            assert (one.x, one.Y) == (x, y)
    assert rows[3].s is None and rows[3].l is None


@pytest.mark.parametrize(
    ("inner", "row"), [("x string", ("1",)), ("x struct<y:int>", ((1,),)), ("x int, X int", (1, 2))]
)
def test_changed_inner_types_are_refused(spark, tmp_path, inner, row):
    path = str(tmp_path / "t")
    evolving.create_table(nested(spark, [nested_row(1, 10)], "x int"), path)
    with pytest.raises(evolving.SchemaMismatch):
        evolving.append_evolving(nested(spark, [nested_row(2, *row)], inner), path)
    assert evolving.current(spark, path).count() == 1


def test_new_inner_fields_are_refused_where_the_schema_is_enforced(spark, tmp_path):
    path = str(tmp_path / "t")
    evolving.create_table(nested(spark, [nested_row(1, 10, 11)], "x int, y int"), path)
    with pytest.raises(evolving.SchemaMismatch, match="not in the table"):
        evolving.append_enforced(nested(spark, [nested_row(2, 20, 21, 22)], "x int, y int, z int"), path)
    evolving.append_enforced(nested(spark, [nested_row(3, 30)], "Y int"), path)
    row = evolving.current(spark, path).where("id = 3").first()
    assert (row.s.x, row.s.y) == (None, 30)


def test_orders_without_a_date_are_loaded(spark, tmp_path):
    from tablework.plans.evolving_plans import batch_plus_stream_append

    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").limit(5)
    dateless = orders.withColumn("o_orderdate", F.lit(None).cast(orders.schema["o_orderdate"].dataType))
    orders.union(dateless).write.parquet(str(tmp_path / "orders.parquet"))
    assert batch_plus_stream_append(spark, str(tmp_path)).count() == 10
