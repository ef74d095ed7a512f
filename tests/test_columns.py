import pytest
from pyspark.errors import ArithmeticException, NumberFormatException
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from tablework.functions import nested, text, udfs
from tablework.functions.temporal import calendar_part, parsed_timestamp
from tablework.operators.columns import (
    conform,
    delay_band,
    flag_valid,
    not_null,
    recast,
    usage_cost,
)

RECORD = StructType(
    [
        StructField("b", StringType()),
        StructField("a", IntegerType()),
        StructField("c", DoubleType()),
    ]
)


def test_conform_orders_casts_and_checks(spark):
    df = spark.createDataFrame([("1", 2, "3.5", "extra")], ["a", "b", "c", "d"])
    bound = conform(df, RECORD)
    assert bound.dtypes == [("b", "string"), ("a", "int"), ("c", "double")]
    assert tuple(bound.first()) == ("2", 1, 3.5)
    with pytest.raises(ValueError, match="'c'"):
        conform(df.drop("c"), RECORD)


def test_dirty_values_raise_or_become_null(spark):
    df = spark.createDataFrame([("2.95",), ("7",)], ["n"])
    with pytest.raises(NumberFormatException):
        recast(df, {"n": "int"}).collect()
    assert [r.n for r in recast(df, {"n": "int"}, dirty="null").collect()] == [None, 7]
    # Text is cast to double before it is compared, so fractions count.
    doubles = recast(spark.createDataFrame([("5.7",), ("4",)], ["n"]), {"n": "double"})
    assert doubles.where("n > 5").count() == 1


def test_delay_bands(spark):
    delays = [101.0, 100.0, 50.5, 50.0, 10.5, 10.0, 0.5, 0.0, -1.0, None]
    df = spark.createDataFrame([(d,) for d in delays], "delay double")
    bands = [r[0] for r in df.select(delay_band(F.col("delay"))).collect()]
    assert bands == [
        "Very Long Delay", "Long Delay", "Long Delay", "Medium Delay", "Medium Delay",
        "Tolerable Delay", "Tolerable Delay", "No Delay", "Early", "Early",
    ]
    assert not_null(df, ["delay"]).count() == 9


def test_usage_cost(spark):
    df = spark.createDataFrame([(750,), (751,), (None,)], "usage int")
    costs = [r[0] for r in df.select(usage_cost(F.col("usage"))).collect()]
    assert costs[:1] == [375.0] and costs[1] == pytest.approx(112.65) and costs[2] is None


def test_rule_that_is_null_is_not_met(spark):
    orders = spark.createDataFrame([(1,), (0,), (None,)], "quantity int")
    df = flag_valid(orders, F.col("quantity") > 0)
    assert [r.is_valid for r in df.collect()] == [True, False, False]


def test_text_functions(spark):
    df = spark.createDataFrame([("Ann", "Lee", 7, "a b  c")], ["first", "last", "id", "line"])
    row = df.select(
        text.joined("first", "last", "id").alias("key"),
        text.leading("last", 2).alias("head"),
        text.whitespace_split("line").alias("words"),
    ).first()
    assert (row.key, row.head, row.words) == ("AnnLee7", "Le", ["a", "b", "", "c"])


def test_timestamps_that_do_not_fit_are_null(spark):
    df = spark.createDataFrame([("01/11/2002",), ("2002-01-11",), (None,)], "day string")
    parsed = [r[0] for r in df.select(parsed_timestamp("day", "MM/dd/yyyy")).collect()]
    assert str(parsed[0]) == "2002-01-11 00:00:00" and parsed[1:] == [None, None]
    week = spark.sql("SELECT DATE '2021-01-03' AS day").select(calendar_part("day", "week"))
    assert week.first()[0] == 53


CELSIUS = [20.5, 2.0, 35.2, 40.8, 15.0]


def test_array_functions(spark):
    df = spark.createDataFrame([(CELSIUS,), ([],), (None,)], "celsius array<double>")
    values = F.col("celsius")
    rows = df.select(
        nested.to_fahrenheit(values).alias("f"),
        udfs.fahrenheit_arrays(values).alias("f_udf"),
        nested.above(values, 38).alias("high"),
        nested.any_above(values, 38).alias("any"),
        nested.array_total(values).alias("total"),
    ).collect()
    assert rows[0].f == pytest.approx([68.9, 35.6, 95.36, 105.44, 59.0])
    assert rows[0].f_udf == rows[0].f
    assert (rows[0].high, rows[0].any, rows[0].total) == ([40.8], True, 113.5)
    assert (rows[1].f, rows[1].f_udf, rows[1].high, rows[1].any, rows[1].total) == (
        [], [], [], False, 0.0
    )
    assert list(rows[2]) == [None] * 5


def test_struct_functions(spark):
    df = spark.sql("""
        SELECT named_struct('charisma', 12D, 'bravery', 15D) AS personal,
               named_struct('strength', 10D, 'dexterity', 12D) AS physical
    """)
    personal, physical = {"charisma": 2.0, "bravery": 0.5}, {"strength": 0.5, "dexterity": 3.0}
    native = df.select(
        nested.scaled_fields(F.col("personal"), personal).alias("personal"),
        nested.scaled_fields(F.col("physical"), physical).alias("physical"),
    )
    spark.udf.register("scaled", udfs.field_scaler("charisma double, bravery double", personal))
    df.createOrReplaceTempView("people")
    by_udf = spark.sql("SELECT scaled(personal) AS personal FROM people")
    assert tuple(native.first().personal) == tuple(by_udf.first().personal) == (24.0, 7.5)
    assert tuple(native.first().physical) == (5.0, 36.0)


def test_cubes(spark):
    udfs.register_udfs(spark)
    spark.range(1, 9).createOrReplaceTempView("numbers")
    df = spark.sql("SELECT id, cubed(id) AS cube FROM numbers")
    rows = df.withColumn("native", udfs.cubed_native(F.col("id"))).collect()
    assert [r.cube for r in rows] == [1, 8, 27, 64, 125, 216, 343, 512]
    assert [r.native for r in rows] == [r.cube for r in rows]


def test_cubes_are_exact_beside_null(spark):
    df = spark.createDataFrame([(2_097_151,), (None,)], "n bigint").coalesce(1)
    assert [r[0] for r in df.select(udfs.cubed("n")).collect()] == [2_097_151**3, None]


def test_cubes_do_not_wrap_around(spark):
    big = spark.range(2_097_152, 2_097_153)
    with pytest.raises(ArithmeticException):
        big.select(udfs.cubed_native(F.col("id"))).collect()
    with pytest.raises(Exception, match="not a bigint"):
        big.select(udfs.cubed(F.col("id"))).collect()


def test_null_structs_and_arrays_stay_null(spark):
    from tablework.functions.udfs import fahrenheit_arrays, field_scaler

    df = spark.sql("SELECT * FROM VALUES (1, named_struct('a', 1D, 'b', 2D)), (2, NULL) t(id, s)")
    scaled = df.select("id", field_scaler("a double, b double", {"a": 3.0})("s").alias("s"))
    rows = {r.id: r.s for r in scaled.collect()}
    assert tuple(rows[1]) == (3.0, 2.0) and rows[2] is None
    arrays = spark.createDataFrame([(1, [0.0, None]), (2, None), (3, [])], "id int, xs array<double>")
    rows = {r.id: r.ys for r in arrays.coalesce(1).select("id", fahrenheit_arrays("xs").alias("ys")).collect()}
    assert rows == {1: [32.0, None], 2: None, 3: []}


NESTED = "s struct<x:int,y:int,z:struct<a:string,b:string>>, l array<struct<p:int,q:int>>, m map<string,struct<u:int,v:int>>"


def test_nested_records_are_bound_by_name(spark):
    rows = [((1, 2, ("a", "b")), [(3, 4), None], {"k": (5, 6)}), (None, None, None)]
    want = StructType.fromDDL(
        "m map<string,struct<v:bigint,u:int>>, l array<struct<q:string,p:int>>, s struct<z:struct<b:string>,y:int,x:int>"
    )
    found = conform(spark.createDataFrame(rows, NESTED), want)
    assert [f.dataType.simpleString() for f in found.schema.fields] == [f.dataType.simpleString() for f in want.fields]
    one, two = found.collect()
    assert one.s.asDict(True) == {"z": {"b": "b"}, "y": 2, "x": 1}
    assert [x and x.asDict() for x in one.l] == [{"q": "4", "p": 3}, None]
    assert one.m["k"].asDict() == {"v": 6, "u": 5}
    assert tuple(two) == (None, None, None)


@pytest.mark.parametrize(
    "record", ["s struct<x:int,w:int>", "l array<struct<p:int,w:int>>", "m map<string,struct<w:int>>",
               "s struct<z:struct<w:int>>", "s int", "l array<int>"],
)
def test_a_missing_inner_field_or_another_shape_is_an_error(spark, record):
    frame = spark.createDataFrame([], NESTED)
    with pytest.raises(ValueError, match="record type"):
        conform(frame, StructType.fromDDL(record))


def test_dirty_inner_values(spark):
    frame = spark.createDataFrame([(("7", "x"),)], "s struct<a:string,b:string>")
    found = conform(frame, StructType.fromDDL("s struct<b:int,a:int>"), dirty="null").first()
    assert found.s.asDict() == {"b": None, "a": 7}
