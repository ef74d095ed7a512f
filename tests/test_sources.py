import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablework.plans import scan_plans
from tablework.plans.explain import plan_text
from tablework.sinks import files
from tablework.sinks import write_json_arrays, write_partitioned, write_tsv
from tablework.sources import (
    file_view,
    generated_rows,
    label_for,
    read_csv,
    read_json_array_lines,
    read_json_arrays,
    read_json_lines,
    read_parquet,
    read_partitions,
    read_split_json_arrays,
    read_text,
    read_tsv,
    rows_to_table,
)

RECORD = "id INT NOT NULL, name STRING NOT NULL, tags ARRAY<STRING>"


def test_csv_modes(spark, tmp_path):
    path = tmp_path / "calls.csv"
    path.write_text("id,delay,day\n10,2.95,01/04/2016\n5,5.7,05/31/2018\n,,\n")
    text = read_csv(spark, str(path))
    assert [t for _, t in text.dtypes] == ["string"] * 3
    assert dict(read_csv(spark, str(path), infer=True).dtypes)["delay"] == "double"
    fixed = read_csv(
        spark, str(path), schema="id INT, delay DOUBLE, day DATE", date_format="MM/dd/yyyy"
    )
    assert [str(r.day) for r in fixed.collect()] == ["2016-01-04", "2018-05-31", "None"]
    # Numbers held as text compare as text, so smallest and largest need a cast first.
    assert text.agg(F.min("id")).first()[0] == "10"
    assert text.agg(F.min(F.col("id").cast("int"))).first()[0] == 5


def test_dates_in_another_layout_are_null_without_their_format(spark, tmp_path):
    path = tmp_path / "calls.csv"
    path.write_text("day\n01/04/2016\n")
    assert read_csv(spark, str(path), schema="day DATE").first().day is None


def test_wide_fixed_schema(spark, tmp_path):
    """Text, whole numbers, flags, dates, half-day timestamps and doubles in one record."""
    kinds = ["INT", "STRING", "BIGINT", "DATE", "TIMESTAMP", "BOOLEAN", "DOUBLE"] * 4
    schema = ", ".join(f"c{i} {kind}" for i, kind in enumerate(kinds))
    values = ["7", "abc", "20110016", "01/11/2002", "01/11/2002 01:51:44 PM", "true", "2.95"] * 4
    path = tmp_path / "wide.csv"
    path.write_text(",".join(f"c{i}" for i in range(28)) + "\n" + ",".join(values) + "\n")
    row = read_csv(
        spark, str(path), schema=schema, date_format="MM/dd/yyyy",
        timestamp_format="MM/dd/yyyy hh:mm:ss a",
    ).first()
    assert len(row) == 28 and None not in row
    assert (str(row.c3), str(row.c4), row.c5) == ("2002-01-11", "2002-01-11 13:51:44", True)


@pytest.mark.parametrize("line_end", ["\r", "\n", "\r\n"])
def test_tab_separated_lines(spark, tmp_path, line_end):
    path = tmp_path / "codes.txt"
    lines = ["City\tState\tIATA", '"Big, one"\tAK\tABL', "Aspen\tCO\tASE"]
    path.write_bytes((line_end.join(lines) + line_end).encode())
    rows = read_tsv(spark, str(path)).collect()
    assert [r.City for r in rows] == ["Big, one", "Aspen"]


def test_tsv_sink_with_bare_cr(spark, tmp_path):
    path = str(tmp_path / "out")
    write_tsv(spark.range(5).coalesce(1), path, line_end="\r")
    assert read_tsv(spark, path).count() == 5


def test_json_lines(spark, tmp_path):
    path = tmp_path / "blogs.json"
    rows = [{"id": i, "name": f"n{i}", "tags": ["web", "fb"]} for i in range(6)]
    path.write_text("\n".join(json.dumps(r) for r in rows))
    df = read_json_lines(spark, str(path), RECORD)
    assert df.count() == 6
    # File sources do not enforce NOT NULL.
    assert all(f.nullable for f in df.schema.fields)


def test_array_file_in_both_modes(spark, tmp_path):
    path = tmp_path / "blogs.json"
    path.write_text('[\n {"id": 1, "name": "a"},\n {"id": 2, "name": "b"}\n]\n')
    assert read_json_arrays(spark, str(path), RECORD).count() == 2
    assert spark.read.schema(RECORD).json(str(path)).count() == 4
    rows = read_json_array_lines(spark, str(path), RECORD, "id").collect()
    assert sorted(r.id for r in rows) == [1, 2]


@pytest.mark.parametrize("count", [0, 1, 2, 1000])
def test_json_array_sink(spark, tmp_path, count):
    """Every file is one JSON array, whatever the number of rows in its partition."""
    path = str(tmp_path / "arrays")
    df = spark.range(count).select("id", F.lit("a\nb").alias("name"), F.lit(None).alias("x"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        write_json_arrays(df.repartition(3), path)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    contents = [f.read_text() for f in (tmp_path / "arrays").glob("part-*")]
    objects = [o for text in contents if text for o in json.loads(text)]
    assert sorted(o["id"] for o in objects) == list(range(count))
    schema = "id BIGINT, name STRING"
    assert read_json_arrays(spark, path, schema).count() == count
    assert read_json_array_lines(spark, path, schema, "id").count() == count


def test_text_lines(spark, tmp_path):
    path = tmp_path / "notes.md"
    path.write_text("".join(f"line {i}{' Spark' if i % 6 == 0 else ''}\n" for i in range(109)))
    lines = read_text(spark, str(path))
    assert lines.columns == ["value"]
    assert lines.count() == 109
    assert lines.where(F.col("value").contains("Spark")).count() == 19
    assert lines.where(F.col("value").contains("spark")).count() == 0


def test_partitions_are_pruned_and_keep_their_columns(spark, tmp_path):
    root = str(tmp_path / "tree")
    df = spark.range(100).select("id", (F.col("id") % 4).alias("y"), (F.col("id") % 2).alias("m"))
    write_partitioned(df, root, "y", "m")
    assert read_parquet(spark, root).count() == 100
    one = read_partitions(spark, root, (F.col("y") == 1) & (F.col("m") == 1))
    assert set(one.columns) == {"id", "y", "m"} and one.count() == 25
    assert "PartitionFilters: [isnotnull(y" in plan_text(one)
    # A folder read by itself loses them.
    assert spark.read.parquet(f"{root}/y=1/m=1").columns == ["id"]


def test_a_large_partition_is_written_by_several_tasks(spark, tmp_path):
    """Most rows in one month; the small months still get one file each."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "50KB")
    try:
        month = F.when(F.col("id") % 10 < 8, 1).otherwise(F.col("id") % 10)
        df = spark.range(0, 100_000, 1, 8).select("id", month.alias("month"))
        write_partitioned(df, str(tmp_path / "tree"), "month")
    finally:
        spark.conf.unset(key)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "tree").glob("month=*")}
    assert files["month=1"] > 1 and set(files) == {"month=1", "month=8", "month=9"}
    assert read_parquet(spark, str(tmp_path / "tree")).count() == 100_000


def test_file_view_and_rows(spark, tmp_path):
    path = str(tmp_path / "p")
    people = rows_to_table(spark, [("Ann", "CA"), ("Bo", "TX")], "name STRING, state STRING")
    people.write.partitionBy("state").parquet(path)
    assert file_view(spark, "people_files", path).count() == 2
    assert rows_to_table(spark, [("Ann", 1)], ["name", "n"]).columns == ["name", "n"]


def test_generated_rows_use_every_label(spark):
    df = generated_rows(spark, 60, label=label_for(F.col("id"), ["AZ", "CO", "CA"]))
    assert {r.label: r["count"] for r in df.groupBy("label").count().collect()} == {
        "AZ": 20, "CO": 20, "CA": 20
    }


def test_a_field_that_does_not_fit_is_null_and_its_row_stays(spark, tmp_path):
    (tmp_path / "a.json").write_text('[\n{"id":1,"hits":3},\n{"id":2,"hits":"x"},\n{"hits":4}\n]\n')
    rows = read_json_array_lines(spark, str(tmp_path), "id int, hits int", "id").collect()
    assert sorted((r.id, r.hits) for r in rows if r.hits is not None) == [(1, 3)]
    assert [(r.id, r.hits) for r in rows if r.hits is None] == [(2, None)]
    kept = read_json_array_lines(spark, str(tmp_path), "id int, hits int", "id", corrupt="line")
    kept = kept.cache().collect()
    assert len(kept) == 3 and [r.line for r in kept if r.id == 2] == ['{"id":2,"hits":"x"},']


TRICKY_TEXTS = ["", "plain", 'a "quoted" word', "back\\slash\\", "[{", "}]", '\\"', "\n\t", "é中😀", '{"x": [1, "]"]}', "\\" * 9]


@pytest.mark.parametrize("size", [7, 64, 1000, 10**6])
@pytest.mark.parametrize("indent", [None, 2])
def test_array_files_are_read_by_byte_ranges(spark, tmp_path, size, indent):
    rng = random.Random(size)
    rows = [
        {"id": i, "t": "".join(rng.choices(TRICKY_TEXTS, k=3)), "n": {"l": [{"d": i}] * (i % 3)}} for i in range(40)
    ]
    folder = tmp_path / "arrays"
    folder.mkdir()
    (folder / "part-1.json").write_text(json.dumps(rows[:25], indent=indent, ensure_ascii=False))
    (folder / "part-2.json").write_text("\ufeff \n" + json.dumps(rows[25:39], indent=indent))
    (folder / "part-3.json").write_text(json.dumps(rows[39], indent=indent))
    (folder / "part-4.json").write_text("[]")
    (folder / "_SUCCESS").write_text("")
    schema = "id int, t string, n struct<l: array<struct<d: int>>>"
    found = read_split_json_arrays(spark, str(folder), schema, size)
    assert sorted((r.asDict(True) for r in found.collect()), key=lambda r: r["id"]) == rows
    if size == 1000:
        assert found.rdd.getNumPartitions() > 4
    one = read_split_json_arrays(spark, f"file://{folder}/part-1.json", schema, size)
    assert one.count() == 25


def test_ranges_of_nothing_and_of_a_cut_file(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert read_split_json_arrays(spark, str(tmp_path / "empty"), "id int").count() == 0
    (tmp_path / "cut.json").write_text('[{"id": 1}, {"id": ')
    with pytest.raises(Exception, match="ends inside an element"):
        read_split_json_arrays(spark, str(tmp_path / "cut.json"), "id int").count()


def test_array_files_are_bounded_by_bytes(spark, tmp_path):
    df = spark.range(200).selectExpr("id", "repeat('x', 1000) AS t")
    write_json_arrays(df, str(tmp_path / "arrays"), bytes_per_file=50_000)
    sizes = [f.stat().st_size for f in (tmp_path / "arrays").glob("part-*")]
    assert len(sizes) == 5 and max(sizes) < 60_000


def test_batches_on_their_way_into_array_files_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    """Long rows come to Python a few at a time, and the setting is as before afterwards."""
    monkeypatch.setattr(files, "BYTES_PER_BATCH", 50_000)

    def seen(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"value": [f"{batch.num_rows}"] * batch.num_rows})

    monkeypatch.setattr(files, "_as_array_lines", seen)
    before = spark.conf.get(files.ARROW_BYTES)
    rows = spark.range(500).select(F.repeat(F.lit("x"), 10_000).alias("text"))
    write_json_arrays(rows, str(tmp_path / "long"))
    sizes = [int(r.value) for r in spark.read.text(str(tmp_path / "long")).collect()]
    assert len(sizes) == 500 and max(sizes) <= 10
    assert spark.conf.get(files.ARROW_BYTES) == before


def test_array_lines_of_batches():
    batches = [pa.RecordBatch.from_pydict({"value": pa.array(x, pa.string())}) for x in ([], ["{1}"], ["{2}", "{é}"], [], ["{4}"])]
    made = [x for b in files._as_array_lines(iter(batches)) for x in b.column("value").to_pylist()]
    assert made == ["[", "{1},", "{2},", "{é},", "{4}", "]"]
    assert list(files._as_array_lines(iter(batches[:1]))) == []


def test_large_arrays_of_documents_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scan_plans, "BYTES_PER_DOCUMENT_ARRAY", 300_000)
    seen = []
    monkeypatch.setattr(scan_plans, "fresh_path", lambda s, label: seen.append(f"{tmp_path}/{label}") or seen[-1])
    rows = spark.range(100).selectExpr(
        "id AS doc_id", "concat(repeat('[a}\\n\"', 2000), id) AS text", "'en' AS lang", "'web' AS source", "1L AS n_chars"
    )
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    read = scan_plans.json_array_ranges(spark, str(tmp_path))
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, rows.collect()))
    sizes = [f.stat().st_size for f in (tmp_path / "json-arrays").glob("part-*")]
    assert len(sizes) > 3 and max(sizes) < 450_000 and read.rdd.getNumPartitions() > len(sizes)
