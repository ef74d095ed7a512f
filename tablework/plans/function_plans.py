"""Scalar, array and struct functions, native and as Arrow UDFs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.functions import nested, text, udfs
from tablework.functions.temporal import DAY_LAYOUT, SECOND_LAYOUT, parsed_timestamp
from tablework.plans.registry import query, table
from tablework.plans.scan_plans import text_lines
from tablework.storage import fresh_name


@query("SELECT doc_id, concat(lang, source, CAST(doc_id AS VARCHAR)) AS document_key "
       "FROM documents")
def concat_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.joined("lang", "source", "doc_id").alias("document_key")
    )


@query("""
    SELECT o_orderkey, CAST(substring(strftime(o_orderdate, '%m%d%H%M'), 1, 2) AS BIGINT) AS month
    FROM orders
""")
def substring_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "MMddHHmm").alias("stamp")
    )
    return stamped.select("o_orderkey", text.leading("stamp", 2).cast("bigint").alias("month"))


@query("""
    SELECT CAST(COUNT(*) AS BIGINT) AS n_lines
    FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) lines
    WHERE contains(line, 'the')
""")
def text_contains_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = text_lines(spark, sf_dir).where(F.col("value").contains("the"))
    return lines.agg(F.count(F.lit(1)).alias("n_lines"))


@query(r"""
    SELECT array_to_string(words, ' ') AS words, CAST(COUNT(*) AS BIGINT) AS count
    FROM (SELECT string_split_regex(text, '\s') AS words FROM documents) split
    GROUP BY words
""")
def split_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split without explode: what is counted is the whole list of words of a text."""
    blanks = F.array_join(text.whitespace_split("text"), " ")
    return table(spark, sf_dir, "documents").groupBy(blanks.alias("words")).count()


@query("""
    SELECT event_id, date_trunc('day', ts) AS event_day, date_trunc('second', ts) AS event_second,
           CAST(NULL AS TIMESTAMP) AS misfit
    FROM events
""")
def parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times written as text and parsed again; text in another layout gives NULL."""
    texts = table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format("ts", DAY_LAYOUT).alias("day_text"),
        F.date_format("ts", SECOND_LAYOUT).alias("second_text"),
    )
    parsed = {
        "event_day": parsed_timestamp("day_text", DAY_LAYOUT),
        "event_second": parsed_timestamp("second_text", SECOND_LAYOUT),
        "misfit": parsed_timestamp("day_text", SECOND_LAYOUT),
    }
    return texts.select(
        "event_id", *[column.cast("timestamp_ntz").alias(name) for name, column in parsed.items()]
    )


FAHRENHEIT_SQL = """
    SELECT vec_id, CAST(position - 1 AS BIGINT) AS position,
           CAST(embedding[position] AS DOUBLE) * 1.8::DOUBLE + 32 AS fahrenheit
    FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS position
          FROM embeddings) items
"""


def _items(df: DataFrame, array: str, name: str) -> DataFrame:
    items = df.select("vec_id", F.posexplode(array).alias("position", name))
    return items.withColumn("position", F.col("position").cast("bigint"))


def _temperatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    celsius = F.col("embedding").cast("array<double>").alias("celsius")
    return table(spark, sf_dir, "embeddings").select("vec_id", celsius)


@query(FAHRENHEIT_SQL)
def array_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    converted = _temperatures(spark, sf_dir).withColumn(
        "fahrenheit", nested.to_fahrenheit(F.col("celsius"))
    )
    return _items(converted, "fahrenheit", "fahrenheit")


@query(FAHRENHEIT_SQL)
def array_transform_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a registered Arrow UDF, called from SQL."""
    udfs.register_udfs(spark)
    name = fresh_name("temperatures")
    _temperatures(spark, sf_dir).createOrReplaceTempView(name)
    converted = spark.sql(f"SELECT vec_id, fahrenheit_arrays(celsius) AS fahrenheit FROM {name}")
    return _items(converted, "fahrenheit", "fahrenheit")


@query("""
    SELECT vec_id, CAST(position - 1 AS BIGINT) AS position, high[position] AS high
    FROM (SELECT vec_id, high, unnest(range(1, len(high) + 1)) AS position
          FROM (SELECT vec_id, list_filter(CAST(embedding AS DOUBLE[]), lambda v: v > 0.1) AS high
                FROM embeddings) filtered) items
""")
def array_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    high = nested.above(F.col("celsius"), 0.1)
    return _items(_temperatures(spark, sf_dir).withColumn("high", high), "high", "high")


@query("""
    SELECT vec_id,
           CASE WHEN len(list_filter(embedding, lambda v: CAST(v AS DOUBLE) > 0.3)) > 0
                THEN 1 ELSE 0 END::BIGINT AS has_high,
           list_reduce(CAST(embedding AS DOUBLE[]), lambda total, v: total + v) AS total
    FROM embeddings
""")
def array_exists_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _temperatures(spark, sf_dir).select(
        "vec_id",
        nested.any_above(F.col("celsius"), 0.3).cast("bigint").alias("has_high"),
        nested.array_total(F.col("celsius")).alias("total"),
    )


# Factors of the fields of a struct.
STRENGTHS = {"strength": 0.5, "dexterity": 3.0}
STRUCT_SQL = """
    SELECT event_id, CAST(user_id AS DOUBLE) * 0.5::DOUBLE AS strength,
           value * 3.0::DOUBLE AS dexterity
    FROM events
"""


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = F.struct(
        F.col("user_id").cast("double").alias("strength"), F.col("value").alias("dexterity")
    )
    return table(spark, sf_dir, "events").select("event_id", record.alias("physical"))


@query(STRUCT_SQL)
def struct_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = nested.scaled_fields(F.col("physical"), STRENGTHS).alias("physical")
    return _people(spark, sf_dir).select("event_id", scaled).select("event_id", "physical.*")


@query(STRUCT_SQL)
def struct_rebuild_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    scale = udfs.field_scaler("strength double, dexterity double", STRENGTHS)
    scaled = scale(F.col("physical")).alias("physical")
    return _people(spark, sf_dir).select("event_id", scaled).select("event_id", "physical.*")


@query("""
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, quantity,
           quantity * quantity * quantity AS by_udf, quantity * quantity * quantity AS by_native
    FROM (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS quantity
          FROM lineitem) lines
""")
def udf_cubed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An Arrow UDF called from SQL, beside the native product."""
    udfs.register_udfs(spark)
    name = fresh_name("lines")
    table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.col("l_linenumber").cast("bigint"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
    ).createOrReplaceTempView(name)
    cubes = spark.sql(f"SELECT *, cubed(quantity) AS by_udf FROM {name}")
    return cubes.withColumn("by_native", udfs.cubed_native(F.col("quantity")))


RECORD = (
    "struct<body: struct<strength: double, dexterity: double>, "
    "mind: struct<kind: string, wisdom: double>>"
)


@query("""
    SELECT event_id, CAST(user_id AS DOUBLE) * 0.5::DOUBLE AS strength,
           value * 3.0::DOUBLE AS dexterity, event_type AS kind, value * 2.0::DOUBLE AS wisdom
    FROM events
""")
def nested_record_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two structs inside a record are rebuilt and bound to the record's type."""
    body = F.struct(F.col("user_id").cast("double").alias("strength"), F.col("value").alias("dexterity"))
    mind = F.struct(F.col("event_type").alias("kind"), F.col("value").alias("wisdom"))
    records = table(spark, sf_dir, "events").select(
        "event_id", F.struct(body.alias("body"), mind.alias("mind")).alias("record")
    )
    record = F.col("record")
    rebuilt = record.withField("body", nested.scaled_fields(record["body"], STRENGTHS))
    rebuilt = rebuilt.withField("mind", nested.scaled_fields(record["mind"], {"wisdom": 2.0}))
    bound = records.select("event_id", rebuilt.cast(RECORD).alias("record"))
    return bound.select("event_id", "record.body.*", "record.mind.*")
