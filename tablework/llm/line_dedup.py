"""Line dedup: lines that many documents share stay in one of them only.

Keys of lines are hashed (twice 64 bits, so different keys do not meet) and range-partitioned by
hash, with a secondary sort by document and position. Streaming over that order tells the first
occurrence of a key in each document; these are counted per key. A key's documents are dealt into
cells, and the cell is part of the range, so a line that a third of all documents hold is streamed
by many tasks, each passing on one count. What comes back is a keep bitmap per document that only
has the 64-bit words with a dropped line; text is not shuffled for it.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablework.llm.shared import documents, id_and_text, written
from tablework.storage import fresh_name

MIN_CHARS, MIN_DOCS = 20, 3
_BLANKS = "' ', '\\t', '\\n', '\\u000B', '\\f', '\\r'"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rows(docs: DataFrame) -> DataFrame:
    """Documents with a number for their text, so that rows that share a doc_id stay apart."""
    return id_and_text(docs).withColumn("text_hash", F.xxhash64("text"))


def line_keys(rows: DataFrame) -> DataFrame:
    """The lines long enough to count: where they are, and two hashes of their key."""
    lines = rows.where("doc_id IS NOT NULL").select(
        "doc_id", "text_hash", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")
    )
    key = F.translate(F.expr(f"btrim(line, concat({_BLANKS}))"), _UPPER, _LOWER)
    return (
        lines.select("doc_id", "text_hash", "pos", key.alias("key"))
        .where(F.length("key") >= MIN_CHARS)
        .select(
            F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"),
            "doc_id", "text_hash", "pos",
        )
    )


def shared_keys(keys: DataFrame) -> DataFrame:
    """Keys found in at least MIN_DOCS documents, each with the document that keeps it."""
    width = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = keys.withColumn("cell", F.pmod(F.xxhash64("doc_id"), F.lit(width)))
    ordered = cells.repartitionByRange(width, "h1", "cell")
    stream = Window.partitionBy("h1", "h2", "cell").orderBy(F.desc("doc_id"), "text_hash", "pos")
    before = F.lag("doc_id").over(stream)
    first = ordered.withColumn("before", before).where("before IS NULL OR before <> doc_id")
    found = first.groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.max("doc_id").alias("keeper"))
    return found.where(F.col("docs") >= MIN_DOCS).select("h1", "h2", "keeper")


def dropped_lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, n_dropped, dropped)``: for documents that lose lines, how many and
    which: a map from line number div 64 to the bits of the lines to drop."""
    keys = written(line_keys(_rows(docs)), "lines")
    shared = written(shared_keys(keys), "shared")
    lost = keys.join(shared, ["h1", "h2"]).where("doc_id <> keeper")
    words = (
        lost.groupBy("doc_id", "text_hash", F.expr("pos div 64").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
    )
    return words.groupBy("doc_id", "text_hash").agg(
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("dropped"),
    )


def keep_bitmaps(docs: DataFrame) -> DataFrame:
    """``dropped_lines`` for every row of ``docs``, with n_lines. A null or empty text is one empty
    line. Rows that share a doc_id count as one document; a row without doc_id loses nothing."""
    rows = _rows(docs).select(
        "doc_id", "text_hash", F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines")
    )
    lost = written(dropped_lines(docs), "bitmaps")
    return rows.join(lost, ["doc_id", "text_hash"], "left").select(
        "doc_id", "n_lines", F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"), "dropped"
    )


def kept_text(text: str = "text", dropped: str = "dropped"):
    """A text without the lines that a bitmap names."""
    return F.expr(
        f"""CASE WHEN {dropped} IS NULL THEN {text} ELSE array_join(filter(
            split({text}, '\\n', -1), (line, i) ->
            (shiftright(coalesce(try_element_at({dropped}, i div 64L), 0L), i % 64) & 1L) = 0L
        ), '\\n') END"""
    )


def without_shared_lines(docs: DataFrame) -> DataFrame:
    """The documents with their texts and n_chars after dropping; all columns. Null stays null."""
    lost = written(dropped_lines(docs), "bitmaps").select("doc_id", "text_hash", "dropped")
    names = [fresh_name(c) for c in lost.columns]  # the table may have columns of any name
    lost_id, lost_hash, dropped = names
    same = (docs["doc_id"] == F.col(lost_id)) & (F.xxhash64(docs["text"]) == F.col(lost_hash))
    joined = docs.join(lost.toDF(*names), same, "left")
    kept = kept_text("text", dropped)
    columns = {
        "text": F.when(F.col(dropped).isNull(), docs["text"]).otherwise(kept).alias("text")
    }
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col(dropped).isNull(), docs["n_chars"])
        columns["n_chars"] = n_chars.otherwise(F.length(kept).cast("long")).alias("n_chars")
    return joined.select([columns.get(c, docs[c]) for c in docs.columns])


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    lost = written(dropped_lines(docs), "bitmaps")
    rows = _rows(docs).join(lost, ["doc_id", "text_hash"], "left")
    return rows.select(
        "doc_id",
        F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(kept_text(), 256).alias("kept_sha256"),
    )


SQL = f"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), lines AS (
    SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line FROM split
), keyed AS (
    SELECT *, translate(
        trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        '{_UPPER}', '{_LOWER}'
    ) AS key FROM lines
), shared AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= {MIN_CHARS}
    GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}
), marked AS (
    SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.keeper AS dropped
    FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines,
    CAST(count(*) FILTER (dropped) AS BIGINT) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
