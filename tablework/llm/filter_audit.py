"""Filter interaction audit: what each of several filters removes, in every order and at every step.

A set of filters S removes the documents that fail at least one of them; v(S) counts these. The
Hart-Mas-Colell potential of this game is P({}) = 0, P(S) = (v(S) + sum of P(S - i) over i in S) /
|S|, and the Shapley value of filter i is P(all) - P(all - i). Here |S|! * P(S), a whole number, is
kept: Q(S) = (|S| - 1)! * v(S) + sum of Q(S - i). Differences of v between neighbouring coalitions
are the steps of every order, so documents are counted once per set of failed filters and not once
per order.

Documents are reduced to a few numbers each before anything is shuffled; hot texts and sources are
combined on the map side or joined by keys with the doc_id in them.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.llm.shared import documents, written

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 50, 65, 5  # words; per cent of words; per cent of characters
_BLANK = r"[\x20\x09-\x0D]+"
_MARKS = r"[#$%&*|]"


def failures(docs: DataFrame) -> DataFrame:
    """``(doc_id, part, failed)``: one row per row of ``docs``; bit i of ``failed`` says that it
    fails filter i.

    A null text is empty: it has under 50 words and fails nothing else but E. ``part`` is the source,
    a null one the empty string. Rows that share a doc_id are documents each and do not precede each
    other; a row without doc_id neither precedes nor follows another, so it never fails E.
    """
    source = docs["source"].cast("string")
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
        F.coalesce(source, F.lit("")).alias("part"),
    )
    words = F.array_remove(F.split("text", _BLANK), "")
    counted = rows.select(
        "doc_id", "part",
        F.size(words).alias("words"),
        F.size(F.array_distinct(words)).alias("distinct"),
        F.length(F.regexp_replace("text", "[^A-Z]+", "")).alias("capitals"),
        F.length("text").alias("chars"),
        F.col("text").rlike(_MARKS).alias("marked"),
        F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"),
    )
    bits = [
        F.col("words") < MIN_WORDS,
        100 * F.col("distinct").cast("long") < MIN_DISTINCT * F.col("words").cast("long"),
        100 * F.col("capitals").cast("long") > MAX_CAPITALS * F.col("chars").cast("long"),
        F.col("marked"),
    ]
    own = sum((F.when(b, 1 << i).otherwise(0) for i, b in enumerate(bits)), F.lit(0))
    facts = written(counted.select("doc_id", "part", "h1", "h2", own.alias("own")), "facts")
    first = facts.groupBy("h1", "h2").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    later = F.col("doc_id").isNotNull() & F.col("first").isNull()
    failed = F.col("own") + F.when(later, 1 << len(bits)).otherwise(0)
    return facts.join(first, ["h1", "h2", "doc_id"], "left").select(
        "doc_id", "part", failed.cast("int").alias("failed")
    )


def label_counts(labels: DataFrame) -> DataFrame:
    """``(doc_id, good, toxic)`` as 0 or 1, one row per doc_id; any row with the mark gives it."""
    return labels.where("doc_id IS NOT NULL").groupBy(labels["doc_id"].cast("long").alias("doc_id")).agg(
        F.max(F.when(labels["quality"] == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(labels["toxic"] == 1, 1).otherwise(0)).alias("toxic"),
    )


def tally(failed: DataFrame, marks: DataFrame) -> DataFrame:
    """``(part, failed, n, good, toxic)``: documents per part and set of failed filters."""
    marked = failed.join(marks, "doc_id", "left")
    return marked.groupBy("part", "failed").agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum("good"), F.lit(0)).cast("long").alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).cast("long").alias("toxic"),
    )


def _removed(count: str, sets: int) -> str:
    """Array over all coalitions: how much of ``count`` each removes."""
    return f"""transform(sequence(0, {sets - 1}), s -> aggregate(
        cells, 0L, (sum, x) -> sum + IF((x.failed & s) <> 0, x.{count}, 0L)))"""


def _potentials(k: int) -> str:
    """Array over all coalitions: |S|! times the potential, each from the coalitions below it."""
    factorials = ", ".join(f"{math.factorial(max(0, i - 1))}L" for i in range(k + 1))
    below = " + ".join(f"IF((s & {1 << i}) <> 0, get(q, s ^ {1 << i}), 0L)" for i in range(k))
    return f"""aggregate(sequence(1, {(1 << k) - 1}), array(0L), (q, s) -> concat(q, array(
        get(array({factorials}), bit_count(s)) * get(v_n, s) + {below})))"""


def steps(tallied: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of ``filters`` and step, from a ``tally``. Bit i of ``failed`` belongs
    to the i-th letter. No documents, no rows. At most 2 ** len(filters) rows of a part are brought
    together."""
    k, sets = len(filters), 1 << len(filters)
    games = (
        tallied.groupBy("part")
        .agg(F.sum("n").alias("docs"), F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("cells"))
        .select("part", "docs", *[F.expr(_removed(c, sets)).alias(f"v_{c}") for c in ("n", "good", "toxic")])
        .withColumn("q", F.expr(_potentials(k)))
    )
    orders = ",".join("".join(p) for p in itertools.permutations(filters))
    ordered = games.select("*", F.explode(F.split(F.lit(orders), ",")).alias("filter_order"))
    stepped = ordered.select("*", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("step"))

    def bits(prefix: str) -> str:
        return " + ".join(f"IF(instr({prefix}, '{x}') > 0, {1 << i}, 0)" for i, x in enumerate(filters))

    placed = stepped.select(
        "*",
        F.expr(bits("substr(filter_order, 1, step - 1)")).alias("before"),
        F.expr(bits("substr(filter_order, step, 1)")).alias("own"),
    )
    gained = "get(v_{0}, before | own) - get(v_{0}, before)"
    everything = sets - 1
    return placed.select(
        "part", "filter_order", "step",
        F.expr("docs - get(v_n, before | own)").alias("kept"),
        F.expr(gained.format("n")).alias("removed"),
        F.expr(f"get(v_n, own) - ({gained.format('n')})").alias("redundant"),
        F.expr(f"get(v_n, {everything}) - get(v_n, {everything} ^ own)").alias("unique_fails"),
        F.expr(gained.format("good")).alias("good_lost"),
        F.expr(gained.format("toxic")).alias("toxic_lost"),
        F.expr(f"get(q, {everything}) - {k}L * get(q, {everything} ^ own)").alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``steps`` of the five filters over ``docs``."""
    return steps(written(tally(failures(docs), label_counts(labels)), "tally"))


def op13_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


_LETTERS = ", ".join(f"('{x}', {1 << i})" for i, x in enumerate(FILTERS))
_PREFIX = " || ".join(f"f{i}.letter" for i in range(len(FILTERS)))
SQL = f"""
WITH letters(letter, bit) AS (VALUES {_LETTERS}),
texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), words AS (
    SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w,
        doc_id > min(doc_id) OVER (PARTITION BY text) AS later
    FROM texts
), marks AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
        max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id
), failed AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        CASE WHEN len(w) < {MIN_WORDS} THEN 1 ELSE 0 END
        + CASE WHEN 100 * len(list_distinct(w)) < {MIN_DISTINCT} * len(w) THEN 2 ELSE 0 END
        + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g'))
            > {MAX_CAPITALS} * length(text) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(text, '{_MARKS}') THEN 8 ELSE 0 END
        + CASE WHEN coalesce(later, false) THEN 16 ELSE 0 END AS failed
    FROM words LEFT JOIN marks USING (doc_id)
), orders AS (
    SELECT {_PREFIX} AS filter_order
    FROM {", ".join(f"letters f{i}" for i in range(len(FILTERS)))}
    WHERE {" AND ".join(f"f{i}.letter <> f{j}.letter" for j in range(len(FILTERS)) for i in range(j))}
), steps AS (
    SELECT filter_order, step, l.bit AS own, coalesce((
        SELECT sum(b.bit) FROM letters b
        WHERE instr(substr(filter_order, 1, step - 1), b.letter) > 0), 0)::INTEGER AS before
    FROM orders, range(1, {len(FILTERS) + 1}) AS r(step), letters l
    WHERE l.letter = substr(filter_order, step, 1)
), counted AS (
    SELECT part, filter_order, CAST(step AS INTEGER) AS step, own,
        count(*) FILTER (failed & (own | before) = 0) AS kept,
        count(*) FILTER (failed & before = 0 AND failed & own <> 0) AS removed,
        count(*) FILTER (failed & before <> 0 AND failed & own <> 0) AS redundant,
        count(*) FILTER (failed = own) AS unique_fails,
        count(*) FILTER (failed & before = 0 AND failed & own <> 0 AND good = 1) AS good_lost,
        count(*) FILTER (failed & before = 0 AND failed & own <> 0 AND toxic = 1) AS toxic_lost
    FROM failed, steps GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""
