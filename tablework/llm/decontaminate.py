"""Benchmark decontamination by SimHash windows.

Texts are read as words (runs of letters and digits, lower-cased). A window's SimHash is the
bitwise majority of the 64-bit hashes of its words. Windows are sized by the item: items of a size
class are looked for with windows of that class (16, 8, 4, 2 or 1 words). Documents are
fingerprinted at every ``step`` words, items at every word, so that any run of ``window + step - 1``
unchanged words has a document window inside that equals one of the item. A class is given only to
items whose passages at 75 % similarity must contain such a run:

* with n = words - 4 shingles, similarity 0.75 leaves at most n / 7 shingles broken;
* one changed word inside breaks 5 (an inserted one 4), so e changes need n >= 28 e and leave a run
  of at least (words - e) / (e + 1) words; changes at the ends shorten the run by n / 7 at most;
* so items from 39 words keep runs of 19 = 16 + 4 - 1, items from 15 words 11 = 8 + 4 - 1, and
  items from 4 words runs of 4.

The multi-index cuts each fingerprint into RADIUS + 1 blocks; fingerprints within RADIUS bits agree
in one block at least, so the join on blocks finds all of them. Each candidate tells where the item
would begin; the item-sized stretch there is compared with the item by its 5-word shingles,
weighted by how often they occur: sum of the smaller counts over sum of the larger ones.

The majority is computed for all 64 bits at once by adding bits in carry-save form, in functions of
the DataFrame API only. Items are broadcast in blocks of a fixed size, as many as it takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.llm.shared import documents, id_and_text, written

WORDS, PERCENT = 5, 75
RADIUS = 3
BLOCK_BITS = 64 // (RADIUS + 1)
CLASSES = [(16, 39, 4), (8, 15, 4), (4, 4, 1), (2, 2, 1), (1, 1, 1)]  # window, least words, step
BROADCAST_ROWS = 200_000  # of the items' index, about 60 bytes each


def _hashes(text):
    """Hashes of the words of a text."""
    words = F.array_remove(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), "")
    return F.transform(words, lambda x: F.xxhash64(x))


def _both(a, b):
    return a.bitwiseAND(b)


def _either(a, b):
    return a.bitwiseXOR(b)


def _carry(a, b, c):
    return _both(a, b).bitwiseOR(_both(c, _either(a, b)))


def _let(value, body):
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def _indexes(last):
    """0 ... last - 1; none if last is not above 0."""
    return F.when(last > 0, F.sequence(F.lit(0), last - 1)).otherwise(
        F.array().cast("array<int>")
    )


def _fours(hashes, step: int):
    """Per four neighbouring words, every ``step`` words: how many have each bit set."""

    def add(i):
        a, b, c, d = (F.get(hashes, i * step + k) for k in range(4))
        p, q, g, h = _either(a, b), _either(c, d), _both(a, b), _both(c, d)
        return F.struct(
            _either(p, q).alias("o"),
            _either(_either(g, h), _both(p, q)).alias("t"),
            _both(g, h).alias("f"),
        )

    n = F.floor((F.size(hashes) - 4) / step).cast("int") + 1
    return F.transform(_indexes(F.when(F.size(hashes) >= 4, n).otherwise(0)), add)


def _eights(fours, step: int):
    """The same for eight words: a four and the one that follows it."""
    shift = 4 // step

    def add(i):
        a, b = F.get(fours, i), F.get(fours, i + shift)
        to_two = _both(a["o"], b["o"])
        to_four = _carry(a["t"], b["t"], to_two)
        return F.struct(
            _either(a["o"], b["o"]).alias("o"),
            _either(_either(a["t"], b["t"]), to_two).alias("t"),
            _either(_either(a["f"], b["f"]), to_four).alias("f"),
            _carry(a["f"], b["f"], to_four).alias("e"),
        )

    return F.transform(_indexes(F.size(fours) - shift), add)


def _sixteens(eights, step: int):
    """Of sixteen words: the bits that eight or more have set."""
    shift = 8 // step

    def add(i):
        a, b = F.get(eights, i), F.get(eights, i + shift)
        to_four = _carry(a["t"], b["t"], _both(a["o"], b["o"]))
        to_eight = _carry(a["f"], b["f"], to_four)
        return a["e"].bitwiseOR(b["e"]).bitwiseOR(to_eight)

    return F.transform(_indexes(F.size(eights) - shift), add)


def _prints(hashes, wanted: list[tuple[int, int]]):
    """SimHashes of an array of word hashes: (window, place, print) for each wanted window length and
    step. Bits that half of the words have count as set. Lengths of one step share their counts."""
    found = []
    for step in sorted({step for _, step in wanted}):
        lengths = {window for window, own in wanted if own == step}
        if 1 in lengths:
            found.append(_marked(hashes, 1, step))
        if 2 in lengths:
            pairs = F.transform(
                _indexes(F.size(hashes) - 1),
                lambda i: F.get(hashes, i).bitwiseOR(F.get(hashes, i + 1)),
            )
            found.append(_marked(pairs, 2, step))
        if lengths & {4, 8, 16}:
            found.append(_let(_fours(hashes, step), _wide(step, lengths)))
    return F.concat(*found)


def _wide(step: int, lengths: set[int]):
    """The windows of 4, 8 and 16 words out of the counts of fours."""

    def of_eights(eights):
        own = []
        if 8 in lengths:
            own.append(_marked(F.transform(eights, lambda x: x["f"].bitwiseOR(x["e"])), 8, step))
        if 16 in lengths:
            own.append(_marked(_sixteens(eights, step), 16, step))
        return F.concat(*own)

    def of_fours(fours):
        own = []
        if 4 in lengths:
            own.append(_marked(F.transform(fours, lambda x: x["t"].bitwiseOR(x["f"])), 4, step))
        if lengths & {8, 16}:
            own.append(_let(_eights(fours, step), of_eights))
        return F.concat(*own)

    return of_fours


def _marked(prints, window: int, step: int):
    return F.transform(
        prints,
        lambda x, i: F.struct(
            F.lit(window).alias("window"), (i * step).alias("place"), x.alias("print")
        ),
    )


MARKED = "array<struct<window:int,place:int,print:bigint>>"


def window_fingerprints(rows: DataFrame, wanted: list[tuple[int, int]]) -> DataFrame:
    """``hashes`` of each row to one row per window, in a single pass for all wanted lengths and
    steps: its length, its place in words and its SimHash, beside the columns of ``rows``. The
    array is made in a step of its own, so that the explode does not copy the others per window.
    An explode of the bare column would infer a filter on it, which computes the array twice."""
    prints = F.coalesce("prints", F.array().cast(MARKED))
    return (
        rows.withColumn("prints", _let(F.col("hashes"), lambda x: _prints(x, wanted)))
        .select(*rows.columns, F.explode(prints).alias("w"))
        .select(*rows.columns, "w.window", "w.place", "w.print")
    )


def _block_keys():
    """Of a window of any class: one whole number per block of its fingerprint."""
    mask = (1 << BLOCK_BITS) - 1
    return F.array(
        *[
            F.expr(
                f"shiftleft(cast(window * {RADIUS + 1} + {b} as long), {BLOCK_BITS})"
                f" | (shiftrightunsigned(print, {b * BLOCK_BITS}) & {mask}L)"
            )
            for b in range(RADIUS + 1)
        ]
    )


def _size_class(words):
    found = F.lit(None).cast("int")
    for window, least, _ in reversed(CLASSES):
        found = F.when(words >= least, F.lit(window)).otherwise(found)
    return found


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """Items with an id and at least one word; those that share an id are told apart by text."""
    rows = benchmark.select(
        benchmark["item_id"].cast("long").alias("item_id"),
        F.coalesce(benchmark["text"].cast("string"), F.lit("")).alias("text"),
    ).where("item_id IS NOT NULL")
    rows = rows.distinct().select(
        "item_id", F.xxhash64("text").alias("item_hash"), _hashes("text").alias("hashes")
    )
    return rows.where("size(hashes) > 0").withColumn("n", F.size("hashes")).withColumn(
        "window", _size_class(F.col("n"))
    )


def _shingles(hashes, n):
    """Hashes of the 5-word runs of an array of n word hashes; of the whole if it is shorter."""
    many = _let(
        hashes,
        lambda h: F.transform(
            _indexes(n - (WORDS - 1)),
            lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WORDS)]),
        ),
    )
    return F.when(n >= WORDS, many).otherwise(F.array(F.xxhash64(hashes)))


def _counted(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    return rows.select(*keys, F.explode(_shingles(F.col("hashes"), F.size("hashes"))).alias("shingle")).groupBy(
        *keys, "shingle"
    ).agg(F.count("*").alias(name))


def _candidates(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Where items may begin in documents, with the stretch of word hashes that an item covers there:
    (doc_id, text_hash, item_id, item_hash, start, hashes). Items are looked for in blocks whose
    fingerprints are broadcast, as many as it takes; documents are not shuffled for it, and a pass
    over them serves all size classes."""
    used = {r["window"] for r in items.select("window").distinct().collect()}
    steps = [(window, step) for window, _, step in CLASSES if window in used]
    keys = ["doc_id", "text_hash", "item_id", "item_hash", "start"]
    own = window_fingerprints(
        items.withColumnRenamed("window", "class"), [(window, 1) for window, _ in steps]
    ).where(F.col("window") == F.col("class"))
    index = written(
        own.select(
            "item_id", "item_hash", "n", F.col("place").alias("offset"),
            F.col("print").alias("item_print"), F.explode(_block_keys()).alias("key"),
        ),
        "index",
    )
    blocks = max(1, -(-index.count() // BROADCAST_ROWS))
    block = F.pmod(F.xxhash64("item_id", "item_hash", "offset"), F.lit(blocks))
    found = None
    for i in range(blocks):
        probes = window_fingerprints(docs, steps).withColumn("key", F.explode(_block_keys()))
        near = probes.join(F.broadcast(index.where(block == i)), "key").where(
            F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS
        )
        start = F.col("place") - F.col("offset")
        near = near.withColumn("start", start).withColumn("first", F.greatest("start", F.lit(0)))
        near = near.where((F.col("start") + F.col("n") > 0) & (F.col("start") < F.size("hashes")))
        stretch = F.slice("hashes", F.col("first") + 1, F.col("start") + F.col("n") - F.col("first"))
        near = near.select(*keys, stretch.alias("hashes"))
        found = near if found is None else found.union(near)
    return found.dropDuplicates(keys)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Passages of ``docs`` that are benchmark items: one row per document and item with
    ``start`` and ``words`` of the best match (the first of equally good ones) and ``similarity``.
    Texts and items without words match nothing, nor do rows without doc_id or item_id; rows that
    repeat count once. No benchmark item, no row."""
    spark = docs.sparkSession
    rows = id_and_text(docs).where("doc_id IS NOT NULL").withColumn("text_hash", F.xxhash64("text"))
    items = written(benchmark_items(benchmark), "items")
    schema = (
        "doc_id long, item_id long, start long, words long, similarity double"
    )
    if items.isEmpty():
        return spark.createDataFrame([], schema)
    hashed = rows.select("doc_id", "text_hash", _hashes("text").alias("hashes"))
    windows = written(_candidates(hashed, items), "windows")
    keys = ["doc_id", "text_hash", "item_id", "item_hash", "start"]
    in_item = _counted(items, ["item_id", "item_hash"], "in_item")
    of_item = items.select("item_id", "item_hash", F.greatest(F.col("n") - (WORDS - 1), F.lit(1)).alias("n_item"))
    of_window = F.greatest(F.size("hashes") - (WORDS - 1), F.lit(1))
    same = (
        _counted(windows, keys, "in_window")
        .join(in_item, ["item_id", "item_hash", "shingle"])
        .groupBy(*keys).agg(F.sum(F.least("in_item", "in_window")).alias("same"))
    )
    scored = (
        same.join(windows.select(*keys, F.size("hashes").alias("words"), of_window.alias("n_window")), keys)
        .join(of_item, ["item_id", "item_hash"])
        .withColumn("all", F.col("n_item") + F.col("n_window") - F.col("same"))
        .where(F.col("same") * 100 >= F.col("all") * PERCENT)
    )
    best = scored.groupBy("doc_id", "item_id").agg(
        F.max(F.struct((F.col("same") / F.col("all")).alias("s"), (-F.col("start")).alias("at"), "words")).alias("best")
    )
    return best.select(
        "doc_id", "item_id", F.greatest(-F.col("best.at"), F.lit(0)).cast("long").alias("start"),
        F.col("best.words").cast("long").alias("words"), F.col("best.s").alias("similarity"),
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark passage; all columns."""
    found = written(contaminated(docs, benchmark).select("doc_id").distinct(), "contaminated")
    return docs.join(found, "doc_id", "left_anti").select(docs.columns)


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(
        documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    )
