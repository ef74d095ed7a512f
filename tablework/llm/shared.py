"""What several operators of this folder need: tables in the shared folder, connected components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.storage import fresh_path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns every operator reads, whatever else a table carries; null text is empty."""
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    )


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS_PER_BATCH = 1000  # long rows: a batch is held several times on its way to Python and back
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """The same rows read back from a table in the shared folder. It cuts the lineage: a lost
    executor costs reading them again and not computing them again. Shuffle files of the write go as
    it ends, and not when the driver next collects its garbage."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    rows, free = spark.conf.get(ARROW_ROWS), spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(ARROW_ROWS, str(min(int(rows), TEXTS_PER_BATCH)))
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.set(ARROW_ROWS, rows)
        spark.conf.set(FREE_SHUFFLES, free)
    return spark.read.schema(df.schema).parquet(path)


FILTER_BITS = (16, 26)  # least and most, as powers of two: 8 KB to 8 MB
CHUNK_BITS = 16  # of a filter that one task sets: 8 KB


def _set_bits(chunk: pa.Table) -> pa.Table:
    marks = np.zeros(1 << CHUNK_BITS, bool)
    marks[chunk.column("place").to_numpy()] = True
    packed = np.packbits(marks, bitorder="little").tobytes()
    return pa.table({"chunk": chunk.column("chunk")[:1], "bits": pa.array([packed], pa.binary())})


def key_filter(table: DataFrame, key: str):
    """A filter over 64-bit keys of a written table, told to all tasks: it lets every one of them
    through, and of others about one in eight or fewer. It has eight bits per row up to its largest
    size; beyond that more others pass. It saves work and decides nothing. Tasks set its bits, and
    the driver puts the chunks together."""
    bits = min(FILTER_BITS[1], max(FILTER_BITS[0], (8 * table.count()).bit_length()))
    slot = F.col(key).bitwiseAND(F.lit((1 << bits) - 1))
    slots = table.select(slot.alias("slot")).distinct().select(
        F.shiftright("slot", CHUNK_BITS).alias("chunk"),
        F.col("slot").bitwiseAND(F.lit((1 << CHUNK_BITS) - 1)).alias("place"),
    )
    found = bytearray(1 << (bits - 3))
    for row in slots.groupBy("chunk").applyInArrow(_set_bits, "chunk long, bits binary").collect():
        at = row["chunk"] << (CHUNK_BITS - 3)
        found[at : at + len(row["bits"])] = row["bits"]
    return table.sparkSession.sparkContext.broadcast(np.frombuffer(bytes(found), np.uint8))


def passes(filter_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys & (8 * len(filter_) - 1)
    return (filter_[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected links ``(a, b)``: rows ``(node, component)``, where the
    component is the smallest node. Links from a node to itself keep it as a node of its own.

    Large-star and small-star steps in turn (Kiveris et al. 2014), on links kept from the larger node
    to the smaller: each hands the smallest neighbour of a node to the others, so every component
    becomes a star around its smallest node after about log(n) rounds. Minima are combined before
    the shuffle, and the join that hands a minimum to all neighbours of a hot node can be split; no
    list of neighbours is ever gathered. A round is one written table and one sum over it: the search
    ends when a round changes nothing.
    """
    nodes = edges.select("a").union(edges.select("b")).distinct()
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links, before = written(links.distinct(), "links"), None
    while True:
        now = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before or not now[0]:
            break
        before = now
        down = links.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("b"), "m")
        large = links.join(down, "b", "left").select("a", F.coalesce("m", "b").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = written(small.union(down.select("a", F.col("m").alias("b"))).distinct(), "links")
    return nodes.join(links, nodes["a"] == links["a"], "left").select(
        nodes["a"].alias("node"), F.coalesce(links["b"], nodes["a"]).alias("component")
    )
