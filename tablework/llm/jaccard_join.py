"""N-gram Jaccard self-join by token-combination prefixes.

A document's set holds its different 5-word shingles. Shingles are put into one order for all
documents: rare ones first, then those of frequent classes. If two sets of sizes n and m are at
least 75 % similar, either shares at least ceil(0.75 n) shingles with the other, so it misses at
most d = n - ceil(0.75 n). A prefix from which d missing shingles cannot remove every signature
therefore has a signature in common with the partner's prefix:

* a rare shingle is a signature by itself and takes one missing shingle to remove;
* k frequent shingles of class k make a signature together. Frequent shingles are dealt into small
  groups by hash, and combinations are taken within a group: i of them in a prefix take i - k + 1
  missing ones. The prefix is extended until d + 1 would be needed in all.

The number of groups follows the size level (the power of two below n), and a set also writes the
signatures of the next level where a partner may reach it, so both sides of a pair use the same
groups. Frequencies are counted over all documents; they steer the work and never the result.

Same sets count once. Within a signature the links go to one centre first; what they join needs no
further comparison. Only signatures that still hold different components are compared further: small
ones pair by pair; the documents that larger ones connect are dealt into chunks, and each two chunks
are compared in one task, which returns similar pairs alone. Every link is verified on the shingles of whole texts.

Before texts are fetched, sketches tell which sets cannot be similar: a shingle flips one of about as many
bits as the set has shingles, so two sketches differ in no more bits than the sets have shingles of their
own. Where they differ in more than a similar pair may, no text is read; what is left is verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.llm import words as W
from tablework.llm.shared import components, documents, id_and_text, key_filter, passes, written
from tablework.storage import remove_table

WORDS, PERCENT = 5, 75
RARE = 8  # fewer documents than this: a rare shingle
COMMON = 1024  # from so many documents on a shingle is of class 3
MOST_FREQUENT = 1 << 20  # frequent shingles that are told to all tasks, at most
PAIRED = 32  # signatures of at most so many sets are compared pair by pair, larger ones in blocks
SMALL_SET = 16  # smaller sets use single shingles only
CHUNK_SETS, CHUNK_SHINGLES = 256, 1 << 19  # sets and shingles of a chunk of a block, about
COUNT_ROWS = 1 << 18  # shingles that a task counts before it passes them on; it holds them six times over
BUCKET_SIZE = 4 << 20  # shingles counted at once after the shuffle, about
CHUNK_SKETCHES, SKETCHED_SHINGLES = 2048, 1 << 22  # sets and shingles of a chunk of sketches, about
LEAST_SKETCH = 64  # bits
SIGN_TURNS = 3  # signatures are grouped in so many turns; disk holds the shuffle of one

_K1, _K2 = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def set_key(tokens: np.ndarray) -> int:
    """A number that stands for the whole set, as a signed 64-bit value."""
    total = np.bitwise_xor.reduce(W.mix(tokens ^ _K1)) + np.add.reduce(W.mix(tokens ^ _K2))
    return int(np.int64(W.mix(np.array([total + np.uint64(len(tokens))], np.uint64)).view(np.int64)[0]))


def sketch(tokens: np.ndarray) -> bytes:
    """For each of some bits, a power of two, whether an odd number of the set's shingles falls on it."""
    size = max(LEAST_SKETCH, 1 << (len(tokens) - 1).bit_length())
    counts = np.bincount(((tokens >> np.uint64(8)) & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def least_unlike(one: bytes, two: bytes) -> int:
    """Of the shingles that only one of two sets has, there are at least so many. A longer sketch is
    folded to the size of the other: its halves, one flipped by the other, are the sketch of half the size."""
    if len(one) < len(two):
        one, two = two, one
    a, bits = int.from_bytes(one, "little"), 8 * len(one)
    while bits > 8 * len(two):
        bits //= 2
        a = (a >> bits) ^ (a & ((1 << bits) - 1))
    return (a ^ int.from_bytes(two, "little")).bit_count()


def _may_be_similar(unlike, shingles):
    """Whether two sets with so many shingles together can be similar, if only one of them has ``unlike``."""
    return (100 + PERCENT) * unlike <= (100 - PERCENT) * shingles


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            sizes, keys, sketches = [], [], []
            for part in W.parts(batch.column("text")):
                for tokens in W.shingle_sets(W.words(part), WORDS):
                    sizes.append(len(tokens))
                    keys.append(set_key(tokens) if len(tokens) else 0)
                    sketches.append(sketch(tokens) if len(tokens) else b"")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()),
                    pa.array(sketches, pa.binary()),
                ],
                ["doc_id", "n_shingles", "key", "sketch"],
            )


def count_bucket_rows(tokens: list[np.ndarray], bits: int) -> pa.RecordBatch:
    """Shingles counted in this task: per bucket those seen once, the others, and their counts."""
    short = np.concatenate(tokens) >> np.uint64(32 - bits)
    short, counts = np.unique(short, return_counts=True)
    bucket, rest = (short >> np.uint64(32)).astype(np.int64), short.astype(np.uint32)
    edges = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
    rows = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        once = counts[a:b] == 1
        rows.append(
            (
                int(bucket[a]),
                rest[a:b][once].tobytes(),
                rest[a:b][~once].tobytes(),
                counts[a:b][~once].astype(np.uint32).tobytes(),
            )
        )
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])],
        ["bucket", "once", "more", "counts"],
    )


def _token_counts(bits: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            held, size = [], 0
            for batch in batches:
                for part in W.parts(batch.column("text")):
                    for tokens in W.shingle_sets(W.words(part), WORDS):
                        if len(tokens):
                            held.append(tokens)
                            size += len(tokens)
                    if size >= COUNT_ROWS:
                        yield count_bucket_rows(held, bits)
                        held, size = [], 0
            if held:
                yield count_bucket_rows(held, bits)

    return count


def frequent_of_bucket(least: int):
    def total(frame: pd.DataFrame) -> pd.DataFrame:
        tokens = np.concatenate(
            [np.frombuffer(x, np.uint32) for c in ("once", "more") for x in frame[c]]
        )
        singles = sum(map(len, frame["once"])) // 4
        counts = np.ones(len(tokens), np.int64)
        counts[singles:] = np.concatenate(
            [np.frombuffer(x, np.uint32) for x in frame["counts"]]
        )
        order = np.argsort(tokens, kind="stable")
        tokens, counts = tokens[order], counts[order]
        first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
        sums = np.add.reduceat(counts, first)
        often = sums >= least
        short = (int(frame["bucket"].iloc[0]) << 32) + tokens[first][often].astype(np.int64)
        return pd.DataFrame({"short": short, "count": sums[often]})

    return total


def frequent_shingles(docs: DataFrame, total: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Bits of the bucket number, and the shortened hashes and classes of frequent shingles.

    All shingles of all documents are counted. Where more than MOST_FREQUENT are frequent, the
    least count is doubled until they are not, so what every task is told has a fixed bound."""
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = min(31, max(2 * width - 1, total // BUCKET_SIZE).bit_length())
    rows = docs.select("text").mapInArrow(
        _token_counts(bits), "bucket long, once binary, more binary, counts binary"
    )
    counts = written(
        rows.groupBy("bucket").applyInPandas(frequent_of_bucket(RARE), "short long, count long"),
        "frequent",
    )
    powers = counts.groupBy(F.floor(F.log2("count")).alias("power")).count().collect()
    least = RARE
    while sum(r["count"] for r in powers if 2 ** r["power"] >= least) > MOST_FREQUENT:
        least *= 2
    rows = counts.where(F.col("count") >= least).toPandas().sort_values("short")
    return (
        bits,
        rows["short"].to_numpy(np.int64).astype(np.uint64),
        np.where(rows["count"].to_numpy() >= COMMON, 3, 2).astype(np.int8),
    )


def _combinations(tokens: np.ndarray, group: np.ndarray, k: int, salt: int) -> list[np.ndarray]:
    """Signatures of all k tokens (k = 2 or 3) of the same group; tokens come sorted by group."""
    found, n = [], len(tokens)
    salted = W.mix(tokens ^ np.uint64(salt * 0x51ED27 + k))
    for i in range(1, n):
        near = np.flatnonzero(group[i:] == group[:-i])
        if not len(near):
            break
        two = W.mix(salted[near] * _K1 + salted[near + i])
        if k == 2:
            found.append(two)
            continue
        for j in range(1, n):
            at = np.flatnonzero(near + i + j < n)
            at = at[group[near[at] + i + j] == group[near[at]]]
            if not len(at):
                break
            found.append(W.mix(two[at] * _K2 + salted[near[at] + i + j]))
    return found


def signatures(tokens: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Signatures of one set: sorted hashes, and 0 for rare ones or else their class."""
    n = len(tokens)
    need = n - (PERCENT * n + 99) // 100 + 1
    levels = {n.bit_length() - 1, ((100 * n) // PERCENT).bit_length() - 1}
    found = []
    if n < SMALL_SET:
        found.append(W.mix(tokens[:need] ^ _K2))
    high = [x for x in levels if 1 << x >= SMALL_SET]
    if high:
        rare = tokens[classes == 0]
        found.append(W.mix(rare[:need] ^ _K1))
        missing = need - len(rare)
        for level in high if missing > 0 else ():
            left = missing
            for k, small in ((2, 3), (3, 2)):
                own = tokens[classes == k]
                if left <= 0 or not len(own):
                    continue
                group = W.mix(own + np.uint64(k)) & np.uint64((1 << (level - small)) - 1)
                order = np.argsort(group, kind="stable")
                own, group = own[order], group[order]
                begin = np.append(True, group[1:] != group[:-1])
                rank = np.arange(len(own)) - np.maximum.accumulate(
                    np.where(begin, np.arange(len(own)), 0)
                )
                worth = np.cumsum(rank >= k - 1)
                end = int(np.searchsorted(worth, left)) + 1
                found += _combinations(own[:end], group[:end], k, level)
                left -= int(worth[-1])
    return np.unique(np.concatenate(found))


def _signature_sets(shared, bits: int):
    """Rows (key, signs): a set and all its signatures."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short, kind = shared.value
        with np.errstate(over="ignore"):
            for batch in batches:
                for part in W.parts(batch.column("text")):
                    signs, sizes, keys = [], [0], []
                    for tokens in W.shingle_sets(W.words(part), WORDS):
                        if not len(tokens):
                            continue
                        classes = np.zeros(len(tokens), np.int8)
                        if len(short):
                            cut = tokens >> np.uint64(32 - bits)
                            at = np.minimum(np.searchsorted(short, cut), len(short) - 1)
                            classes = np.where(short[at] == cut, kind[at], 0)
                        own = signatures(tokens, classes)
                        signs.append(own)
                        sizes.append(len(own))
                        keys.append(set_key(tokens))
                    if signs:
                        ends = pa.array(np.cumsum(sizes).astype(np.int32))
                        signs = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(signs).view(np.int64)))
                        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), signs], ["key", "signs"])

    return sign


def _needed_signatures(needed):
    """Rows (sign, key) of the signatures that this filter lets through."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs = batch.column("signs")
            sizes, own = signs.value_lengths().to_numpy(), signs.flatten().to_numpy()
            good = passes(needed.value, own)
            keys = np.repeat(batch.column("key").to_numpy(), sizes)
            yield pa.RecordBatch.from_arrays([pa.array(own[good]), pa.array(keys[good])], ["sign", "key"])

    return keep


def _needed_texts(needed):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        with np.errstate(over="ignore"):
            for batch in batches:
                good = passes(needed.value, batch.column("slot").to_numpy())
                texts = batch.column("text").filter(pa.array(good))
                keys, packed = [], []
                for part in W.parts(texts):
                    for i, tokens in enumerate(W.shingle_sets(W.words(part), WORDS)):
                        if len(tokens):
                            keys.append(set_key(tokens))
                            packed.append(pack(part.text(i)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(packed, pa.binary())], ["key", "packed"]
                )

    return keep


def texts_of(docs: DataFrame, sets: DataFrame, keys: DataFrame) -> DataFrame:
    """A compressed text for each of the sets named in ``keys``. Of the documents, only those that
    ``sets`` names for them are looked at, and a few more that a filter lets through."""
    ids = written(sets.join(keys, "key").select("key", F.xxhash64("doc_id").alias("slot")), "ids")
    rows = docs.select("text", F.xxhash64("doc_id").alias("slot")).mapInArrow(
        _needed_texts(key_filter(ids, "slot")), "key long, packed binary"
    )
    return rows.join(ids, "key", "left_semi").groupBy("key").agg(F.min("packed").alias("packed"))


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, kept = None, None
    with np.errstate(over="ignore"):
        for batch in batches:
            good = []
            one, two = batch.column("packed_a"), batch.column("packed_b")
            for i in range(batch.num_rows):
                a = one[i].as_py()
                if a != last:
                    last, kept = a, _tokens(a)
                b = _tokens(two[i].as_py())
                same = len(np.intersect1d(kept, b, assume_unique=True))
                good.append(100 * same >= PERCENT * (len(kept) + len(b) - same))
            yield batch.filter(pa.array(good, pa.bool_())).select(["a", "b"])


def _tokens(packed: bytes) -> np.ndarray:
    text = zstandard.ZstdDecompressor().decompress(packed).decode()
    return W.shingle_sets(W.words(next(W.parts(pa.array([text])))), WORDS)[0]


def _similar_in_block(block: pa.Table) -> pa.Table:
    """Similar pairs between the two chunks of a block, or within its only one; of those, as many
    as connect what all of them connect."""
    with np.errstate(over="ignore"):
        sets = [_tokens(x) for x in block.column("packed").to_pylist()]
    ids, own = block.column("key").to_numpy(), block.column("own").to_numpy()
    sizes = np.array([len(x) for x in sets])
    single = block.column("i")[0].as_py() == block.column("j")[0].as_py()
    right = np.arange(len(ids)) if single else np.flatnonzero(own == own.max())
    left = np.arange(len(ids)) if single else np.flatnonzero(own != own.max())
    tokens = np.concatenate([sets[i] for i in right]) if len(right) else np.zeros(0, np.uint64)
    holder = np.repeat(right, sizes[right])
    order = np.argsort(tokens, kind="stable")
    tokens, holder = tokens[order], holder[order]
    pairs, root = [], list(range(len(ids)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for i in left.tolist():
        low = np.searchsorted(tokens, sets[i], "left")
        many = np.searchsorted(tokens, sets[i], "right") - low
        at = np.repeat(low - np.append(0, np.cumsum(many)[:-1]), many) + np.arange(many.sum())
        same = np.bincount(holder[at], minlength=len(ids))
        good = 100 * same >= PERCENT * (sizes[i] + sizes - same)
        for j in np.flatnonzero(good & (ids != ids[i]) & (same > 0)).tolist():
            if top(i) != top(j):
                root[top(i)] = top(j)
                pairs.append((int(ids[i]), int(ids[j])))
    return pa.table(
        {"a": pa.array([x[0] for x in pairs], pa.int64()), "b": pa.array([x[1] for x in pairs], pa.int64())}
    )


def _may_be_similar_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        one, two = (batch.column(c).to_pylist() for c in ("sketch_a", "sketch_b"))
        unlike = np.array([least_unlike(x, y) for x, y in zip(one, two)], np.int64)
        good = _may_be_similar(unlike, batch.column("n").to_numpy() + batch.column("m").to_numpy())
        yield batch.filter(pa.array(good)).select(["a", "b"])


def possible(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets without those that their sketches rule out."""
    one = sets.select(F.col("key").alias("a"), F.col("n_shingles").alias("n"), F.col("sketch").alias("sketch_a"))
    two = sets.select(F.col("key").alias("b"), F.col("n_shingles").alias("m"), F.col("sketch").alias("sketch_b"))
    both = pairs.join(two, "b").join(one, "a").select("a", "b", "n", "m", "sketch_a", "sketch_b")
    return both.mapInArrow(_may_be_similar_pairs, "a long, b long")


def verified(docs: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of pairs (a, b) of sets those that are similar enough."""
    pairs = written(possible(sets, pairs), "possible")
    keys = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    texts = written(texts_of(docs, sets, keys), "texts")
    one = texts.toDF("a", "packed_a")
    two = texts.toDF("b", "packed_b")
    found = written(
        pairs.join(two, "b").join(one, "a").select("a", "b", "packed_a", "packed_b")
        .mapInArrow(_similar, "a long, b long"),
        "similar",
    )
    remove_table(texts)
    return found


def _still_apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of signatures that hold more than one component: sign, key, n_shingles, own (the
    component), members (of the signature) and least (the smallest key among them)."""
    now = members.join(labels, members["key"] == labels["node"], "left").select(
        members["*"], F.coalesce("component", "key").alias("own")
    )
    apart = now.groupBy("sign").agg(
        F.min("own").alias("low"), F.max("own").alias("high"), F.count("*").alias("members"),
        F.min("key").alias("least"),
    )
    return now.join(apart.where("low <> high").drop("low", "high"), "sign")


def _clusters(apart: DataFrame) -> DataFrame:
    """Sets that signatures connect: key, n_shingles, label (the component) and the cluster's smallest key."""
    ties = written(apart.select(F.col("key").alias("a"), F.col("least").alias("b")).distinct(), "ties")
    sizes = apart.select("key", "n_shingles", F.col("own").alias("label")).distinct()
    return components(ties).join(sizes, F.col("node") == F.col("key")).select(
        "key", "n_shingles", "label", F.col("component").alias("cluster")
    )


def _in_blocks(members: DataFrame, sets: int, shingles: int) -> DataFrame:
    """Members of clusters, dealt into chunks of about so many sets and shingles, each once for every
    block of two chunks (i, j) that its chunk (own) is part of."""
    chunks = members.groupBy("cluster").agg(
        F.greatest(F.ceil(F.count("*") / sets), F.ceil(F.sum("n_shingles") / shingles))
        .cast("long").alias("chunks")
    )
    return (
        members.join(chunks, "cluster")
        .withColumn("own", F.pmod(F.xxhash64("key"), "chunks"))
        .withColumn("other", F.explode(F.expr("sequence(0L, chunks - 1)")))
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .drop("chunks", "other")
    )


def _sketches_by_size(places: np.ndarray, sketches: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per size in bytes of a sketch: which of these sets have one that long, and a row of words for each."""
    sizes, found = np.array([len(sketches[i]) for i in places.tolist()], np.int64), {}
    for size in np.unique(sizes).tolist():
        own = places[sizes == size]
        words = np.frombuffer(b"".join([sketches[i] for i in own.tolist()]), np.uint64)
        found[size] = own, words.reshape(len(own), size // 8)
    return found


def _folded(words: np.ndarray, size: int) -> np.ndarray:
    while 8 * words.shape[-1] > size:
        half = words.shape[-1] // 2
        words = words[..., :half] ^ words[..., half:]
    return words


def _possible_in_block(block: pa.Table) -> pa.Table:
    """Sets of a block that may be similar to one of the other chunk, or of its only one, which is
    not yet of the same component."""
    keys, own, labels, n = (block.column(c).to_numpy() for c in ("key", "own", "label", "n_shingles"))
    sketches = block.column("sketch").to_pylist()
    single = block.column("i")[0].as_py() == block.column("j")[0].as_py()
    left = np.arange(len(keys)) if single else np.flatnonzero(own != own.max())
    right = np.arange(len(keys)) if single else np.flatnonzero(own == own.max())
    found, right = np.zeros(len(keys), bool), _sketches_by_size(right[np.argsort(n[right], kind="stable")], sketches)
    for i in left.tolist():
        mine = np.frombuffer(sketches[i], np.uint64)
        for size, (others, words) in right.items():
            low = np.searchsorted(n[others], PERCENT * n[i] // 100, "left")
            high = np.searchsorted(n[others], 100 * n[i] // PERCENT, "right")
            if low >= high:
                continue
            least = min(size, len(sketches[i]))
            unlike = np.bitwise_count(_folded(words[low:high], least) ^ _folded(mine, least)).sum(1, dtype=np.int64)
            others = others[low:high]
            good = others[_may_be_similar(unlike, n[others] + n[i]) & (labels[others] != labels[i])]
            found[good] = True
            found[i] |= len(good) > 0
    return pa.table({"key": pa.array(keys[found], pa.int64())})


def _links_within(docs: DataFrame, sets: DataFrame, members: DataFrame) -> DataFrame:
    """Similar pairs of a cluster that connect its components, found in blocks. A cluster is dealt into chunks of
    bounded size, and each two chunks meet in one task. Sketches meet first; of the sets that they leave, texts
    do, and shared shingles are counted by postings. What leaves a task is a forest over the similar pairs."""
    sketched = _in_blocks(members, CHUNK_SKETCHES, SKETCHED_SHINGLES).join(sets.select("key", "sketch"), "key")
    left = sketched.groupBy("cluster", "i", "j").applyInArrow(_possible_in_block, "key long").distinct()
    members = written(members.join(left, "key", "left_semi"), "possible")
    placed = _in_blocks(members.select("key", "n_shingles", "cluster"), CHUNK_SETS, CHUNK_SHINGLES)
    placed = placed.drop("n_shingles")
    texts = written(texts_of(docs, sets, members.select("key").distinct()), "texts")
    found = written(
        placed.join(texts, "key")
        .groupBy("cluster", "i", "j")
        .applyInArrow(_similar_in_block, "a long, b long"),
        "similar",
    )
    remove_table(texts)
    return found


def shared_signatures(signed: DataFrame) -> DataFrame:
    """Signatures of more than one set: sign, low and high (the smallest and largest key) and rows.
    Nearly all signatures have one set and end here. Each turn takes its share of the signatures."""
    signs, groups = signed.select(F.explode("signs").alias("sign"), "key"), None
    for turn in range(SIGN_TURNS):
        own = signs.where(F.pmod("sign", F.lit(SIGN_TURNS)) == turn).groupBy("sign").agg(
            F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("rows")
        )
        own = written(own.where("low <> high"), "signatures")
        groups = own if groups is None else groups.union(own)
    return groups


def _same_document(rows: DataFrame) -> DataFrame:
    """Links between the sets of a doc_id that several rows with unlike texts share."""
    own = rows.where("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id", "key")
    several = own.groupBy("doc_id").agg(F.min("key").alias("a"), F.max("key").alias("high"))
    several = several.where("a <> high").select("doc_id", "a")
    return own.join(several, "doc_id").where("key <> a").select("a", F.col("key").alias("b"))


def linked_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, n_shingles, key)`` of every row, and ``(key, n_shingles, component_id)`` of every
    set that is not empty."""
    spark = docs.sparkSession
    docs = id_and_text(docs)
    rows = written(
        docs.mapInArrow(_classes, "doc_id long, n_shingles long, key long, sketch binary"), "classes"
    )
    sets = written(
        rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("key", "n_shingles")
        .agg(F.min("doc_id").alias("doc_id"), F.min("sketch").alias("sketch")),
        "sets",
    )
    rows = rows.drop("sketch")
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    if not total:
        return rows, sets.drop("sketch").withColumnRenamed("doc_id", "component_id")
    bits, short, kind = frequent_shingles(docs, total)
    shared = spark.sparkContext.broadcast((short, kind))
    texts = docs.where("doc_id IS NOT NULL").select("text")
    # Found once and read twice: to find them costs more than to keep them.
    signed = written(texts.mapInArrow(_signature_sets(shared, bits), "key long, signs array<long>"), "signed")
    groups = shared_signatures(signed)
    small = groups.where("rows = 2").select(F.col("low").alias("a"), F.col("high").alias("b"))
    large = groups.where("rows > 2").select("sign")
    needed = key_filter(large, "sign")
    signs = signed.mapInArrow(_needed_signatures(needed), "sign long, key long")
    named = sets.select("key", "n_shingles")
    members = written(
        signs.join(large, "sign", "left_semi").distinct()  # one shuffle, by signature, does for both
        .join(named, "key").select("sign", "key", "n_shingles"),
        "members",
    )
    remove_table(signed)
    near = "4 * least(n, m) >= 3 * greatest(n, m)"
    pairs = small.distinct().join(named.toDF("a", "n"), "a").join(named.toDF("b", "m"), "b")
    centres = members.groupBy("sign").agg(F.min(F.struct("key", "n_shingles")).alias("best"))
    centres = centres.select("sign", F.col("best.key").alias("a"), F.expr("best.n_shingles AS n"))
    stars = members.join(centres, "sign").where("key <> a")
    pairs = pairs.select("a", "b", "n", "m").union(
        stars.select("a", F.col("key").alias("b"), "n", F.col("n_shingles").alias("m"))
    )
    pairs = pairs.where(near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = verified(docs, sets, pairs.distinct()).union(_same_document(rows))
    links = written(links, "joined")
    labels = written(components(links), "labels")
    apart = written(_still_apart(members, labels), "apart")
    few = apart.where(F.col("members") <= PAIRED)
    if not few.isEmpty():
        one = few.select("sign", F.col("key").alias("a"), F.col("n_shingles").alias("n"), F.col("own").alias("other"))
        pairs = few.withColumnsRenamed({"key": "b", "n_shingles": "m"}).join(one, "sign")
        pairs = pairs.where("a < b AND own <> other").where(near).select("a", "b").distinct()
        links = written(links.union(verified(docs, sets, pairs)), "joined")
        labels = written(components(links), "labels")
    many = members.join(apart.where(F.col("members") > PAIRED).select("sign").distinct(), "sign")
    many = written(_still_apart(many, labels), "apart")
    if not many.isEmpty():
        links = written(links.union(_links_within(docs, sets, written(_clusters(many), "clusters"))), "joined")
        labels = written(components(links), "labels")
    found = written(
        sets.join(labels, sets["key"] == labels["node"], "left").select(
            "key", "n_shingles", "doc_id", F.coalesce("component", "key").alias("component")
        ),
        "components",
    )
    least = found.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return rows, written(found.join(least, "component").select("key", "n_shingles", "component_id"), "classes")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the smallest doc_id that
    links reach). Empty texts have no shingles and are their own component; repeated rows and
    equal texts share one; rows that share a doc_id are one document, linked by any of its texts; a
    row without doc_id is linked with nothing and has no component."""
    rows, found = linked_classes(docs)
    found = found.select(
        F.col("key").alias("k"), F.col("n_shingles").alias("n"), "component_id"
    )
    own = rows["doc_id"].isNotNull() & (rows["n_shingles"] > 0)
    return rows.join(
        found, own & (rows["key"] == found["k"]) & (rows["n_shingles"] == found["n"]), "left"
    ).select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without those that are linked to one with a smaller doc_id; all columns."""
    found = written(
        jaccard_components(docs).select("doc_id", "component_id").where("doc_id <> component_id").distinct(),
        "dropped",
    )
    return docs.join(found.select("doc_id"), "doc_id", "left_anti").select(docs.columns)


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))
