"""Substring dedup: paragraph MinHash banding for similar passages, content-cut windows for equal ones.

A paragraph is a line of MIN_WORDS words or more. Lines of over LONG_WORDS words are cut where the hash
of a run of CUT_WORDS words is the smallest of LONG_WORDS neighbouring runs, so that the cuts depend on
nothing else and pieces have at most LONG_WORDS words, half of that on average. BANDS bands of ROWS
MinHashes over a paragraph's 5-word shingles are joined: at a similarity of 0.75 two paragraphs meet
in a band with probability 1 - (1 - 0.75 ** 2) ** 5 = 0.98 (measured: see README). The paragraphs of
a band come together once, with their texts. A task joins what it finds similar by exact Jaccard
similarity of the shingles, and passes on a forest of links; a band of more than CHUNK different
paragraphs is dealt into chunks, of which each two meet. One search for components follows. All but
the first place of a component goes, cut at both ends to what it shares with its partners.

Equal passages need not be whole paragraphs. Of each CUT_SPAN neighbouring runs of CUT_WORDS words the
one with the smallest hash makes a cut. A window goes from each cut to the first one at least
WINDOW_WORDS words on, and to each cut from the last one so far before it; windows overlap, and every
word of a text of STRETCH_WORDS words lies in one. A passage of 3 * CUT_SPAN + WINDOW_WORDS + CUT_WORDS
- 3 = 32 words holds a whole window that does not depend on what stands around it: at most
CUT_SPAN - 1 words before its first cut and CUT_SPAN + CUT_WORDS - 1 after its last one are outside such
windows. So that whole lines and texts have no such rest, further windows go from the start of each
line to a cut and from a cut to its end. Two windows are the same if their 64-bit hashes and numbers
of words are.

Windows are first counted by 32 bits of their hashes and a bucket number; only those that may be
repeated are written with their places. Places are narrow rows; neither texts nor all windows are
shuffled. What is repeated in a document is put together by one task in the order of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.llm import words as W
from tablework.llm.jaccard_join import BUCKET_SIZE, COUNT_ROWS, WORDS, count_bucket_rows, frequent_of_bucket
from tablework.llm.shared import components, documents, id_and_text, key_filter, passes, written

PERCENT = 75
MIN_WORDS, LONG_WORDS = 12, 100
BANDS, ROWS = 5, 2
CUT_WORDS, CUT_SPAN = 3, 8
WINDOW_WORDS = 8
GAP_WORDS = 2 * CUT_SPAN + CUT_WORDS - 1  # one changed word can part equal windows by so many
STRETCH_WORDS = 20  # neighbours at most GAP_WORDS apart count together; fewer repeated words stay
PAIRED = 32  # paragraphs that are compared pair by pair; more of them by postings
CHUNK = 2048  # different paragraphs of a band that a task compares
PART_BYTES = 512 << 10  # text at once

# doc: hash of the text, which tells rows of one doc_id apart. before and after are code points
# between the place and the words next to it, or -1 at the ends of a text.
PLACES = "key long, doc_id long, doc long, word int, words int, start long, end long, before int, after int"
LINES = "starts array<int>, ends array<int>"  # of paragraphs alone
PASSAGES = "doc_id long, start long, end long, words long, first_doc_id long, removed boolean"

_SEEDS = W.mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_WINDOW = np.uint64(0x8EBC6AF09C88C6E3)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(int(_BASE), -1, 2**64))


def _sliding(values: np.ndarray, least, span: int) -> np.ndarray:
    """``least`` (minimum or maximum) of ``span`` neighbours, span - 1 fewer than values."""
    size = 1
    while size < span:
        step = min(size, span - size)
        values = least(values[:-step], values[step:])
        size += step
    return values


def cuts(found: W.Words, span: int = CUT_SPAN) -> np.ndarray:
    """Words before which a text is cut: those whose run of CUT_WORDS words has the smallest hash of
    ``span`` neighbouring runs of a row. Of equal smallest ones all are cuts."""
    runs = W.mix(W.runs(found.hashes, CUT_WORDS)) | np.uint64(1)
    if len(runs) < span:
        return np.zeros(0, np.int64)
    low = _sliding(runs, np.minimum, span)
    stop = np.repeat(found.rows[1:], np.diff(found.rows))
    at = np.arange(len(low))
    low[at + span + CUT_WORDS - 1 > stop[: len(low)]] = 0
    none = np.zeros(span - 1, np.uint64)
    return np.flatnonzero(_sliding(np.concatenate([none, low, none]), np.maximum, span) == runs)


def _union(n: int, *some: np.ndarray) -> np.ndarray:
    """The different ones of numbers from 0 to n, in order."""
    mark = np.zeros(n + 1, bool)
    for numbers in some:
        mark[numbers] = True
    return np.flatnonzero(mark)


def _set(values: np.ndarray) -> np.ndarray:
    """The different values, in order."""
    values = np.sort(values)
    new = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return values[new]


def _edges(part: W.Part, found: W.Words) -> np.ndarray:
    """Words that begin a line, and the number of words."""
    after = np.searchsorted(found.starts, np.flatnonzero(part.data == 10))
    return _union(len(found.starts), after, found.rows)


def paragraphs(part: W.Part, found: W.Words | None = None) -> tuple[W.Words, np.ndarray, np.ndarray]:
    """The words of a part, and the first and last + 1 word of each paragraph long enough."""
    found = found or W.words(part)
    if not len(found.starts):
        return found, np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = _edges(part, found)
    inner = cuts(found, LONG_WORDS)
    line = np.searchsorted(edge, inner, "right") - 1
    size = np.diff(edge)
    inner = inner[size[np.minimum(line, len(size) - 1)] > LONG_WORDS]
    edge = _union(len(found.starts), edge, inner)
    first, last = edge[:-1], edge[1:]
    long_ = last - first >= MIN_WORDS
    return found, first[long_], last[long_]


def windows(part: W.Part) -> tuple[W.Words, np.ndarray, np.ndarray, np.ndarray]:
    """The words of a part, first and last + 1 word of each window, and the windows' keys."""
    found = W.words(part)
    n = len(found.starts)
    cut = cuts(found)
    if not len(cut):
        return found, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = _edges(part, found)
    stop = np.repeat(found.rows[1:], np.diff(found.rows))
    begin = _union(n, cut, edge[:-1])
    to = np.append(cut, n)[np.searchsorted(cut, begin + WINDOW_WORDS)]
    to = np.minimum(to, stop[begin])  # no further cut: to the end of the text
    end = _union(n, cut, edge[1:])
    back = np.searchsorted(cut, end - WINDOW_WORDS, "right") - 1
    first = np.append(begin, cut[back])
    last = np.append(to, np.where(back < 0, 0, end))
    good = (last - first >= WINDOW_WORDS) & (last <= stop[first])
    first, last = np.divmod(_set(first[good] * (n + 1) + last[good]), n + 1)
    return found, first, last, _text_keys(found, first, last)


def _text_keys(found: W.Words, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of runs of words and their numbers of words."""
    n = len(found.starts)
    sums = np.append(np.uint64(0), np.cumsum(W.mix(found.hashes + _WINDOW) * W.powers(_BASE, n)))
    keys = (sums[last] - sums[first]) * W.powers(_UNBASE, n)[first]
    return W.mix(keys + W.mix((last - first).astype(np.uint64))).view(np.int64)


# Similar paragraphs


def _from_to(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges in a row, and where each range's begin and the last ones end."""
    sizes = last - first
    at = np.append(0, np.cumsum(sizes)).astype(np.int64)
    return np.arange(at[-1]) + np.repeat(first - at[:-1], sizes), at


def _shingles(found: W.Words, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all paragraphs in a row, and where each paragraph's begin."""
    every = W.runs(found.hashes, WORDS)
    places, at = _from_to(first, last - (WORDS - 1))
    return every[places], at[:-1]


def band_keys(tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Band hashes of paragraphs, (paragraphs, BANDS)."""
    low = [np.minimum.reduceat(W.mix(tokens ^ seed), at) for seed in _SEEDS]
    bands = []
    for b in range(BANDS):
        h = np.full(len(at), b + 1, np.uint64)
        for r in range(ROWS):
            h = W.mix(h * np.uint64(0xA24BAED4963EE407) + low[b * ROWS + r])
        bands.append(h)
    return np.column_stack(bands).view(np.int64)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bands of the different paragraphs of each part."""
    with np.errstate(over="ignore"):
        for batch in batches:
            for part in W.parts(batch.column("text"), PART_BYTES):
                found, first, last = paragraphs(part)
                keys, one = np.unique(_text_keys(found, first, last), return_index=True)
                if len(keys):
                    bands = band_keys(*_shingles(found, first[one], last[one]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bands.ravel()), pa.array(np.repeat(keys, BANDS))], ["band", "key"]
                    )


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(values))


def _members(needed):
    """Paragraphs with a band that the filter lets through: these bands, key and text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[int] = set()
        with np.errstate(over="ignore"):
            for batch in batches:
                for part in W.parts(batch.column("text"), PART_BYTES):
                    found, first, last = paragraphs(part)
                    keys, one = np.unique(_text_keys(found, first, last), return_index=True)
                    if not len(keys):
                        continue
                    first, last = first[one], last[one]
                    bands = band_keys(*_shingles(found, first, last))
                    good = passes(needed.value, bands)
                    if len(told) > 500_000:
                        told.clear()
                    some = [i for i in np.flatnonzero(good.any(axis=1)).tolist() if int(keys[i]) not in told]
                    told.update(keys[some].tolist())
                    raw = part.data.tobytes()
                    a, z = found.starts[first[some]].tolist(), found.ends[last[some] - 1].tolist()
                    yield pa.RecordBatch.from_arrays(
                        [
                            _lists(bands[some][good[some]], good[some].sum(axis=1)),
                            pa.array(keys[some], pa.int64()),
                            pa.array([raw[x:y] for x, y in zip(a, z)], pa.binary()),
                        ],
                        ["bands", "key", "text"],
                    )

    return rows


def _held(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Which values of the first are in the second, a sorted set."""
    return two.take(np.searchsorted(two, one), mode="clip") == one


def _shared(runs: np.ndarray, other: np.ndarray) -> tuple[int, int]:
    """First and last + 1 word of what a paragraph with these shingles shares with another set."""
    hit = np.flatnonzero(_held(runs, other))
    return int(hit[0]), int(hit[-1]) + WORDS


def similar(one: np.ndarray, two: np.ndarray) -> bool:
    """Whether two sorted sets have a Jaccard similarity of PERCENT or more."""
    if min(len(one), len(two)) * 100 < PERCENT * max(len(one), len(two)):
        return False
    same = np.count_nonzero(_held(one, two))
    return 100 * same >= PERCENT * (len(one) + len(two) - same)


def forest(sets: list[np.ndarray], chunk: list[int]) -> list[tuple[int, int]]:
    """Similar pairs that connect all that similar pairs connect. Of pairs of two chunks if there
    are two. The first set is compared with all others; what is left, pair by pair or, if there are
    more than PAIRED, by a count of shared shingles over postings."""
    root = list(range(len(sets)))
    pairs, two = [], len(set(chunk)) > 1

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    def join(i: int, j: int) -> None:
        if top(i) != top(j):
            root[top(i)] = top(j)
            pairs.append((i, j))

    for j in range(1, len(sets)):
        if not (two and chunk[0] == chunk[j]) and similar(sets[0], sets[j]):
            join(0, j)
    apart = [j for j in range(1, len(sets)) if top(j) != top(0) or two]
    if len(sets) <= PAIRED or not apart:
        for i in apart:
            for j in range(1, len(sets)):
                if top(i) != top(j) and not (two and chunk[i] == chunk[j]) and similar(sets[i], sets[j]):
                    join(i, j)
        return pairs
    sizes = np.array([len(s) for s in sets])
    tokens, holder = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, holder = tokens[order], holder[order]
    own = np.array(chunk)
    for i in apart:
        low = np.searchsorted(tokens, sets[i], "left")
        many = np.searchsorted(tokens, sets[i], "right") - low
        at = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
        same = np.bincount(holder[at], minlength=len(sets))
        good = 100 * same >= PERCENT * (sizes[i] + sizes - same)
        good[i] = False
        if two:
            good &= own != own[i]
        for j in np.flatnonzero(good).tolist():
            join(i, j)
    return pairs


def _runs_of_texts(texts: pa.Array) -> list[np.ndarray]:
    """The shingles of each text, in their order."""
    found = []
    for part in W.parts(texts.cast(pa.string()), PART_BYTES):
        words = W.words(part)
        every = W.runs(words.hashes, WORDS)
        ends = (words.rows[1:] - (WORDS - 1)).tolist()
        found += [every[a:z] for a, z in zip(words.rows[:-1].tolist(), ends)]
    return found


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of blocks, whose rows come one after another."""
    block, keys, chunk, runs = None, [], [], []

    def linked() -> list[tuple]:
        if len(keys) < 2:
            return []
        sets = [_set(x) for x in runs]
        return [
            (keys[i], keys[j], *_shared(runs[i], sets[j]), *_shared(runs[j], sets[i]))
            for i, j in forest(sets, chunk)
        ]

    def told(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 6
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["a", "b", "low_a", "high_a", "low_b", "high_b"]
        )

    with np.errstate(over="ignore"):
        for batch in batches:
            rows: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in ("band", "i", "j", "key", "own")]
            for band, i, j, key, own, shingles in zip(*columns, _runs_of_texts(batch.column("text"))):
                if (band, i, j) != block:
                    rows += linked()
                    block, keys, chunk, runs = (band, i, j), [], [], []
                if not keys or key != keys[-1]:
                    keys.append(key)
                    chunk.append(own)
                    runs.append(shingles)
            yield told(rows)
        yield told(linked())


def paragraph_links(docs: DataFrame) -> DataFrame:
    """Links between similar paragraphs, enough of them to connect all that similar pairs in a
    common band connect: keys a and b, and the words that each shares with the other."""
    groups = docs.select("text").mapInArrow(_bands, "band long, key long").groupBy("band")
    groups = groups.agg(F.min("key").alias("low"), F.max("key").alias("high"))
    groups = written(groups.where("low <> high").select("band"), "bands")
    needed = key_filter(groups, "band")
    members = docs.select("text").mapInArrow(_members(needed), "bands array<long>, key long, text binary")
    members = members.select(F.explode("bands").alias("band"), "key", "text").join(groups, "band", "left_semi")
    members = written(members, "members", "zstd")
    needed.destroy()
    sizes = members.groupBy("band").agg(F.approx_count_distinct("key").alias("n"))
    large = written(sizes.where(F.col("n") > CHUNK).select("band", F.ceil(F.col("n") / CHUNK).alias("chunks")), "large")
    if large.isEmpty():
        zero = F.lit(0).cast("long")
        placed = members.withColumns({"own": zero, "i": zero, "j": zero})
    else:
        placed = members.join(large, "band", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        placed = placed.withColumn("own", F.pmod(F.xxhash64("key"), "chunks"))
        placed = placed.withColumn("other", F.explode(F.expr("sequence(0L, chunks - 1)")))
        placed = placed.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    dealt = placed.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "own", "key")
    return dealt.select("band", "i", "j", "key", "own", "text").mapInArrow(
        _links, "a long, b long, low_a long, high_a long, low_b long, high_b long"
    )


def _linked(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, component) of linked paragraphs, and (key, low, high): what each shares."""
    found = written(components(links.select("a", "b")), "labels")
    ends = links.select(F.col("a").alias("key"), F.col("low_a").alias("low"), F.col("high_a").alias("high"))
    ends = ends.union(links.select("b", "low_b", "high_b"))
    return found, ends.groupBy("key").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def linked_paragraphs(docs: DataFrame) -> DataFrame:
    """Components of different paragraphs that are similar: (node, component), both keys."""
    return _linked(written(paragraph_links(docs), "links"))[0]


# Equal windows


def _window_counts(bits: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        with np.errstate(over="ignore"):
            for batch in batches:
                for part in W.parts(batch.column("text"), PART_BYTES):
                    held.append(windows(part)[3].view(np.uint64))
                    size += len(held[-1])
                    if size >= COUNT_ROWS:
                        yield count_bucket_rows(held, bits)
                        held, size = [], 0
            if size:
                yield count_bucket_rows(held, bits)

    return count


def repeated_window_keys(docs: DataFrame) -> tuple[int, DataFrame]:
    """Bits of the bucket number, and shortened keys (``short``) that hold every key of two or more
    windows."""
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    letters = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = min(31, max(2 * width - 1, letters // 20 // BUCKET_SIZE).bit_length())
    rows = docs.select("text").mapInArrow(
        _window_counts(bits), "bucket long, once binary, more binary, counts binary"
    )
    counts = rows.groupBy("bucket").applyInPandas(frequent_of_bucket(2), "short long, count long")
    return bits, written(counts.select("short"), "twice")


# Places


def _points(part: W.Part) -> np.ndarray:
    """Code points before each byte of a part and in all of it."""
    points = np.zeros(len(part.data) + 1, np.int32)
    np.cumsum((part.data & 0xC0) != 0x80, out=points[1:])
    return points


def _place_rows(
    batch: pa.RecordBatch, part: W.Part, found: W.Words, points: np.ndarray, first, last, keys
) -> list[pa.Array]:
    row = np.searchsorted(found.rows, first, "right") - 1
    zero = points[part.offsets[:-1]][row]
    starts, ends = points[np.append(found.starts, 0)], points[np.append(found.ends, 0)]
    start, end = starts[first], ends[last - 1]
    before = np.where(first == found.rows[row], -1, start - ends[first - 1])
    after = np.where(last == found.rows[row + 1], -1, starts[last] - end)
    rows, own = pa.array(row), batch.slice(part.first, len(part))
    return [
        pa.array(keys), own.column("doc_id").take(rows), own.column("doc").take(rows),
        pa.array(first - found.rows[row], pa.int32()), pa.array(last - first, pa.int32()),
        pa.array(start - zero, pa.int64()), pa.array(end - zero, pa.int64()),
        pa.array(before, pa.int32()), pa.array(after, pa.int32()),
    ]


def _places(windows_needed, bits: int, lines_needed=None):
    """Places of windows whose shortened keys the filter lets through, and of paragraphs that theirs
    lets through if there is one; these with code points of all their words from their start on."""
    names = [c.split()[0] for c in f"{PLACES}, {LINES}".split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for part in W.parts(batch.column("text"), PART_BYTES):
                    found, first, last, keys = windows(part)
                    good = passes(windows_needed.value, (keys.view(np.uint64) >> np.uint64(32 - bits)).view(np.int64))
                    points = _points(part)
                    columns = _place_rows(batch, part, found, points, first[good], last[good], keys[good])
                    none = pa.nulls(len(columns[0]), pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays([*columns, none, none], names)
                    if lines_needed is None:
                        continue
                    _, first, last = paragraphs(part, found)
                    keys = _text_keys(found, first, last)
                    good = passes(lines_needed.value, keys)
                    first, last = first[good], last[good]
                    columns = _place_rows(batch, part, found, points, first, last, keys[good])
                    inner, at = _from_to(first, last)
                    zero = np.repeat(points[found.starts[first]], last - first)
                    for x in (found.starts, found.ends):
                        columns.append(_lists(points[x[inner]] - zero, np.diff(at)))
                    yield pa.RecordBatch.from_arrays(columns, names)

    return rows


def _cut_lines(lines: DataFrame, known: DataFrame) -> DataFrame:
    """PLACES of linked paragraphs, cut to what they share; ``key`` stands for the component."""
    return lines.join(known, "key").select(
        F.xxhash64(F.lit(1), "component").alias("key"), "doc_id", "doc",
        (F.col("word") + F.col("low")).cast("int").alias("word"), F.expr("CAST(high - low AS INT) AS words"),
        F.expr("start + get(starts, CAST(low AS INT)) AS start"),
        F.expr("start + get(ends, CAST(high - 1 AS INT)) AS end"),
        F.expr("IF(low = 0, before, get(starts, CAST(low AS INT)) - get(ends, CAST(low - 1 AS INT))) AS before"),
        F.expr("IF(high = words, after, get(starts, CAST(high AS INT)) - get(ends, CAST(high - 1 AS INT))) AS after"),
    )


def repeated_places(docs: DataFrame, links: DataFrame) -> DataFrame:
    """PLACES of windows that may be repeated and of linked paragraphs. One pass finds both; only the
    paragraphs are joined with what is known of them."""
    bits, twice = repeated_window_keys(docs)
    needed, known, lines_needed = key_filter(twice, "short"), None, None
    if not links.isEmpty():
        labels, shares = _linked(links)
        known = labels.join(shares, labels["node"] == shares["key"]).select("key", "component", "low", "high")
        known = written(known, "known")
        lines_needed = key_filter(known, "key")
    found = docs.mapInArrow(_places(needed, bits, lines_needed), f"{PLACES}, {LINES}")
    found = written(found, "places", "zstd")
    needed.destroy()
    places = found.where("starts IS NULL").drop("starts", "ends")
    if known is None:
        return places
    lines_needed.destroy()
    lines = _cut_lines(found.where("starts IS NOT NULL"), known)
    return places.union(written(lines, "lines", "zstd"))


def _marked(places: DataFrame) -> DataFrame:
    """Places of keys that have several, with the document in which the key stands first: the
    smallest doc_id and, if that has several texts, one of them."""
    first = places.groupBy("key").agg(
        F.min("doc_id").alias("first_doc_id"), F.min_by("doc", "doc_id").alias("first_doc"), F.count("*").alias("n")
    )
    first = written(first.where("n > 1").drop("n"), "first")
    home = (F.col("first_doc_id") == F.col("doc_id")) & (F.col("first_doc") == F.col("doc"))
    return places.join(first, "key").withColumn("home", home).drop("first_doc")


def passages(places: dict[str, np.ndarray]) -> list[tuple]:
    """Stretches of neighbouring places of one document, tested for length as a whole and only then
    split by ``removed`` and at gaps: (start, end, words, first_doc_id or None, removed). Words that
    several places hold are removed if one of these is. Of a place that overlaps the first one of its
    key, what the first one holds stays."""
    a = places["word"].astype(np.int64)
    z = a + places["words"]
    removed, low = ~places["home"], a
    home = np.flatnonzero(places["home"])
    if len(home):
        # Places come in the order of their words, so the first one of a key is its first here.
        _, one, same = np.unique(places["key"][home], return_index=True, return_inverse=True)
        later = home[one][same] != home
        first_to = z[home[one]][same]
        removed = removed.copy()
        removed[home[later]] = True
        over = home[later & (a[home] < first_to) & (z[home] > first_to)]
        low = a.copy()
        low[over] = first_to[later & (a[home] < first_to) & (z[home] > first_to)]
    # Code points on both sides of each word border at which a place begins or ends.
    border = np.concatenate([a, z])
    left = np.concatenate([np.where(places["before"] < 0, 0, places["start"] - places["before"]), places["end"]])
    right = np.concatenate([places["start"], np.where(places["after"] < 0, places["end"], places["end"] + places["after"])])
    at, one = np.unique(border, return_index=True)
    left, right = left[one], right[one]
    n = len(at)
    gone, held = np.zeros(n, np.int64), np.zeros(n, np.int64)
    i, j = np.searchsorted(at, low), np.searchsorted(at, z)
    i = np.minimum(i, n - 1)
    np.add.at(held, np.searchsorted(at, a), 1)
    np.add.at(held, j, -1)
    np.add.at(gone, i[removed], 1)
    np.add.at(gone, j[removed], -1)
    held, gone = np.cumsum(held) > 0, np.cumsum(gone) > 0
    spans = np.flatnonzero(held[:-1])
    if not len(spans):
        return []
    begin, end, out = at[spans], at[spans + 1], gone[spans]
    gap = begin[1:] - end[:-1]
    stretch = np.append(0, np.cumsum(gap > GAP_WORDS))
    turn = np.append(0, np.cumsum((gap > 0) | (out[1:] != out[:-1])))
    nearest = np.full(turn[-1] + 1, np.iinfo(np.int64).max)
    np.minimum.at(nearest, turn[np.searchsorted(spans, i[removed])], places["first_doc_id"][removed])
    x = np.flatnonzero(np.append(True, turn[1:] != turn[:-1]))
    y = np.append(x[1:], len(turn)) - 1
    x, y, nearest = (v[(np.bincount(stretch, end - begin) >= STRETCH_WORDS)[stretch[x]]] for v in (x, y, nearest))
    return list(
        zip(right[spans[x]].tolist(), left[spans[y] + 1].tolist(), (end[y] - begin[x]).tolist(), nearest.tolist(), out[x].tolist())
    )


_COLUMNS = "key word words start end before after first_doc_id home".split()


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages of documents whose places come one after another. Of rows that repeat one holds the
    first places; in the others all is removed."""
    names = ["doc_id", "doc", "copies", *_COLUMNS]
    held: list[dict[str, np.ndarray]] = []

    def told(pieces: list[dict[str, np.ndarray]]) -> list[tuple]:
        whole = pieces[0] if len(pieces) == 1 else {c: np.concatenate([x[c] for x in pieces]) for c in names}
        doc_id, copies = int(whole["doc_id"][0]), int(whole["copies"][0])
        rows = passages(whole)
        if copies > 1:
            rows = rows + passages({**whole, "home": np.zeros(len(whole["key"]), bool)}) * (copies - 1)
        return [(doc_id, s, e, n, f if r else doc_id, r) for s, e, n, f, r in rows]

    def rows_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 5 + [pa.bool_()]
        columns = list(zip(*rows)) or [()] * 6
        names = [c.split()[0] for c in PASSAGES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    for batch in batches:
        if not batch.num_rows:
            continue
        all_ = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
        ids = all_["doc_id"], all_["doc"]
        new = np.flatnonzero((ids[0][1:] != ids[0][:-1]) | (ids[1][1:] != ids[1][:-1])) + 1
        edges, rows = [0, *new.tolist(), batch.num_rows], []
        for a, b in zip(edges[:-1], edges[1:]):
            piece = {c: v[a:b] for c, v in all_.items()}
            if held and not (a == 0 and held[-1]["doc_id"][0] == ids[0][0] and held[-1]["doc"][0] == ids[1][0]):
                rows += told(held)
                held = []
            held.append(piece)
        yield rows_of(rows)
    if held:
        yield rows_of(told(held))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """Passages that also stand elsewhere, equal or similar, of at least STRETCH_WORDS words in all,
    split into removed and kept rows of any length: ``doc_id, start, end`` (code points), ``words``,
    ``first_doc_id`` (the smallest document in which a part of it stands first) and ``removed`` (not
    the first place of a part of it). Null and empty texts and rows without doc_id have none; rows that
    repeat hold the same passages, of which all but one are removed; rows that share a doc_id but not
    the text are documents of their own."""
    docs = id_and_text(docs).where("doc_id IS NOT NULL").withColumn("doc", F.xxhash64("text"))
    links = written(paragraph_links(docs), "links")
    marked = _marked(repeated_places(docs, links))
    copies = docs.groupBy("doc_id", "doc").agg(F.count("*").alias("copies"))
    copies = written(copies.where("copies > 1"), "copies")
    if copies.isEmpty():
        marked = marked.withColumn("copies", F.lit(1))
    else:
        # Rows that repeat hold the same places; they count once and are told as often as they stand.
        marked = marked.dropDuplicates(["doc_id", "doc", "key", "word", "words"])
        marked = marked.join(copies, ["doc_id", "doc"], "left").withColumn("copies", F.coalesce("copies", F.lit(1)))
    dealt = marked.repartition("doc_id", "doc").sortWithinPartitions("doc_id", "doc", "word", "words")
    return dealt.select("doc_id", "doc", "copies", *_COLUMNS).mapInArrow(_passages, PASSAGES)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(documents(spark, sf_dir))
