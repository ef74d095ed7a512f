"""Ranked lexical search over a length-stratified index.

A document's length counts in its score only through the whole number m, so documents of equal m
form a stratum. Inside a stratum the weight of a term depends on its frequency tf in the document
alone: the impact (10**9 * tf) div (1000 * tf + 8 * m) is computed once per tf, and the postings of a
term are grouped by tf, largest first. The impact at a term's largest tf bounds what the term can add
in the stratum, and the sum over an item's terms bounds every score in it.

Building: lengths are counted first (N and L, and how many documents there are per band of
lengths). Documents then go by length to as many partitions as the counts ask for, a long band or one
frequent length over several, and each partition writes its strata as cells of bounded size. Every
document with a term is indexed, under all its terms.

Searching, for a block of items at a time: document frequencies are summed over cells; for each item
the cells with the highest bounds are visited first, and their tenth best score is a threshold that
all other cells must reach by their bound to be visited at all. Nothing is estimated: ties with the
threshold are visited, and scores are whole numbers.

Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablework.llm.shared import documents, id_and_text, written
from tablework.llm.words import NOT_ALNUM, mix, parts, words

K = 10
PARTITION_TERMS = 4 << 20  # terms of the documents in a partition, about
CELL_POSTINGS, CELL_DOCS = 1 << 20, 1 << 16
ITEMS_AT_ONCE = 2000
FIRST_VISITS = 8  # cells per item whose scores give the threshold

FORWARD = "part int, n long, doc_id long, terms binary, tfs binary"
CELLS = "m long, docs binary, terms binary, firsts binary, group_tf binary, group_at binary, ords binary"


def band(n: np.ndarray) -> np.ndarray:
    """Band of a length: lengths under 64 each, then 32 to each power of two; rises with n."""
    e = np.maximum(0, np.frexp(n.astype(float))[1] - 6)
    return np.where(n < 64, n, e * 32 + (n >> e))


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents and terms per band of lengths; rows without a term are left out."""
    docs, terms = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        for part in parts(batch.column("text")):
            n = _term_counts(part)
            n = n[n > 0]
            if len(n):
                size = max(len(docs), int(band(n).max()) + 1)
                docs = np.pad(docs, (0, size - len(docs))) + np.bincount(band(n), minlength=size)
                terms = np.pad(terms, (0, size - len(terms)))
                np.add.at(terms, band(n), n)
    seen = np.flatnonzero(docs)
    yield pa.RecordBatch.from_pydict(
        {"band": pa.array(seen), "docs": pa.array(docs[seen]), "terms": pa.array(terms[seen])}
    )


def _term_counts(part) -> np.ndarray:
    solid = ~NOT_ALNUM[part.data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    rows = part.offsets[:-1][part.offsets[:-1] < len(solid)]
    first[rows] = solid[rows]
    return np.diff(np.append(0, np.cumsum(first))[part.offsets])


def _forward(first: np.ndarray, splits: np.ndarray):
    """Each document as its different terms, in the order of their hashes, and their frequencies;
    with the partition that its band of lengths (and a hash) gives it."""

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for part in parts(batch.column("text")):
                found = words(part, True, NOT_ALNUM)
                n = np.diff(found.rows)
                rows = np.repeat(np.arange(len(n)), n)
                order = np.lexsort((found.hashes, rows))
                hashes = found.hashes[order]
                new = np.ones(len(hashes), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
                at = np.flatnonzero(new)
                tfs = np.diff(np.append(at, len(hashes))).astype("<u4")
                ends = np.searchsorted(at, found.rows)
                raw_terms, raw_tfs = hashes[at].astype("<u8").tobytes(), tfs.tobytes()
                some = np.flatnonzero(n)
                own = doc_ids[part.first + some].astype(np.int64)
                bands = band(n[some])
                deal = mix(own.astype(np.uint64) ^ mix(hashes[found.rows[some]])) % splits[bands]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(first[bands] + deal.astype(np.int64), pa.int32()),
                        pa.array(n[some], pa.int64()),
                        pa.array(own, pa.int64()),
                        pa.array([raw_terms[8 * ends[i] : 8 * ends[i + 1]] for i in some], pa.binary()),
                        pa.array([raw_tfs[4 * ends[i] : 4 * ends[i + 1]] for i in some], pa.binary()),
                    ],
                    ["part", "n", "doc_id", "terms", "tfs"],
                )

    return forward


def _cell(m: int, held: list[tuple]) -> dict:
    """The postings of some documents of one stratum: by term, then by tf, largest first."""
    terms = [np.frombuffer(t, "<u8") for _, t, _ in held]
    ords = np.repeat(np.arange(len(held)), [len(t) for t in terms])
    terms = np.concatenate(terms)
    tfs = np.concatenate([np.frombuffer(t, "<u4") for _, _, t in held])
    order = np.lexsort((ords, -tfs.astype(np.int64), terms))
    terms, tfs = terms[order], tfs[order]
    term_starts = np.append(True, terms[1:] != terms[:-1])
    group_starts = term_starts | np.append(True, tfs[1:] != tfs[:-1])
    groups = np.flatnonzero(group_starts)
    return {
        "m": m,
        "docs": np.array([d for d, _, _ in held], "<i8").tobytes(),
        "terms": terms[term_starts].tobytes(),
        "firsts": np.append(np.flatnonzero(term_starts[groups]), len(groups)).astype("<u4").tobytes(),
        "group_tf": tfs[groups].tobytes(),
        "group_at": np.append(groups, len(terms)).astype("<u4").tobytes(),
        "ords": ords[order].astype("<u2").tobytes(),
    }


_KINDS = {"m": pa.int64()}


def _cells(n_docs: int, n_terms: int):
    """Cells of a partition whose documents come by rising length, so that those of a stratum come
    one after another."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, stratum = 0, -1

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([v], _KINDS.get(k, pa.binary())) for k, v in _cell(stratum, held).items()],
                [c.split()[0] for c in CELLS.split(", ")],
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("n", "doc_id", "terms", "tfs")]
            for n, doc_id, terms, tfs in zip(*columns):
                m = 100 - 75 + 75 * n * n_docs // n_terms
                if held and (m != stratum or size >= CELL_POSTINGS or len(held) == CELL_DOCS):
                    yield made()
                    held, size = [], 0
                stratum = m
                held.append((doc_id, terms, tfs))
                size += len(terms) // 8
        if held:
            yield made()

    return cells


@dataclass
class Index:
    """Cells of the strata, the number of documents with a term (N) and of all their terms (L)."""

    cells: DataFrame
    n_docs: int
    n_terms: int


def build(docs: DataFrame) -> Index:
    """Index all rows of ``docs`` with a doc_id and at least one term; other rows are no documents
    here. Rows that repeat or share a doc_id are documents each."""
    rows = id_and_text(docs).where("doc_id IS NOT NULL")
    lengths = rows.select("text").mapInArrow(_lengths, "band long, docs long, terms long")
    lengths = lengths.groupBy("band").agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms"))
    bands = lengths.orderBy("band").collect()  # about 32 for each power of two
    n_docs, n_terms = sum(r.docs for r in bands), sum(r.terms for r in bands)
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = max(1, min(PARTITION_TERMS, n_terms // width))
    size = max([r.band for r in bands], default=0) + 1
    first, splits = np.zeros(size, np.int64), np.ones(size, np.uint64)
    at = filled = 0
    for r in bands:  # small bands share a partition, large ones have several
        if filled and filled + r.terms > each:
            at, filled = at + 1, 0
        first[r.band], splits[r.band] = at, max(1, r.terms // each)
        if splits[r.band] > 1:
            at, filled = at + int(splits[r.band]), 0
        else:
            filled += r.terms
    forward = rows.mapInArrow(_forward(first, splits), FORWARD)
    dealt = forward.repartitionById(at + 1, F.col("part")).sortWithinPartitions("n", "doc_id")
    cells = dealt.mapInArrow(_cells(n_docs, n_terms), CELLS)
    cells = cells.withColumn("cell", F.xxhash64("m", "docs"))
    return Index(written(cells, "index", "zstd"), n_docs, n_terms)


@dataclass
class Items:
    """A block of items: their ids, all their different terms in order, and for each item (from
    ``starts``) the places of its terms there and how often it has each."""

    ids: list[int]
    terms: np.ndarray
    starts: np.ndarray
    places: np.ndarray
    times: np.ndarray
    weights: np.ndarray | None = None


def _block(rows: list) -> Items | None:
    texts: dict[int, list[str]] = {}
    for r in rows:
        texts.setdefault(r.doc_id, []).append(r.text)
    ids, all_hashes, all_times = [], [], []
    for item_id, own in sorted(texts.items()):
        (part,) = parts(pa.array([" ".join(own)]), 1 << 62)
        hashes, times = np.unique(words(part, True, NOT_ALNUM).hashes, return_counts=True)
        if len(hashes):
            ids.append(item_id)
            all_hashes.append(hashes)
            all_times.append(times)
    if not ids:
        return None
    terms, places = np.unique(np.concatenate(all_hashes), return_inverse=True)
    starts = np.cumsum([0] + [len(h) for h in all_hashes])
    return Items(ids, terms, starts, places, np.concatenate(all_times))


class _Cell:
    """One cell, as far as the items of a block are concerned."""

    def __init__(self, row: dict, items: Items):
        terms = np.frombuffer(row["terms"], "<u8")
        self.firsts = np.frombuffer(row["firsts"], "<u4").astype(np.int64)
        place = np.minimum(np.searchsorted(terms, items.terms), len(terms) - 1)
        self.here = terms[place] == items.terms
        self.place = place
        if "group_at" in row:
            self.group_at = np.frombuffer(row["group_at"], "<u4").astype(np.int64)
        if "group_tf" in row:
            tfs, same = np.unique(np.frombuffer(row["group_tf"], "<u4").astype(np.int64), return_inverse=True)
            self.impact = (10**9 * tfs // (1000 * tfs + 8 * row["m"]))[same]
        if "docs" in row:
            self.docs = np.frombuffer(row["docs"], "<i8")
            self.ords = np.frombuffer(row["ords"], "<u2")

    def frequencies(self) -> np.ndarray:
        """In how many documents of the cell each term of the block stands."""
        at = self.group_at
        return np.where(self.here, at[self.firsts[self.place + 1]] - at[self.firsts[self.place]], 0)

    def bounds(self, items: Items) -> np.ndarray:
        """No document of the cell has a higher score for the item."""
        most = np.where(self.here, items.weights * self.impact[self.firsts[self.place]], 0)
        return np.add.reduceat(most[items.places] * items.times, items.starts[:-1])

    def best(self, items: Items, item: int, least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best documents with a score of at least ``least``: scores and doc_ids in order."""
        own = slice(items.starts[item], items.starts[item + 1])
        places, times = items.places[own], items.times[own]
        times, places = times[self.here[places]], places[self.here[places]]
        a, b = self.firsts[self.place[places]], self.firsts[self.place[places] + 1]
        groups = _ranges(a, b)
        gained = np.repeat(times * items.weights[places], b - a) * self.impact[groups]
        low, high = self.group_at[groups], self.group_at[groups + 1]
        scores = np.zeros(len(self.docs), np.int64)
        np.add.at(scores, self.ords[_ranges(low, high)], np.repeat(gained, high - low))
        found = np.flatnonzero(scores >= max(1, least))
        if len(found) > k:
            last = np.partition(scores[found], len(found) - k)[len(found) - k]
            found = found[scores[found] >= last]
        order = np.lexsort((self.docs[found], -scores[found]))[:k]
        return scores[found][order], self.docs[found][order]


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The numbers of all ranges low ... high one after another."""
    n = high - low
    to = np.cumsum(n)
    return np.repeat(low - (to - n), n) + np.arange(to[-1] if len(to) else 0)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch.column(c)[i].as_py() for c in batch.schema.names}


def _frequencies(items: Items):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(items.terms), np.int64)
        for row in _rows(batches):
            total += _Cell(row, items).frequencies()
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(seen), "df": pa.array(total[seen])})

    return count


def _highest(items: Items):
    """For each item and each of FIRST_VISITS shares of the cells, the cell with the highest bound."""

    def highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = (FIRST_VISITS, len(items.ids))
        bound, cell = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        for row in _rows(batches):
            share = row["cell"] % FIRST_VISITS
            own = _Cell(row, items).bounds(items)
            better = own > bound[share]
            bound[share][better] = own[better]
            cell[share][better] = row["cell"]
        share, item = np.nonzero(bound)
        yield pa.RecordBatch.from_pydict(
            {
                "item": pa.array(item), "share": pa.array(share),
                "bound": pa.array(bound[share, item]), "cell": pa.array(cell[share, item]),
            }
        )

    return highest


class _Best:
    """The k best documents of each item so far."""

    def __init__(self, items: Items, least: np.ndarray, k: int):
        self.items, self.least, self.k = items, least.copy(), k
        self.scores = [np.zeros(0, np.int64)] * len(items.ids)
        self.docs = list(self.scores)

    def visit(self, cell: _Cell, item: int) -> None:
        scores, docs = cell.best(self.items, item, self.least[item], self.k)
        if not len(scores):
            return
        scores, docs = np.append(self.scores[item], scores), np.append(self.docs[item], docs)
        order = np.lexsort((docs, -scores))[: self.k]
        self.scores[item], self.docs[item] = scores[order], docs[order]
        if len(order) == self.k:
            self.least[item] = max(self.least[item], self.scores[item][-1])

    def rows(self) -> pa.RecordBatch:
        n = [len(s) for s in self.scores]
        return pa.RecordBatch.from_pydict(
            {
                "item": pa.array(np.repeat(np.arange(len(n)), n), pa.int64()),
                "doc_id": pa.array(np.concatenate(self.docs), pa.int64()),
                "score": pa.array(np.concatenate(self.scores), pa.int64()),
            }
        )


def _visited(items: Items, least: np.ndarray, k: int, only: dict[int, list[int]] | None = None):
    """The best documents of the cells of a task: of cells whose bound reaches ``least``, or of those
    that ``only`` names for an item."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(items, least, k)
        for row in _rows(batches):
            if only is not None and row["cell"] not in only:
                continue
            cell = _Cell(row, items)
            if only is not None:
                wanted = only[row["cell"]]
            else:
                wanted = np.flatnonzero(cell.bounds(items) >= np.maximum(1, best.least)).tolist()
            for item in wanted:
                best.visit(cell, item)
        yield best.rows()

    return visit


FOUND = "item long, doc_id long, score long"


def _block_results(index: Index, items: Items, k: int) -> DataFrame:
    cells = index.cells
    counted = cells.select("terms", "firsts", "group_at").mapInArrow(_frequencies(items), "term long, df long")
    df = np.zeros(len(items.terms), np.int64)
    for r in counted.groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r.term] = r.df
    items.weights = np.floor(1000 * np.log((2 * index.n_docs + 2) / (2 * df + 1))).astype(np.int64)

    bounds = cells.select("cell", "m", "terms", "firsts", "group_tf")
    highest = bounds.mapInArrow(_highest(items), "item long, share long, bound long, cell long")
    highest = highest.groupBy("item", "share").agg(F.max_by("cell", F.struct("bound", "cell")).alias("cell"))
    only: dict[int, list[int]] = {}
    for r in highest.collect():  # FIRST_VISITS for each item
        only.setdefault(r.cell, []).append(r.item)
    nothing = np.zeros(len(items.ids), np.int64)
    tenth = cells.mapInArrow(_visited(items, nothing, k, only), FOUND)
    ranked = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    tenth = tenth.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") == k)
    least = nothing.copy()
    for r in tenth.collect():
        least[r.item] = r.score

    found = cells.mapInArrow(_visited(items, least, k), FOUND)
    found = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    ids = F.element_at(F.array(*[F.lit(i) for i in items.ids]), F.col("item").cast("int") + 1)
    return written(
        found.select(ids.cast("long").alias("item_id"), F.col("rank").cast("int"), "doc_id", "score"), "found"
    )


def search(index: Index, items: DataFrame, k: int = K) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: for each item the k documents with the highest scores
    above 0, equal ones by doc_id. Rows that share an item_id are one item with all their terms; rows
    without an item_id, and items without a term, find nothing. Items are searched in blocks of about
    ITEMS_AT_ONCE, whose texts the driver and every task hold."""
    rows = items.select(
        items["item_id"].cast("long").alias("doc_id"),
        F.coalesce(items["text"].cast("string"), F.lit("")).alias("text"),
    ).where("doc_id IS NOT NULL")
    blocks = max(1, -(-rows.count() // ITEMS_AT_ONCE))
    found = []
    for i in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)) == i) if blocks > 1 else rows
        block = _block(own.collect())
        if block is not None:
            found.append(_block_results(index, block, k))
    if not found:
        empty = "item_id long, rank int, doc_id long, score long"
        return items.sparkSession.createDataFrame([], empty)
    result = found[0]
    for more in found[1:]:
        result = result.union(more)
    return result


def op11_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return search(build(documents(spark, sf_dir)), items)


_TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = f"""
WITH doc_terms AS (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("text")}, '{_TERM}')) AS term
    FROM documents
), tf AS (
    SELECT doc_id, term, count(*) AS tf FROM doc_terms GROUP BY doc_id, term
), lengths AS (
    SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id
), totals AS (
    SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM lengths
), norms AS (
    SELECT doc_id, 100 - 75 + ((75 * n * docs) // terms) AS m FROM lengths, totals
), weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM tf, totals GROUP BY term
), item_terms AS (
    SELECT item_id, unnest(regexp_extract_all({_LOWER.format("text")}, '{_TERM}')) AS term
    FROM benchmark
), scores AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM item_terms JOIN tf USING (term) JOIN weights USING (term) JOIN norms USING (doc_id)
    GROUP BY item_id, doc_id
), ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
        doc_id, score FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {K}
"""
