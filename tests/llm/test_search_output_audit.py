"""Ranked search, token-ID files, filter audit, and token ids by piece."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tablework.llm import filter_audit, lexical, packing, token_files
from tablework.llm import words as W
from tablework.llm.token_ids import TokenIds
from tablework.storage import fresh_path
from tests import oracle

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path(token_files.VOCABULARY)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


# Token ids


def ids_by_piece(texts, limit=W.PART_BYTES):
    store = TokenIds(PATH)
    found = []
    for part in W.parts(pa.array(texts, pa.string()), limit):
        ids, rows = store.of(part)
        found += [ids[a:b].tolist() for a, b in zip(rows[:-1], rows[1:])]
    return found


def test_ids_by_piece_equal_ids_of_whole_texts(tokenizer, rows):
    rng = random.Random(1)
    signs = [*"aBéÉ'’s12.,- \n\tß×÷中İΣς_<|=½Ⅷñ", "re", "ll", "́", "̸", "ñ", "\x1c", "\x85",
             "\xa0", "\x00", "😀", "ﬁ"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 25))) for _ in range(5000)]
    texts += [r[1] or "" for r in rows] + ["", "a", "x" * 3000]
    expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids_by_piece(texts) == expected
    assert ids_by_piece(texts, 500) == expected  # other parts, other contents of the table


def test_strings_of_special_tokens_are_encoded_like_the_tokenizer_does(tokenizer):
    texts = ["a <|endoftext|>b", "<|startoftext|>", "plain"]
    assert ids_by_piece(texts) == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_the_store_starts_anew_when_it_is_full(tokenizer, monkeypatch):
    monkeypatch.setattr("tablework.llm.token_ids.POOL_IDS", 20)
    texts = [f"word{i} and {i}th other words" for i in range(200)]
    assert ids_by_piece(texts, 100) == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_the_store_of_a_worker_is_small():
    store = TokenIds(PATH)
    assert sum(x.nbytes for x in (store._keys, store._starts, store._counts)) <= 16 << 20
    assert packing.PART_BYTES < W.PART_BYTES


def test_packing_deals_rows_without_an_id_to_all_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 50)
    docs = spark.createDataFrame([(None, "some words") for _ in range(1000)], "doc_id long, text string")
    found = packing.packed(docs, sequence=16).toPandas()
    assert len(found) == 1000 and found.doc_id.isna().all()
    sizes = found.groupby(found.sequence_id % 20).size()
    assert len(sizes) == 20 and sizes.max() < 100


# Token-ID files


@pytest.mark.parametrize("bits", [1, 8, 9, 16, 17, 24, 25, 32])
def test_coding_round_trip(bits):
    rng = np.random.default_rng(bits)
    values = rng.integers(0, 1 << bits, 4 * 97, dtype=np.uint64).astype(np.uint32)
    control, data, lengths = token_files.encode(values)
    assert len(control) == 97 and lengths.sum() == len(data)
    assert lengths.tolist() == [max(1, (int(v).bit_length() + 7) // 8) for v in values]
    assert (token_files.decode(control, data) == values).all()
    if len(data):
        with pytest.raises(ValueError):
            token_files.decode(control, data[:-1])


def test_token_files_round_trip(spark, docs, rows, tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_BYTES", 3000)  # in this process only: driver side
    folder = fresh_path(spark, "tokens")
    token_files.write_token_files(docs, folder)
    found = token_files.read_token_files(spark, folder, ids=True).orderBy("start").collect()
    expected = defaultdict(Counter)
    for doc_id, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, token_files.END]
        expected[doc_id][tuple(ids)] += 1
    start, actual = 0, defaultdict(Counter)
    for r in found:
        ids = np.frombuffer(r.ids, "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(r.ids))
        actual[r.doc_id][tuple(ids.tolist())] += 1
        start += r.n_tokens
    assert actual == expected
    order = [(r.doc_id is not None, r.doc_id or 0) for r in found]
    assert order == sorted(order)


def test_frequent_ids_take_one_byte(spark):
    texts = [(i, "the the the the the the the cat") for i in range(50)]
    folder = fresh_path(spark, "tokens")
    token_files.write_token_files(spark.createDataFrame(texts, "doc_id long, text string"), folder)
    ranks = np.fromfile(f"{folder}/{token_files.RANKS}", "<u4")
    the = Tokenizer.from_file(PATH).encode("the", add_special_tokens=False).ids[0]
    assert ranks[0] == the and len(ranks) == 3


def test_token_files_of_nothing(spark, nothing):
    folder = fresh_path(spark, "tokens")
    token_files.write_token_files(nothing, folder)
    assert token_files.read_token_files(spark, folder).count() == 0


def test_a_cut_file_is_an_error(spark):
    folder = fresh_path(spark, "tokens")
    docs = spark.createDataFrame([(i, "some words here") for i in range(9)], "doc_id long, text string")
    token_files.write_token_files(docs.coalesce(1), folder)
    import glob

    for name in glob.glob(f"{folder}/*.tok"):
        with open(name, "r+b") as file:
            file.truncate(40)
    with pytest.raises(Exception, match="ends inside a block"):
        token_files.read_token_files(spark, folder).count()


# Filter audit


def own_failures(rows):
    first = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    for doc_id, text, source, quality, toxic in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and doc_id > first[text],
        }
        yield source or "", {x for x in failed if failed[x]}, quality, toxic


def audit_by_hand(rows):
    """Every order applied document by document."""
    found, shapley, parts = {}, Counter(), set()
    marked = list(own_failures(rows))
    for part, *_ in marked:
        parts.add(part)
    for order in permutations("ABCDE"):
        counts = defaultdict(Counter)
        for part, failed, quality, toxic in marked:
            at = next((i for i, x in enumerate(order) if x in failed), 5)
            for step, letter in enumerate(order):
                c = counts[part, step]
                c["kept"] += step < at
                c["removed"] += step == at
                c["redundant"] += step > at and letter in failed
                c["unique_fails"] += failed == {letter}
                c["good_lost"] += step == at and quality == 1
                c["toxic_lost"] += step == at and toxic == 1
            if at < 5:
                shapley[part, order[at]] += 1
        for (part, step), c in counts.items():
            found[part, "".join(order), step + 1] = dict(c)
    for (part, order, step), c in found.items():
        c["shapley"] = shapley[part, order[step - 1]]
    return found


def audit_rows():
    rng = random.Random(4)
    texts = []
    for i in range(120):
        words = rng.choices([f"w{k}" for k in range(rng.choice([3, 40, 400]))], k=rng.randint(30, 120))
        text = " ".join(words)
        if rng.random() < 0.3:
            text = text.upper()
        if rng.random() < 0.3:
            text += " " + rng.choice("#$%&*|")
        texts.append(text)
    texts += ["", None, "", "\t\n \x0b\x0c", "É" * 60, "one " * 49 + "\x00", " ".join("abcdef")] + texts[:30]
    rows = [
        (i, t, rng.choice(["web", "books", None, "", "a'b,c"]), rng.choice([0, 1, None]), rng.choice([0, 1]))
        for i, t in enumerate(texts)
    ]
    return rows + [(None, texts[0], "web", None, None), rows[3], rows[3]]


def test_audit_equals_every_order_by_hand(spark):
    rows = audit_rows()
    docs = spark.createDataFrame(
        [(r[0], r[1], r[2], "x", 1) for r in rows],
        "doc_id bigint, text string, source string, failed string, good int",
    ).repartition(3)
    labels = spark.createDataFrame(
        [(r[0], r[3], r[4]) for r in rows] + [(None, 1, 1), (99999, 1, 1)], "doc_id bigint, quality int, toxic int"
    )
    by_hand = {r[0]: (r[3], r[4]) for r in rows if r[0] is not None}
    marked = [(r[0], r[1], r[2], *(by_hand[r[0]] if r[0] is not None else (None, None))) for r in rows]
    found = {
        (r.part, r.filter_order, r.step): {
            k: v for k, v in r.asDict().items() if k not in ("part", "filter_order", "step")
        }
        for r in filter_audit.audit(docs, labels).collect()
    }
    assert found == audit_by_hand(marked)


def test_potentials_of_other_numbers_of_filters(spark):
    """The Shapley value from potentials is the mean over all orders, for any game of this kind."""
    rng = random.Random(2)
    for letters in ("A", "AB", "ABC", "ABCDEF"):
        cells = [("p", s, rng.randint(0, 9), 0, 0) for s in range(1 << len(letters))]
        frame = spark.createDataFrame(cells, "part string, failed int, n long, good long, toxic long")
        rows = filter_audit.steps(frame, letters).collect()
        sums = Counter()
        for r in rows:
            sums[r.filter_order[r.step - 1]] += r.removed
        assert len(rows) == len(letters) * math.factorial(len(letters))
        assert all(r.shapley == sums[r.filter_order[r.step - 1]] for r in rows)


def test_audit_of_nothing(spark, nothing):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(nothing, labels).count() == 0


# Ranked search


def search_by_hand(docs, items, k=10):
    def terms(text):
        lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
        return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lower)

    counted = [(i, Counter(terms(t))) for i, t in docs if i is not None and terms(t)]
    total, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    queries = defaultdict(list)
    for item_id, text in items:
        if item_id is not None:
            queries[item_id] += terms(text)
    found = []
    for item_id, own in queries.items():
        scores = []
        for doc_id, c in counted:
            m = 25 + 75 * sum(c.values()) * total // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in own if c[t]
            )
            if score > 0:
                scores.append((-score, doc_id))
        found += [(item_id, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scores)[:k])]
    return sorted(found)


ITEMS = [(1, "the an re"), (2, None), (None, "the"), (3, "a a b A"), (1, "subscribe"), (4, "%% ## !"), (5, "zzz nothere")]


def found_rows(frame):
    return sorted((r.item_id, r.rank, r.doc_id, r.score) for r in frame.collect())


@pytest.mark.parametrize("limits", [(1 << 20, 1 << 16, 4 << 20), (300, 5, 200)])
def test_search_equals_scoring_everything(spark, docs, rows, monkeypatch, limits):
    for name, value in zip(("CELL_POSTINGS", "CELL_DOCS", "PARTITION_TERMS"), limits):
        monkeypatch.setattr(lexical, name, value)
    texts = [r[1] for r in rows]
    asked = ITEMS + [(10 + i, texts[i]) for i in range(0, 60, 4)] + [(90, texts[70])]
    items = spark.createDataFrame(asked, "item_id bigint, text string")
    found = lexical.search(lexical.build(docs), items)
    assert found_rows(found) == search_by_hand([(r[0], r[1]) for r in rows], asked)


def test_ties_and_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ITEMS_AT_ONCE", 3)
    docs = [(i, "same words here") for i in range(40)] + [(100 + i, f"other words {'x ' * i}") for i in range(40)]
    items = [(i, f"words here number {i} x") for i in range(11)]
    index = lexical.build(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5))
    found = lexical.search(index, spark.createDataFrame(items, "item_id bigint, text string"))
    assert found_rows(found) == search_by_hand(docs, items)


def test_bands_of_lengths_rise():
    n = np.arange(1, 5000)
    bands = lexical.band(n)
    assert (np.diff(bands) >= 0).all() and bands[62] == 63 and np.diff(bands).max() == 1


def test_search_of_nothing(spark, nothing, docs):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert lexical.search(lexical.build(nothing), items).count() == 0
    assert lexical.search(lexical.build(docs), items.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op11_ranked_lexical_search", "op13_filter_interaction_audit"])
def test_queries_equal_sql(spark, name):
    from tablework.llm.queries import QUERIES, SQL

    found = oracle.rows(QUERIES[name](spark, SF).toPandas())
    assert found == oracle.rows(oracle.connect(SF).execute(SQL[name]).df())


def test_token_query(spark, tokenizer):
    found = token_files.op12_token_id_output(spark, SF).toPandas().sort_values("start")
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas().sort_values("doc_id")
    start, expected = 0, []
    for doc_id, text in docs[["doc_id", "text"]].itertuples(index=False):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert list(found.itertuples(index=False, name=None)) == expected
