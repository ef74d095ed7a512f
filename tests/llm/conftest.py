import random

import pytest

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, dropped string, "
    "key string, start int, sign binary, hashes string, component boolean"
)
SYLLABLES = "the an re th er on ti ed ha in or ou ea st nd".split()


def sentence(rng, words):
    made = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(words)]
    return " ".join(made).capitalize() + "."


def text(rng, sentences):
    return "\n".join(
        " ".join(sentence(rng, rng.randint(6, 14)) for _ in range(3)) for _ in range(sentences)
    )


def edited(rng, words, changes):
    words = words.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = "changed" + str(rng.randrange(10**6))
    return " ".join(words)


def item_texts():
    rng = random.Random(5)
    return [sentence(rng, n) for n in (15, 22, 39, 47, 60, 80, 9, 5, 3, 1)]


def make_texts():
    """Texts with every case that the operators must bear."""
    rng = random.Random(3)
    texts = [text(rng, rng.randint(1, 8)) for _ in range(60)]
    base = text(rng, 6)
    texts += [edited(rng, base, k) for k in range(12) for _ in range(3)]  # near copies
    texts += [base] * 5 + [texts[0].upper(), texts[0].replace(" ", "  ")]  # the same set of words
    line = "  Subscribe to the weekly letter of this page today \t"
    texts += [f"{text(rng, 2)}\n{line}\n{text(rng, 1)}\n{line.upper()}" for _ in range(9)]
    passage = " ".join(sentence(rng, 11) for _ in range(6))
    for _ in range(6):
        words = text(rng, 3).split(" ")
        words.insert(rng.randrange(len(words)), passage)
        texts.append(" ".join(words))
    for i, item in enumerate(item_texts()[:6]):
        for changes in (0, 1, 2):
            words = text(rng, 3).split(" ")
            words.insert(len(words) // (i % 3 + 1) - 1, edited(rng, item, changes))
            texts.append(" ".join(words))
    texts += ["", None, " \n\t ", "one", "one two three four", "one two three four", "a b c d e"]
    texts += ["spam " * 600, "\n" * 200, "x" * 50_000, " ".join(str(i) for i in range(9000))]
    texts += ["12345 %% ##", "Straße und Äpfel sind schön", "password = 'abcDEF123456'"]
    return texts


def make_rows():
    rows = [
        (i * 3 + 1, t, None if i % 7 == 0 else "en", None, len(t or ""), "d", "k", 1, b"s", "h", True)
        for i, t in enumerate(make_texts())
    ]
    rows += [rows[3], rows[3], rows[-9]]  # repeated rows
    rows += [(None, rows[3][1], *rows[3][2:]), (None, None, *rows[3][2:])]
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
