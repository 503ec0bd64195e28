"""Small tables with every odd case, and brute-force twins of shared parts."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns named like those the operators make on the way.
CLASHES = "row long, size long, copies int, print long, `_row` long, batch string, `key` string, n int, kept int"


def sentence(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def odd_texts():
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(400)]
    vocabulary += ["Über", "naïve", "日本語", "слово", "x y", "a\u0085b", "😀"]
    texts = [None, "", " ", "\n", "\n\n", "\t \x0b\x0c\r", "one", "One", "ONE two three", "ÀÉ", "àé"]
    texts += [sentence(rng, rng.randint(3, 120), vocabulary) for _ in range(60)]
    texts += ["\n".join(sentence(rng, 8, vocabulary) for _ in range(rng.randint(1, 9))) for _ in range(25)]
    base = sentence(rng, 150, vocabulary)
    texts += [base, base.upper(), base + " x", base.replace(" ", "  "), base, base]
    texts += ["shared line number one of all\n" + t for t in texts[20:26]]
    texts += ["  SHARED line number one of all \nnineteen characters\n" + (texts[30] or "")] * 2
    texts += [sentence(rng, 40_000, vocabulary), "z" * 70_000, " ".join(["again"] * 3000), "日本語" * 9000]
    texts += ["<|endoftext|> and <|startoftext|>x", "it's we'll 'S don't  \n  '", "null\x00byte", "\\\\ <turn> </turn>"]
    return texts


@pytest.fixture(scope="session")
def odd_rows():
    rng = random.Random(3)
    rows = []
    for i, text in enumerate(odd_texts()):
        source = rng.choice(["a", "b", "B", "é", None, "hot", "hot", "hot"])
        rows.append((i * 7 % 1009, text, rng.choice(["en", None]), source, len(text) if text else None))
    rows += [(None, "no id at all, no id at all", "en", "a", 1), (None, None, None, None, None)]
    rows += [rows[25]] * 3 + [rows[60]] * 2  # equal rows
    rows += [(rows[30][0], "another text of the same id", "en", "b", 1)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def clashing(spark, odd_rows):
    rows = [(*r, 1, 2, 3, 4, i, "b", "k", 6, 7) for i, r in enumerate(odd_rows)]
    return spark.createDataFrame(rows, f"{SCHEMA}, {CLASHES}").repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def folder(tmp_path):
    """Write a frame as a table of a new directory, which is returned."""

    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write


def words_of(text):
    return (text or "").encode().split()


def plain(text):
    return (text or "").encode().lower()
