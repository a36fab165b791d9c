import random
from pathlib import Path

import pytest

PUBLIC = Path("/opt/tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, doc string, fp long, start long, copy string, words string, n_lines string"


@pytest.fixture(scope="session")
def tricky():
    """Rows with nulls, empty and very long texts, ties, repeated rows and repeated ids."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghijklmnoprstuvwz", k=rng.randint(1, 9)))
    vocabulary = [word() for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ",", "."]) for _ in range(n))
    paged = lambda n: "\n".join(prose(rng.randint(3, 14)) for _ in range(n))
    base = [paged(8) for _ in range(6)]
    texts = [None, "", " \t\n ", "a", "one two", "Word\nWORD\nword\n", base[0], base[0], base[0].upper(), base[1].replace("a", "á"), base[1], base[2] + "\n" + base[3], base[3], "\n\n\n", paged(400), prose(12_000)]
    texts += ["ÄÖÜ ß straße  doppelt\tTab\r\nİstanbul ΣΑΣ", "日本語のテキスト " * 40, "x" * 5000, "!!! ??? ... 123 456"]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(None, base[4]), (None, None), (7, base[0]), (7, base[5]), (10, base[1])]
    return rows


@pytest.fixture(scope="session")
def docs(spark, tricky):
    return spark.createDataFrame([(i, t, None, None, None, "x", 1, 2, "c", "w", "n") for i, t in tricky], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def vocab():
    return lambda name: str(PUBLIC / name)


def low(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
