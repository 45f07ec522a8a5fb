from __future__ import annotations

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    """Give the package to the Python workers."""
    from docferry.llm.common import ship

    ship(spark)


def _words(n: int, seed: int) -> str:
    """Invented prose of n words, the same for the same seed."""
    parts = ["al", "be", "cor", "di", "en", "fu", "gra", "hi", "jo", "ka"]
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(parts[x % 10] + parts[x // 10 % 10] + parts[x // 100 % 10])
    return " ".join(out)


@pytest.fixture(scope="session")
def words():
    return _words


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows
    and extra columns whose names the operators use themselves."""
    long = _words(30_000, 3)
    base = _words(120, 1)
    rows = [
        (1, base, "en", "a", 10), (2, base, "en", "a", 10), (3, base.upper(), None, "b", None),
        (4, base.replace("al", "zz", 1), "en", None, 5), (5, None, "en", "a", None), (6, "", "de", "b", 0),
        (7, " \t\n ", "de", "b", 4), (8, "one two", "en", "a", 7), (9, long, "en", "a", len(long)),
        (10, long + " tail", "en", "c", len(long) + 5), (None, _words(60, 9), "en", "a", 1),
        (None, base, "en", "a", 1), (11, "naïve café — ☃ 𝄞  x", "fr", "c", 20),
        (12, _words(40, 12), "en", "a", 3), (12, _words(40, 12), "en", "a", 3), (13, "a\x00b\x1cc \x85d", "en", "a", 9),
        (14, "<|endoftext|> <|startoftext|> it's", "en", "d", 9),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("cls", "score", "key", "piece", "m_rate", "mix_rate", "near_id", "toxicity_", "start"):
        df = df.withColumn(name, F.lit("x"))
    return df


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
