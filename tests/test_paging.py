"""K1-K5."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from docferry.operators.paging import iter_pages, keyset_page, page_numbers


def test_pages_of_seven(spark):
    df = spark.range(7).select(F.col("id").alias("k"))
    sizes = [len(p) for p in iter_pages(df, ["k"], 2)]
    assert sizes == [2, 2, 2, 1]


def test_keyset_composite(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 0), (2, 5), (3, 1)], "a int, b int")
    assert [tuple(r) for r in keyset_page(df, ["a", "b"], 2, (1, 2)).collect()] == [(2, 0), (2, 5)]
    with pytest.raises(ValueError):
        keyset_page(df, ["a"], 0)


def test_page_numbers_match_brute_force(spark):
    df = spark.range(0, 2500, 1, 7).select(((F.col("id") * 7919) % 2500).alias("k"))
    got = {r.k: r.page for r in page_numbers(df, ["k"], 100).collect()}
    assert len(got) == 2500
    assert all(got[k] == k // 100 for k in range(2500))


def test_null_and_repeated_keys_are_errors(spark):
    nulls = spark.createDataFrame([(1,), (2,), (None,), (3,), (None,)], "k int")
    with pytest.raises(ValueError, match="no value"):
        list(iter_pages(nulls, ["k"], 2))
    ties = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d")], "k int, v string")
    with pytest.raises(ValueError, match="unique"):
        list(iter_pages(ties, ["k"], 2))
    assert [len(p) for p in iter_pages(ties, ["k", "v"], 2)] == [2, 2]
