"""The pipeline and the registered queries of this subpackage."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from docferry.llm import mixing, packing, queries, similarity, toxicity
from docferry.llm.common import crc_mod, read
from docferry.sources.tables import TABLE_NAMES

SMALL = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "mix", "pack"]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = entry.queries()[name](spark, SMALL)
    cur = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert sorted(repr(tuple(r[c] for c in cols)) for r in df.collect()) == sorted(map(repr, cur.fetchall()))


def test_stages_one_by_one(spark):
    docs = read(spark, SMALL, "documents")
    model = toxicity.fit(docs, read(spark, SMALL, "labels"), crc_mod("doc_id", 4) != 2)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    clean = corpus_pipeline.drop_toxic(spark, docs, SMALL)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {d for d, s in scores.items() if s < toxicity.THRESHOLD}
    single = corpus_pipeline.drop_near_duplicates(spark, clean, SMALL)
    groups = similarity.near_duplicates(clean).collect()
    assert single.columns == docs.columns
    assert sorted(r.doc_id for r in single.collect()) == sorted({r.component_id for r in groups})
    mixed = corpus_pipeline.mix_sources(spark, single, SMALL)
    assert mixed.columns == docs.columns
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(r.doc_id for r in mixing.mix(single)[0].collect())
    packed = corpus_pipeline.pack_sequences(spark, mixed, SMALL).collect()
    n = sum(r.length for r in packing.pieces(mixed, tokenizer="byte_bpe_50k.json").collect())
    assert sum(r.length for r in packed) == n and len({r.sequence_id for r in packed}) <= -(-n // 1024) + 2


def test_stages_take_odd_and_empty_tables(spark, odd_docs, no_docs, tmp_path):
    spark.createDataFrame([(1, 0, 0), (2, 0, 1), (None, None, None)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            if name != "pack":
                assert out.columns == docs.columns
                docs = out
        assert out.count() >= 0
