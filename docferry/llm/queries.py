"""The registered queries of this subpackage, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.llm import collocations, histogram_packing, hmm, licences, mixing, neighbours, packing, pfor, prefix_trie, quartile, similarity, toxicity, warc
from docferry.llm.common import crc_mod, read, scratch_path, ship
from docferry.llm.tokens import SPACED_RUNS, WORD_RUNS
from docferry.session import tune


def op1_hidden_markov_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probability under a hidden Markov model and a base."""
    return hmm.language_model(read(spark, sf_dir, "documents"), modulus=5, remainder=1)


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to deduplicated archives and read back."""
    path = scratch_path(spark, "warc")
    warc.write(read(spark, sf_dir, "pages"), path, min_bytes=0)
    return warc.read(spark, path)


def op3_quartile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all documents and of their edited texts."""
    return quartile.with_next(read(spark, sf_dir, "documents"))


def op4_pfor_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, written and read back."""
    path = scratch_path(spark, "pfor")
    pfor.write(read(spark, sf_dir, "documents"), path, tokenizer="word_bpe_49k.json",
               cuts=WORD_RUNS, end_id=2)
    return pfor.with_starts(pfor.read(spark, path))


def op5_parity_sketch_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near duplicates among all documents."""
    return similarity.near_duplicates(read(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1,024 ids."""
    rows = packing.pieces(read(spark, sf_dir, "documents"), tokenizer="byte_bpe_50k.json",
                          cuts=SPACED_RUNS, end_id=2)
    return packing.pack(rows)


def op7_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents repeated to square-root weights of their sources and
    shuffled globally, texts included."""
    mixed, p = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "text", F.col(p + "copy").cast("int").alias("copy"),
                        F.round(p + "rate", 6).alias("rate"), F.col(p + "key").alias("shuffle_key"))


def op8_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learnt from three of four labels."""
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), crc_mod("doc_id", 4) != 2)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op9_licence_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices found in every document."""
    found = licences.scan_documents(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_paragraphs", F.size("findings").alias("n_licences"),
                        F.array_sort(F.array_distinct("findings.family")).alias("families"), "findings")


def op10_multiprobe_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows found for every 20th vector."""
    return neighbours.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op11_shortest_pack_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4,096 ids."""
    rows = histogram_packing.encode(read(spark, sf_dir, "documents"), tokenizer="word_bpe_49k.json",
                                    cuts=WORD_RUNS, end_id=2)
    return histogram_packing.pack(rows)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return prefix_trie.trie(read(spark, sf_dir, "conversations"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2,000 best phrases of two and three words."""
    return collocations.collocations(read(spark, sf_dir, "documents"))


_QUERIES = (
    op1_hidden_markov_lm, op2_warc_revisits, op3_quartile_digest, op4_pfor_token_files, op5_parity_sketch_join,
    op6_best_fit_packing, op7_poisson_mix, op8_kneser_ney_toxicity, op9_licence_paragraphs,
    op10_multiprobe_neighbours, op11_shortest_pack_first,
    op12_prefix_trie, op13_phrase_collocations)
_SQL: dict[str, Callable[[], str]] = {
    "op2_warc_revisits": warc.oracle,
    "op7_poisson_mix": mixing.oracle,
    "op12_prefix_trie": prefix_trie.oracle,
    "op13_phrase_collocations": collocations.oracle,
}


def _tuned(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        ship(spark)
        return fn(spark, sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {fn.__name__: _tuned(fn) for fn in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {name: sql() for name, sql in _SQL.items()}
