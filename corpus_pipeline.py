"""The corpus pipeline: four stages over ``documents``, each one operator of
``docferry.llm``, written as Parquet in between.

1. toxicity: documents whose toxicity score reaches the threshold go;
2. ngram_jaccard: of each group of near duplicates the smallest id stays;
3. mix: documents are repeated to square-root weights of their sources and
   shuffled globally (a document may be dropped or repeated: its count is a
   Poisson draw with the source's rate as its mean);
4. pack: what is left is packed into sequences of 1,024 ids.

Every stage takes (spark, docs, sf_dir) and works on all rows it is given; all
but the last return the columns of ``docs``.

Defined cases: nulls and empty texts pass stage 1 unless their score says
otherwise; in stage 2 rows with the same id and near texts are one document,
those with other texts stay; a null id keeps its row unless its text is a near
duplicate of one with an id, or of another with a null id; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.llm import mixing, packing, similarity, toxicity
from docferry.llm.common import crc_mod, read, settle, ship, unused
from docferry.llm.tokens import SPACED_RUNS
from docferry.session import tune


CACHE_CHUNKS = 500_000  # workers hold memory of the stages before this one, too
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _ready(spark: SparkSession) -> None:
    tune(spark)
    ship(spark)
    if spark.conf.get(BATCH, None) is None:  # whole texts: some thousand rows at a time
        spark.conf.set(BATCH, "2000")


def _kept_columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject."""
    _ready(spark)
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), crc_mod("doc_id", 4) != 2)
    column = unused(docs, "toxicity_")
    scored = toxicity.score(docs, model, column=column)
    return scored.filter(F.col(column) < toxicity.THRESHOLD).select(*_kept_columns(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id."""
    _ready(spark)
    return similarity.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the copies that their sources' rates draw, shuffled."""
    _ready(spark)
    return mixing.mix(docs)[0].select(*_kept_columns(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    _ready(spark)
    return packing.pack(packing.pieces(docs, tokenizer="byte_bpe_50k.json", cuts=SPACED_RUNS, end_id=2,
                                       cache_chunks=CACHE_CHUNKS))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_duplicates),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: Trained models and tokenizers aren't SQL; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
