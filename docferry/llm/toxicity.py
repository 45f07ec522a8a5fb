"""Toxicity by class-conditional Kneser-Ney models.

Two models, of toxic and of ordinary text, give every word a probability. A
word is its stem (the first ``STEM`` characters) and the word given the stem:

* ``P(stem)``: the class's discounted count, backing off to the number of
  different words with that stem in both classes together;
* ``P(word | stem)``: the class's discounted count, backing off to the word's
  share of the stem's occurrences in both classes together.

So rare expressions are smoothed through shared backoff counts, and a new form
of a stem that only toxic text uses is toxic evidence, too. Most words of a
toxic text are ordinary: its model is a mixture, ``1 - TOXIC_SHARE`` of the
ordinary model and ``TOXIC_SHARE`` of the toxic one. A text's evidence is the
sum of its words' log-likelihood ratios over its number of words plus
``PRIOR_WORDS``; a logistic curve, fitted on labelled rows that trained neither
model, turns it into a score in 0 to 1.

Words: runs of letters, digits and non-ASCII bytes, A-Z in lower case.

``fit`` learns from a bounded sample of the labelled rows: per class the
``MODEL_ROWS`` rows, and for the curve the ``CURVE_ROWS`` rows of any class, with
the lowest hashes of their ids. A rare class learns from fewer rows; how frequent
it is, is the curve's to know. Scoring covers all rows and whole texts.

Defined cases: a null or empty text has no evidence (the curve's value at 0); a
null label is no label, several labels of one id count as their largest; with
no toxic or no ordinary labelled row every score is that class's rate (0
without labels); null ids are scored and never learnt from; an empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from docferry.llm.common import settle, sole, utf8

MODEL_ROWS = 2_500
CURVE_ROWS = 6_000
DISCOUNT = 0.75
STEM = 4
TOXIC_SHARE = 0.005
PRIOR_WORDS = 5
LEAST_COUNT = 2  # words with fewer occurrences are known by their stem only
THRESHOLD = 0.3
CACHE_WORDS = 400_000

_SPLIT = bytes(b if (48 <= b < 58 or 97 <= b < 123 or b >= 128) else (b + 32 if 65 <= b < 91 else 32)
               for b in range(256))


def tokens(text: bytes) -> list[bytes]:
    return text.translate(_SPLIT).split()


def stem(word: bytes) -> str:
    return word.decode("utf-8", "replace")[:STEM]


def mixed(ratio: float) -> float:
    """Log-likelihood ratio of the mixture, from that of the toxic part."""
    return math.log(1 - TOXIC_SHARE + TOXIC_SHARE * math.exp(min(ratio, 50.0)))


class Evidence(dict):
    """word -> log-likelihood ratio. Words without a count of their own have
    their stem's; those are kept in a bounded cache."""

    def __init__(self, known: dict[bytes, float], stems: dict[str, float], unseen: float) -> None:
        super().__init__(known)
        self.known, self.stems, self.unseen = len(known), stems, unseen

    def __missing__(self, word: bytes) -> float:
        value = self[word] = self.stems.get(stem(word), self.unseen)
        return value

    def of(self, text: bytes) -> tuple[float, int]:
        if len(self) > self.known + CACHE_WORDS:
            kept = list(islice(self.items(), self.known + CACHE_WORDS // 2))
            self.clear()
            self.update(kept)
        found = tokens(text)
        return sum(map(self.__getitem__, found)), len(found)

    def __reduce__(self):
        return Evidence, (dict(islice(self.items(), self.known)), self.stems, self.unseen)


def train(counts: tuple[dict[bytes, int], dict[bytes, int]]) -> Evidence:
    """Word counts of ordinary and toxic rows -> evidence."""
    sizes = [max(1, sum(c.values())) for c in counts]
    stem_counts, stem_words = [Counter(), Counter()], [Counter(), Counter()]
    for y in (0, 1):
        for word, n in counts[y].items():
            stem_counts[y][stem(word)] += n
            stem_words[y][stem(word)] += 1
    both = Counter(counts[0])
    both.update(counts[1])
    both_stems, kinds = Counter(), Counter()  # occurrences, different words
    for word, n in both.items():
        both_stems[stem(word)] += n
        kinds[stem(word)] += 1
    total_kinds = max(1, len(both))

    def stem_prob(y: int, s: str) -> float:
        lower = kinds.get(s, 0.5) / total_kinds
        return (max(stem_counts[y].get(s, 0) - DISCOUNT, 0.0) + DISCOUNT * len(stem_counts[y]) * lower) / sizes[y]

    def word_prob(y: int, word: bytes, s: str) -> float:
        lower = both[word] / both_stems[s]
        here = stem_counts[y].get(s, 0)
        if not here:
            return lower
        return (max(counts[y].get(word, 0) - DISCOUNT, 0.0) + DISCOUNT * stem_words[y][s] * lower) / here

    stems = {s: math.log(stem_prob(1, s) / stem_prob(0, s)) for s in both_stems}
    known = {word: mixed(stems[stem(word)] + math.log(word_prob(1, word, stem(word)) / word_prob(0, word, stem(word))))
             for word, n in both.items() if n >= LEAST_COUNT}
    unseen = math.log(stem_prob(1, "") / stem_prob(0, "")) if "" not in stems else 0.0
    return Evidence(known, {s: mixed(r) for s, r in stems.items()}, mixed(unseen))


class Model:
    """Evidence and curve: score = 1 / (1 + exp(-(a + b * evidence)))."""

    def __init__(self, evidence: Evidence | None, a: float, b: float, constant: float | None = None) -> None:
        self.evidence, self.a, self.b, self.constant = evidence, a, b, constant

    def raw(self, text: bytes) -> float:
        total, n = self.evidence.of(text)
        return total / (n + PRIOR_WORDS)

    def score(self, text: bytes) -> float:
        if self.constant is not None:
            return self.constant
        z = max(-500.0, min(500.0, self.a + self.b * self.raw(text)))
        return 1.0 / (1.0 + math.exp(-z))


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4) -> tuple[float, float]:
    """Logistic regression on one standardised feature, by Newton steps."""
    mean, spread = (float(x.mean()), float(x.std()) or 1.0) if len(x) else (0.0, 1.0)
    z = np.column_stack([np.ones(len(x)), (x - mean) / spread])
    w = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + ridge * len(x) * w
        hess = (z * (p * (1 - p))[:, None]).T @ z + (ridge * len(x) + 1e-9) * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] - w[1] * mean / spread), float(w[1] / spread)


def _counts(sample: DataFrame) -> tuple[dict[bytes, int], dict[bytes, int]]:
    """Distinct texts of the sample that hold a word, by class, counted on
    Spark (so a text that repeats itself counts once)."""

    def count(batches):
        found = (Counter(), Counter())
        for batch in batches:
            for text, y in zip(utf8(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                found[y].update(set(tokens(text)))
        for y in (0, 1):
            words = list(found[y])
            yield pa.RecordBatch.from_arrays(
                [pa.array([y] * len(words), pa.int32()), pa.array(words, pa.binary()),
                 pa.array([found[y][w] for w in words], pa.int64())], names=["y", "word", "n"])

    rows = (sample.select("text", "y").distinct().mapInArrow(count, "y int, word binary, n long")
            .groupBy("y", "word").agg(F.sum("n").alias("n")).toArrow().to_pydict())
    out: tuple[dict, dict] = ({}, {})
    for y, word, n in zip(rows["y"], rows["word"], rows["n"], strict=True):
        out[y][word] = n
    return out


def fit(docs: DataFrame, labels: DataFrame, usable: Column, *, model_rows: int = MODEL_ROWS,
        curve_rows: int = CURVE_ROWS) -> Model:
    """Learn from the labelled rows whose doc_id satisfies ``usable``."""
    h = F.xxhash64(F.lit("toxicity"), F.col("doc_id"))
    y = F.col("toxic").cast("int")
    rows = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).filter(usable)
            .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.when(y > 0, 1).otherwise(0)).alias("y"))
            .withColumn("h", h).withColumn("curve", F.pmod(F.col("h"), F.lit(5)) == 0))
    picked = None
    for part in ([rows.filter(~F.col("curve") & (F.col("y") == c)).orderBy("h").limit(model_rows) for c in (0, 1)]
                 + [rows.filter("curve").orderBy("h").limit(curve_rows)]):
        picked = part if picked is None else picked.unionByName(part)
    # At most 2 * model_rows + curve_rows ids: small by construction.
    picked = settle(picked.select(F.col("doc_id").alias("l_id"), "y", "curve"), "labelled")
    sample = settle(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                    .join(F.broadcast(picked), F.col("doc_id") == F.col("l_id")).select("text", "y", "curve"), "sample")
    sizes = {(r["curve"], r["y"]): r["n"] for r in sample.groupBy("curve", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    toxic = sum(n for (_, c), n in sizes.items() if c)
    if not sizes.get((False, 0)) or not sizes.get((False, 1)):
        return Model(None, 0.0, 0.0, toxic / total if total else 0.0)
    model = Model(train(_counts(sample.filter("NOT curve"))), 0.0, 1.0)
    curve = sample.filter("curve") if sizes.get((True, 1)) and sizes.get((True, 0)) else sample
    points = score(curve.select("text", "y"), model, raw=True).select("score", "y").toArrow().to_pydict()
    model.a, model.b = fit_curve(np.array(points["score"], float), np.array(points["y"], float))
    return model


def score(docs: DataFrame, model: Model, *, raw: bool = False, column: str = "score") -> DataFrame:
    """``docs`` with the score of ``text`` (or its evidence) as a new column."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = docs.schema.fieldNames()
    at = fields.index("text")

    def add(batches):
        m = shared.value
        sole({})  # the model has a cache of its own
        for batch in batches:
            found = [m.raw(t) if raw else m.score(t) for t in utf8(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())],
                                             names=[*batch.schema.names, column])

    return docs.mapInArrow(add, StructType([*docs.schema.fields, StructField(column, DoubleType())]))
