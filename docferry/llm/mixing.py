"""Mixing sources to target weights by Poisson replication (DataFrame only).

A source's target repetition rate is ``epochs * weight / share``: its target
share of all characters over its present share. Each document draws a Poisson
count with that mean, by inverting the distribution at a number in [0, 1) from
a hash of seed and id, is repeated that often, and the copies are shuffled
globally: dealt to partitions and sorted in them by a second hash.

Default weights are ``characters ** alpha`` (0.5: large sources count less,
small ones more); a table (source, weight) replaces them. Rates above 256 are
drawn as a sum of independent parts, as a Poisson count allows, so the table of
the distribution stays small.

The table of sources is broadcast where it has at most ``BROADCAST_SOURCES``
rows (some 4 kB each at most); beyond that the documents join it by source and
one of 64 salts, so that a source with a third of all rows is 64 keys.

Defined cases: a null text counts no characters; a null source is a source; a
source without characters, or missing from a given weight table, has rate
``epochs`` or 0; a null id draws by its text; equal rows draw the same count;
an empty table gives no rows. Other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docferry.llm.common import settle, unused

SEED = "mix-1"
ALPHA = 0.5
PART = 256.0
BROADCAST_SOURCES = 2_000
SALTS = 64
HASH_STEPS = 4503599627370496.0  # 13 hex digits


def _unit(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the joined parts."""
    h = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / F.lit(HASH_STEPS)


def _key(docs: DataFrame) -> Column:
    return F.coalesce(F.col("doc_id").cast("string"),
                      F.concat(F.lit("text "), F.md5(F.coalesce(F.col("text"), F.lit("")))))


def rates(docs: DataFrame, *, weights: DataFrame | None = None, alpha: float = ALPHA,
          epochs: float = 1.0) -> DataFrame:
    """One row for each source: source, chars, rate, parts, cdf."""
    chars = (docs.groupBy("source")
             .agg(F.sum(F.char_length(F.coalesce(F.col("text"), F.lit("")))).cast("double").alias("chars")))
    if weights is None:
        chars = chars.withColumn("weight", F.pow(F.col("chars"), F.lit(float(alpha))))
    else:
        w = weights.groupBy(F.col("source").alias("w_source")).agg(F.sum("weight").cast("double").alias("weight"))
        chars = chars.join(w, F.col("source").eqNullSafe(F.col("w_source")), "left") \
            .select("source", "chars", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    chars = settle(chars, "sources")
    total, weight = chars.agg(F.sum("chars"), F.sum(F.when(F.col("chars") > 0, F.col("weight")))).first()
    rate = F.when(F.col("chars") > 0,
                  F.lit(float(epochs) * (total or 0.0) / (weight or 1.0)) * F.col("weight") / F.col("chars")) \
        .otherwise(F.lit(float(epochs)))
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / F.lit(PART)).cast("int"))
    each = F.col("rate") / F.col("parts")
    top = F.ceil(each + 10 * F.sqrt(each) + 20).cast("int")
    first = F.exp(-each)
    cdf = F.aggregate(
        F.sequence(F.lit(1), top),
        F.struct(first.alias("p"), F.array(first).alias("c")),
        lambda a, k: F.struct((a["p"] * F.col("each") / k).alias("p"),
                              F.concat(a["c"], F.array(F.element_at(a["c"], -1) + a["p"] * F.col("each") / k)).alias("c")),
        lambda a: a["c"])
    return (chars.withColumn("rate", rate).withColumn("parts", parts).withColumn("each", each)
            .withColumn("cdf", cdf).select("source", "chars", "rate", "parts", "cdf"))


def replicate(docs: DataFrame, table: DataFrame, *, seed: str = SEED) -> tuple[DataFrame, str]:
    """Every document as often as it draws, in global random order, with three
    more columns, ``rate``, ``copy`` (from 0) and ``key`` behind the prefix that
    is returned, too (no column of ``docs`` begins with it)."""
    p = unused(docs, "mix_")
    c = {n: F.col(p + n) for n in ("source", "rate", "parts", "cdf", "salt", "own", "unit", "count", "copy", "key")}
    table = settle(table.select(*[F.col(n).alias(p + n) for n in ("source", "rate", "parts", "cdf")]), "rates")
    cols = [F.col(f"`{x}`") for x in docs.columns]
    same = F.col("source").eqNullSafe(c["source"])
    key = _key(docs)
    if table.count() <= BROADCAST_SOURCES:
        joined = docs.join(F.broadcast(table), same)
    else:
        salted = table.withColumn(p + "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = docs.withColumn(p + "own", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int"))
        joined = dealt.join(salted, same & (c["own"] == c["salt"]))
    drawn = F.aggregate(
        F.sequence(F.lit(0), c["parts"] - 1), F.lit(0),
        lambda n, j: n + F.size(F.filter(c["cdf"], lambda v: v <= _unit(F.lit(seed), key, j.cast("string")))))
    one = F.size(F.filter(c["cdf"], lambda v: v <= c["unit"]))
    copies = (joined.withColumn(p + "unit", _unit(F.lit(seed), key, F.lit("0")))
              .withColumn(p + "count", F.when(c["parts"] == 1, one).otherwise(drawn)).filter(c["count"] > 0)
              .withColumn(p + "copy", F.explode(F.sequence(F.lit(0), c["count"] - 1))))
    order = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), key, c["copy"].cast("string"))),
                               1, 15), 16, 10).cast("long")
    out = copies.select(*cols, c["rate"], c["copy"], order.alias(p + "key"))
    return out.repartition(p + "key").sortWithinPartitions(p + "key"), p


def mix(docs: DataFrame, *, seed: str = SEED, **how) -> tuple[DataFrame, str]:
    """``rates`` and ``replicate`` in one."""
    return replicate(docs, rates(docs, **how), seed=seed)


def oracle() -> str:
    return f"""
        WITH s AS (SELECT source, sum(length(coalesce(text, '')))::DOUBLE AS chars FROM documents GROUP BY 1),
        t AS (SELECT sum(chars) AS total, sum(pow(chars, {ALPHA})) AS weight FROM s),
        r AS (SELECT source, CASE WHEN chars > 0 THEN total / weight * pow(chars, {ALPHA}) / chars ELSE 1.0 END AS rate
              FROM s, t),
        k AS (SELECT source, rate, unnest(range(0, ceil(rate + 10 * sqrt(rate) + 21)::BIGINT)) AS k FROM r),
        c AS (SELECT source, rate, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1)))
                     OVER (PARTITION BY source ORDER BY k) AS cdf FROM k),
        u AS (SELECT *, ('0x' || substr(md5('{SEED}:' || doc_id || ':0'), 1, 13))::BIGINT / {HASH_STEPS} AS u
              FROM documents),
        n AS (SELECT u.doc_id, any_value(c.rate) AS rate, count(*) AS n FROM u JOIN c ON c.source = u.source
              AND c.cdf <= u.u GROUP BY 1),
        e AS (SELECT doc_id, rate, unnest(range(0, n)) AS copy FROM n)
        SELECT d.doc_id, d.source, d.text, e.copy::INT AS copy, round(e.rate, 6) AS rate,
               ('0x' || substr(md5('{SEED}:order:' || d.doc_id || ':' || e.copy), 1, 15))::BIGINT AS shuffle_key
        FROM e JOIN documents d USING (doc_id)"""
