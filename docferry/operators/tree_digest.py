"""One digest for a whole export: a hash tree over its lines in order (A3).

A leaf is the SHA-256 of ``0`` and a line, an inner node that of ``1`` and its
two children's hex digests; a node without a sibling goes up unchanged. The
root depends on the lines and their order alone, however the export is cut into
parts, and subtrees are computed anywhere and merged: lines are grouped by
position into chunks of 1,024, each hashed in one aggregate, and the chunks'
nodes in turn, so a table of n lines takes log(n) / 10 shuffles of digests.

``build`` returns the nodes of all levels from the chunks up, (level, idx, hash);
level 10 has the chunks. Two trees are compared from the root down (``changed_
chunks``), reading only children of nodes that differ; ``proofs`` gives the
siblings on a line's way to the root, which ``proven`` folds again.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STEP = 10
CHUNK = 1 << STEP
NODES = "level int, idx bigint, hash string"
#: The root of no lines.
EMPTY = hashlib.sha256(b"").hexdigest()


def leaf(line: Column) -> Column:
    return F.sha2(F.concat(F.lit("0"), line), 256)


def node(left: Column, right: Column) -> Column:
    return F.sha2(F.concat(F.lit("1"), left, right), 256)


def _level_up(hashes: Column) -> Column:
    """The parents of an aligned run of sibling nodes."""
    pairs = F.sequence(F.lit(0), F.floor((F.size(hashes) - 1) / 2).cast("int"))
    return F.transform(pairs, lambda j: F.when(
        j * 2 + 1 < F.size(hashes), node(F.get(hashes, j * 2), F.get(hashes, j * 2 + 1))).otherwise(F.get(hashes, j * 2)))


def _grouped(nodes: DataFrame) -> DataFrame:
    """(group, h0): the hashes of each ``CHUNK`` siblings, in order."""
    return nodes.groupBy(F.floor(F.col("idx") / CHUNK).cast("bigint").alias("group")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("idx", "hash"))), lambda x: x["hash"]).alias("h0"))


def _levels(groups: DataFrame) -> DataFrame:
    """``h1`` to ``h10``: the levels above ``h0``. Each is a column of its own
    select, so that no level is computed twice."""
    for k in range(1, STEP + 1):
        groups = groups.select("*", _level_up(F.col(f"h{k - 1}")).alias(f"h{k}"))
    return groups


def chunk_nodes(lines: DataFrame) -> DataFrame:
    """Level 10 of the tree over (idx, line)."""
    groups = _levels(_grouped(lines.select("idx", leaf(F.col("line")).alias("hash"))))
    return groups.select(F.lit(STEP).alias("level"), F.col("group").alias("idx"), F.get(f"h{STEP}", F.lit(0)).alias("hash"))


def build(lines: DataFrame, path: str) -> DataFrame:
    """Write the tree over ``lines`` (idx from 0, line) to ``path``; its nodes.
    The folder has one table for each ten levels."""
    spark = lines.sparkSession
    chunk_nodes(lines).write.mode("overwrite").parquet(f"{path}/above=0")
    base = STEP
    while True:
        last = spark.read.parquet(f"{path}/above={base - STEP}").filter(F.col("level") == base)
        if last.limit(2).count() < 2:
            return read(spark, path)
        groups = _levels(_grouped(last))
        # A level k above has at most CHUNK >> k nodes of the group.
        rows = groups.select("group", F.explode(F.array(*[
            F.struct(F.lit(k).alias("k"), F.col(f"h{k}").alias("h")) for k in range(1, STEP + 1)])).alias("e")).select(
            "group", "e.k", F.posexplode("e.h").alias("j", "hash"))
        rows.select((F.lit(base) + F.col("k")).cast("int").alias("level"),
                    (F.call_function("shiftright", F.col("group") * CHUNK, F.col("k")) + F.col("j")).cast("bigint").alias("idx"), "hash") \
            .write.mode("overwrite").parquet(f"{path}/above={base}")
        base += STEP


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("level", "idx", "hash")


def root(nodes: DataFrame) -> str:
    """The digest: the only node of the highest level."""
    top = nodes.orderBy(F.desc("level"), "idx").limit(1).collect()
    return top[0].hash if top else EMPTY


def changed_chunks(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """idx of the chunks in which two trees differ (or that one lacks), found
    from the root down: at each step only children of nodes that differ are
    compared."""
    tops = [d.agg(F.max("level")).first()[0] or STEP for d in (ours, theirs)]
    level = max(tops)
    spark = ours.sparkSession
    bad = spark.range(1).select(F.col("id").alias("idx"))
    above = level

    def at(nodes: DataFrame, top: int, name: str) -> DataFrame:
        # A tree without this level has its root as the level's first node.
        own = nodes.filter(F.col("level") == min(level, top))
        return own.select("idx", F.col("hash").alias(name))

    while True:
        pair = at(ours, tops[0], "a").join(at(theirs, tops[1], "b"), "idx", "full")
        parents = bad.select(F.col("idx").alias("up"))
        bad = (pair.filter(~F.col("a").eqNullSafe(F.col("b")))
               .join(parents, F.shiftright("idx", above - level) == F.col("up"), "left_semi").select("idx"))
        if level == STEP:
            return bad
        above, level = level, max(STEP, level - STEP)


def changed_lines(ours: DataFrame, theirs: DataFrame, chunks: DataFrame) -> DataFrame:
    """idx of the lines that differ, looked for in ``chunks`` only; ``ours`` and
    ``theirs`` are (idx, line)."""
    def of(lines: DataFrame, name: str) -> DataFrame:
        wanted = chunks.select(F.col("idx").alias("chunk"))
        return lines.join(wanted, F.shiftright("idx", STEP) == F.col("chunk"), "left_semi").select(
            "idx", leaf(F.col("line")).alias(name))

    return of(ours, "a").join(of(theirs, "b"), "idx", "full").filter(~F.col("a").eqNullSafe(F.col("b"))).select("idx")


def proofs(nodes: DataFrame, lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """(idx, steps) for the wanted lines' positions: the siblings from the leaf
    to the root, (level, left, hash) each. Of ``lines`` only the wanted lines'
    chunks are read."""
    chunks = wanted.select(F.shiftright("idx", STEP).alias("group")).distinct()
    rows = lines.join(chunks, F.shiftright("idx", STEP) == F.col("group"), "left_semi")
    inside = _levels(_grouped(rows.select("idx", leaf(F.col("line")).alias("hash"))))
    within = F.array(*[F.struct(
        F.lit(k).alias("level"), (F.shiftright("idx", k) % 2 == 1).alias("left"),
        F.get(f"h{k}", (F.shiftright("idx", k) % (CHUNK >> k)).bitwiseXOR(F.lit(1)).cast("int")).alias("hash"))
        for k in range(STEP)])
    low = wanted.select("idx", F.shiftright("idx", STEP).alias("group")).join(inside, "group").select(
        "idx", F.filter(within, lambda s: s["hash"].isNotNull()).alias("low"))
    top = nodes.agg(F.max("level")).first()[0] or STEP
    steps = wanted.select("idx", F.explode(F.sequence(F.lit(STEP), F.lit(max(top - 1, STEP)))).alias("level"))
    steps = steps.select("idx", "level", F.expr("shiftright(idx, level)").bitwiseXOR(F.lit(1).cast("bigint")).alias("sibling"))
    n = nodes.select(F.col("level"), F.col("idx").alias("sibling"), "hash")
    high = steps.join(n, ["level", "sibling"]).groupBy("idx").agg(F.array_sort(F.collect_list(
        F.struct("level", (F.col("sibling") % 2 == 0).alias("left"), "hash"))).alias("high"))
    return low.join(high, "idx", "left").select(
        "idx", F.concat("low", F.coalesce("high", F.array().cast("array<struct<level:int,left:boolean,hash:string>>")))
        .alias("steps"))


def proven(lines: DataFrame, proof: DataFrame, digest: str) -> DataFrame:
    """(idx, steps, proven): whether line and siblings lead to ``digest``."""
    got = F.aggregate("steps", leaf(F.col("line")), lambda h, s: F.when(s["left"], node(s["hash"], h)).otherwise(
        node(h, s["hash"])))
    return lines.join(proof, "idx").select("idx", F.size("steps").alias("steps"), (got == digest).alias("proven"))


def root_sql(lines: str) -> str:
    """DuckDB: the root over a query's column ``line`` in order of ``idx``."""
    levels = "\n".join(
        f", t{k} AS (SELECT list_transform(range(0, (len(h) + 1) // 2), lambda j: CASE WHEN 2 * j + 2 <= len(h) "
        f"THEN sha256('1' || h[2 * j + 1] || h[2 * j + 2]) ELSE h[2 * j + 1] END) AS h FROM t{k - 1})"
        for k in range(1, 31))
    return f"""t0 AS (SELECT list(sha256('0' || line) ORDER BY idx) AS h FROM ({lines})){levels}
SELECT coalesce(h[1], '{EMPTY}') AS root FROM t30"""
