"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

``rebuild`` replaces the first ``h`` turns of a conversation by those of its
base; ``nodes`` groups equal prefixes; ``subtree_totals`` sums weights over all
subtrees of a forest given as (node, parent) rows.

Sorting. Turns are dealt by ranges of (conversation, turn) and sorted in their
partitions; a turn's position, and the digest of the prefix that ends with it,
are running values inside a partition plus offsets of the conversations that
cross partitions (at most two for each partition). A conversation with a third
of all turns is thus split over tasks. A prefix is known by the XOR of 128-bit
digests of (position, role, text).

Contraction. Each round first rakes all leaves (their weights go to their
parents: one aggregate, which combines map-side, so that a node with very many
children is one row for each task) and then compresses chains: of the nodes
with one child, those whose hash exceeds parent's and child's leave, and the
child takes over the edge with the weight of what left. Rounds are logarithmic
in the nodes, also for a chain. Expansion goes back through the rounds: a raked
leaf's total was its weight when it left, a spliced node's is its child's total
plus what the edge held. Every state is written to the shared scratch folder.

Defined cases: null roles and texts are empty; turns are ordered with null
first, and of equal turn numbers by role, then text; rows without a conv_id
take no part; a base is ``c - c % 20`` with the sign of the dividend; a
conversation may have no turns after rebuilding and then belongs to the root
alone; an empty table has no nodes, root included. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docferry.llm.common import crc_mod, mix64, settle, shuffle_partitions

WORD = r"[^\x20\x09-\x0D]+"
BASE_EVERY = 20
MOST_BASE_TURNS = 3
CHUNK_BYTES = 1 << 18  # of a node's list of ids that goes from task to task as one row
HEAVY_SHARE = 1000     # a heavy parent has more than this part of all nodes as children

_KEY = ["depth", "x1", "x2"]


def _numbered(rows: DataFrame, ranges: list, order: list, *, xor: bool) -> DataFrame:
    """``rows`` (conv, digest, words and what ``order`` names) with the position
    ``pos`` of each row in its conversation (from 1); with ``xor`` (rows then
    have a ``pos``), also the row's tagged digest g1, g2 and its prefix's x1, x2."""
    spark = rows.sparkSession
    ordered = (rows.repartitionByRange(shuffle_partitions(spark), "conv", *ranges)
               .sortWithinPartitions("conv", *order).select("conv", "digest", "words", *(["pos"] if xor else [])))
    columns = ["g1", "g2", "x1", "x2"] if xor else ["digest"]
    schema = "conv long, part int, pos long, words long, " + ", ".join(
        f"{c} {'long' if xor else 'binary'}" for c in columns)

    def run(batches):
        part = TaskContext.get().partitionId()
        last, count, held = None, 0, np.zeros(2, np.uint64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            conv = np.asarray(batch.column("conv"), np.int64)
            starts = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
            run_of = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, n]))
            local = np.arange(n) - starts[run_of]
            if conv[0] != last:
                count, held = 0, np.zeros(2, np.uint64)
            pos = local + 1 + np.where(run_of == 0, count, 0)
            if xor:
                true_pos = np.asarray(batch.column("pos"), np.int64)
                digest = np.frombuffer(b"".join(batch.column("digest").to_pylist()), "<u8").reshape(n, 2)
                out = []
                for k in range(2):
                    tag = mix64(true_pos.astype(np.uint64) * np.uint64(2) + np.uint64(k))
                    g = mix64(digest[:, k] ^ tag)
                    total = np.bitwise_xor.accumulate(g)
                    before = np.where(starts > 0, total[starts - 1], np.uint64(0))
                    before[0] ^= held[k]
                    out += [(g, total ^ before[run_of])]
                held = np.array([out[0][1][-1], out[1][1][-1]], np.uint64)
                arrays = [out[0][0], out[1][0], out[0][1], out[1][1]]
                arrays = [pa.array(a.astype(np.int64)) for a in arrays]
                pos_out = true_pos
            else:
                arrays, pos_out = [batch.column("digest")], pos
            last, count = conv[-1], int(pos[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), pa.array([part] * n, pa.int32()), pa.array(pos_out),
                 batch.column("words"), *arrays], names=["conv", "part", "pos", "words", *columns])

    found = settle(ordered.mapInArrow(run, schema), "turns")
    # Conversations on both sides of a partition's border: at most one per border.
    edges = (found.groupBy("part").agg(F.array(F.min("conv"), F.max("conv")).alias("c"))
             .select("part", F.explode(F.array_distinct("c")).alias("conv")))
    crossing = edges.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("conv")
    carried = {"x1": F.max_by("x1", "pos"), "x2": F.max_by("x2", "pos")} if xor else {"pos": F.max("pos")}
    whole = found.join(F.broadcast(crossing), "conv").groupBy("conv", "part").agg(
        *[v.alias(c) for c, v in carried.items()])
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    total = F.bit_xor if xor else F.sum
    offsets = whole.select("conv", "part", *[F.coalesce(total(c).over(before), F.lit(0)).alias(f"before_{c}")
                                             for c in carried])
    # Two rows for each partition at most.
    out = found.join(F.broadcast(offsets), ["conv", "part"], "left")
    for c in carried:
        earlier = F.coalesce(F.col(f"before_{c}"), F.lit(0))
        out = out.withColumn(c, F.col(c).bitwiseXOR(earlier) if xor else F.col(c) + earlier)
    return out.drop("part", *[f"before_{c}" for c in carried])


def turns(conversations: DataFrame) -> DataFrame:
    """(conv, pos, digest, words): each conversation's turns in order."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"), role.alias("role"), text.alias("text"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    # Ranges are sampled: keys without whole texts, in the same order.
    head = F.when(F.length("role") < 64, F.substring("text", 1, 64)).otherwise("")
    return _numbered(rows, ["turn", F.substring("role", 1, 64), head], ["turn", "role", "text"], xor=False)


def rebuild(ordered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, conversations): the rebuilt turns (conv, pos, digest, words) and
    each conversation with its rebuilt length."""
    ordered = settle(ordered, "ordered")
    own = ordered.groupBy("conv").agg(F.max("pos").alias("n"))
    own = own.withColumn("h", crc_mod("conv", MOST_BASE_TURNS + 1)).withColumn(
        "base", F.col("conv") - F.col("conv") % BASE_EVERY)
    bases = own.filter("conv = base").select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = own.join(bases, "base", "left").withColumn("m", F.least("h", F.coalesce("base_n", F.lit(0)))).select(
        "conv", "base", "h", "m", (F.greatest(F.col("n") - F.col("h"), F.lit(0)) + F.col("m")).alias("length"))
    convs = settle(convs, "conversations")
    # Most bases are long enough: only the others' own turns move.
    moved = convs.filter("m < h").select("conv", (F.col("h") - F.col("m")).alias("shift"))
    later = (ordered.filter(F.col("pos") > crc_mod("conv", MOST_BASE_TURNS + 1)).join(moved, "conv", "left")
             .select("conv", (F.col("pos") - F.coalesce("shift", F.lit(0))).alias("pos"), "digest", "words"))
    first = ordered.filter((F.col("pos") <= MOST_BASE_TURNS) & (F.col("conv") % BASE_EVERY == 0)).withColumnRenamed(
        "conv", "base")
    copied = (convs.filter("m > 0").select("conv", "base", "m").join(first, "base").filter("pos <= m")
              .select("conv", "pos", "digest", "words"))
    return later.unionByName(copied), convs.select("conv", "length")


def _ends_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of each node's sorted list of ids. Lists are sorted and joined in
    ranges of (node, id), so that a long list is many tasks' work; a node's
    chunks then pass through one task in order, as the digest demands."""
    spark = ends.sparkSession
    n = shuffle_partitions(spark)
    key = "depth long, x1 long, x2 long, "

    def chunks(batches):
        node, first, size, ids = None, 0, 0, []
        out: list[tuple] = []

        def flush():
            if ids:
                out.append((*node, first, ",".join(ids)))

        for batch in batches:
            for row in zip(*[batch.column(k).to_pylist() for k in range(4)], strict=True):
                if row[:3] != node or size > CHUNK_BYTES:
                    flush()
                    node, first, size, ids = row[:3], row[3], 0, []
                text = str(row[3])
                ids.append(text)
                size += len(text) + 1
            if out:
                yield _batch(out, ["depth", "x1", "x2", "first", "ids"])
                out.clear()
        flush()
        if out:
            yield _batch(out, ["depth", "x1", "x2", "first", "ids"])

    def digests(batches):
        node, digest = None, None
        for batch in batches:
            out: list[tuple] = []
            for *row, ids in zip(*[batch.column(k).to_pylist() for k in (0, 1, 2, 4)], strict=True):
                if row != node:
                    if node:
                        out.append((*node, digest.hexdigest()))
                    node, digest = row, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if out:
                yield _batch(out, [*_KEY, "ends_sha256"])
        if node:
            yield _batch([(*node, digest.hexdigest())], [*_KEY, "ends_sha256"])

    parts = (ends.select(*_KEY, "conv").repartitionByRange(n, *_KEY, "conv").sortWithinPartitions(*_KEY, "conv")
             .mapInArrow(chunks, key + "first long, ids string"))
    return (parts.repartition(n, *_KEY).sortWithinPartitions(*_KEY, "first")
            .mapInArrow(digests, key + "ends_sha256 string"))


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=names)


def nodes(rows: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trie's nodes but the root: their key (depth, x1, x2), smallest member
    ``conv_id``, members, words of the last text, and the parent's key; and the
    digests of the ids that end at each node, the root included."""
    prefixes = settle(_numbered(rows, ["pos"], ["pos"], xor=True), "prefixes")
    found = prefixes.groupBy(F.col("pos").alias("depth"), "x1", "x2").agg(
        F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
        F.max(F.col("x1").bitwiseXOR(F.col("g1"))).alias("px1"), F.max(F.col("x2").bitwiseXOR(F.col("g2"))).alias("px2"))
    last = prefixes.groupBy("conv").agg(F.max_by(F.struct("pos", "x1", "x2"), "pos").alias("e"))
    ends = last.select("conv", F.col("e.pos").alias("depth"), "e.x1", "e.x2").unionByName(
        convs.filter("length = 0").select("conv", *[F.lit(0).cast("long").alias(k) for k in _KEY]))
    return settle(found, "nodes"), _ends_digests(ends)


def with_parents(found: DataFrame, total: int, root: int) -> DataFrame:
    """Nodes with ``parent_conv_id``. A parent with more than a thousandth of
    all nodes as children (there are under a thousand such) is broadcast, so
    its children aren't gathered by the join; the others are joined by key."""
    kids = found.groupBy((F.col("depth") - 1).alias("depth"), F.col("px1").alias("x1"), F.col("px2").alias("x2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    counted = settle(found.join(kids, _KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))),
                     "counted")
    parents = counted.filter("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("x1").alias("px1"), F.col("x2").alias("px2"),
        F.col("conv_id").alias("parent_conv_id"), (F.col("n_children") * HEAVY_SHARE > total).alias("heavy"))
    by = ["depth", "px1", "px2"]
    deep = counted.filter("depth > 1").join(
        F.broadcast(parents.filter("heavy").select(*by, F.col("parent_conv_id").alias("heavy_parent"))), by, "left")
    light = deep.filter("heavy_parent is null").drop("heavy_parent").join(
        parents.filter(~F.col("heavy")).drop("heavy"), by)
    heavy = deep.filter("heavy_parent is not null").withColumnRenamed("heavy_parent", "parent_conv_id")
    top = counted.filter("depth = 1").withColumn("parent_conv_id", F.lit(root).cast("long"))
    return light.unionByName(heavy).unionByName(top)


def _priority(node: str, round_no: int) -> Column:
    return F.xxhash64(F.col(node), F.lit(round_no))


def subtree_totals(tree: DataFrame, weights: list[str]) -> DataFrame:
    """(v, weights): the sum over each node's subtree of ``tree``'s weights.

    ``tree`` has one row for each node: ``v``, its parent ``p`` (null for a
    root) and integer weights. Nodes may be of any type that can be compared.
    """
    kids = tree.filter("p is not null").groupBy(F.col("p").alias("v")).agg(F.count(F.lit(1)).alias("k"))
    state = settle(tree.join(kids, "v", "left").select(
        "v", "p", F.coalesce("k", F.lit(0)).alias("k"), *weights,
        *[F.lit(0).cast("long").alias(f"edge_{w}") for w in weights]), "tree")
    leaf = F.col("p").isNotNull() & (F.col("k") == 0)
    raked, spliced = [], []
    round_no = 0
    while state.filter("p is not null").limit(1).count():
        round_no += 1
        # Rake: leaves give their weight and their edge's to the parent.
        given = state.filter("p is not null").groupBy(F.col("p").alias("v")).agg(
            *[F.sum(F.when(leaf, F.col(w) + F.col(f"edge_{w}")).otherwise(0)).alias(f"given_{w}") for w in weights],
            F.count(F.when(~leaf, 1)).alias("kids"), F.min(F.when(~leaf, F.col("v"))).alias("kid"))
        raked.append(state.filter(leaf).select("v", *weights))
        # Compress: nodes with one child whose hash is the largest of the three.
        alone = (F.col("p").isNotNull() & (F.col("k") == 1) & (_priority("v", round_no) > _priority("kid", round_no))
                 & (_priority("v", round_no) > _priority("p", round_no)))
        middle = settle(state.filter(~leaf).join(given, "v", "left").select(
            "v", "p", F.coalesce("kids", F.lit(0)).alias("k"), "kid",
            *[(F.col(w) + F.coalesce(f"given_{w}", F.lit(0))).alias(w) for w in weights],
            *[f"edge_{w}" for w in weights]).withColumn("alone", F.coalesce(alone, F.lit(False))), "raked")
        messages = middle.filter("alone").select(
            F.col("kid").alias("v"), F.col("v").alias("gone"), F.col("p").alias("up"),
            *[F.col(w).alias(f"gone_{w}") for w in weights],
            *[F.col(f"edge_{w}").alias(f"gone_edge_{w}") for w in weights])
        state = settle(middle.filter("not alone").join(messages, "v", "left").select(
            "v", F.coalesce("up", "p").alias("p"), "k", *weights,
            *[(F.col(f"edge_{w}") + F.coalesce(F.col(f"gone_{w}") + F.col(f"gone_edge_{w}"), F.lit(0))).alias(f"edge_{w}")
              for w in weights],
            "gone", *[(F.col(f"gone_{w}") + F.col(f"edge_{w}")).alias(f"add_{w}") for w in weights]), "state")
        spliced.append(state.filter("gone is not null").select("gone", "v", *[f"add_{w}" for w in weights]))
    # Expand: the last round's nodes first. What is alive after a round has its
    # total before the round's own nodes are added.
    totals = state.select("v", *weights)
    for gone, leaves in zip(reversed(spliced), reversed(raked), strict=True):
        back = gone.join(totals, "v").select(
            F.col("gone").alias("v"), *[(F.col(f"add_{w}") + F.col(w)).alias(w) for w in weights])
        totals = settle(totals.unionByName(back).unionByName(leaves), "totals")
    return totals


def trie(conversations: DataFrame) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations."""
    rows, convs = rebuild(turns(conversations))
    all_convs = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("least")).first()
    found, ends = nodes(rows, convs)
    found = with_parents(found, found.count(), all_convs.least)
    top = convs.sparkSession.range(1 if all_convs.n else 0).select(
        *[F.lit(0).cast("long").alias(k) for k in _KEY], F.lit(all_convs.least).cast("long").alias("conv_id"),
        F.lit(all_convs.n).cast("long").alias("n_convs"), F.lit(0).cast("long").alias("words"),
        F.lit(None).cast("long").alias("parent_conv_id"))
    top = top.withColumn("n_children", F.lit(found.filter("depth = 1").count()).cast("long"))
    found = settle(found.drop("px1", "px2").unionByName(top).join(ends, _KEY, "left"), "trie")
    ids = F.struct(F.col("conv_id").alias("c"), F.col("depth").alias("d"))
    tree = found.select(
        ids.alias("v"), F.when(F.col("depth") > 0, F.struct(F.col("parent_conv_id").alias("c"),
                                                            (F.col("depth") - 1).alias("d"))).alias("p"),
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    totals = subtree_totals(tree, ["n_leaves", "saved_tokens"])
    return found.withColumn("v", ids).join(totals, "v").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("n_children").cast("long").alias("n_children"),
        "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def oracle() -> str:
    """The same nodes in DuckDB: prefixes as lists, subtrees by joining each
    node with all its ancestors."""
    crc_step = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    table = f"list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda x, y: {crc_step}))"
    return f"""WITH crc AS (SELECT {table} AS t),
turns AS (
  SELECT CAST(conv_id AS BIGINT) AS c, coalesce(role, '') AS role, coalesce(text, '') AS txt,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 20 AS b, xor(list_reduce(list_prepend(4294967295,
      list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
      lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT c FROM turns), crc),
rebuilt AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, pos) AS pos, role, txt FROM (
    SELECT v.c, 0 AS own, t.pos, t.role, t.txt FROM convs v JOIN turns t ON t.c = v.b AND t.pos <= v.h
    UNION ALL
    SELECT v.c, 1, t.pos, t.role, t.txt FROM convs v JOIN turns t ON t.c = v.c AND t.pos > v.h)),
lists AS (
  SELECT v.c, coalesce(l, []) AS l FROM convs v LEFT JOIN (
    SELECT c, list({{'r': role, 't': txt}} ORDER BY pos) AS l FROM rebuilt GROUP BY c) USING (c)),
prefixes AS (SELECT c, l, unnest(range(len(l) + 1)) AS d FROM lists),
keyed AS (SELECT c, d, len(l) = d AS ends, sha256(CAST(l[1:d] AS VARCHAR)) || md5(CAST(l[1:d] AS VARCHAR)) AS k,
  CASE WHEN d > 0 THEN len(regexp_extract_all(l[d].t, '[^\\x20\\x09-\\x0D]+')) ELSE 0 END AS words FROM prefixes),
grouped AS (
  SELECT d, k, min(c) AS conv_id, count(*) AS n_convs, max(words) AS words,
    sha256(coalesce(string_agg(CASE WHEN ends THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '')) AS ends_sha256
  FROM keyed GROUP BY d, k),
member AS (SELECT x.c, g.* FROM keyed x JOIN grouped g ON g.d = x.d AND g.k = x.k),
edges AS (
  SELECT g.conv_id, g.d, m.conv_id AS parent_conv_id FROM grouped g
  LEFT JOIN member m ON m.c = g.conv_id AND m.d = g.d - 1),
kids AS (SELECT parent_conv_id AS conv_id, d - 1 AS d, count(*) AS n FROM edges WHERE d > 0 GROUP BY ALL),
full_nodes AS (
  SELECT g.*, e.parent_conv_id, coalesce(n, 0) AS n_children FROM grouped g
  JOIN edges e ON e.conv_id = g.conv_id AND e.d = g.d LEFT JOIN kids ON kids.conv_id = g.conv_id AND kids.d = g.d),
totals AS (
  SELECT m.conv_id, m.d, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
    sum((f.n_convs - 1) * f.words) AS saved
  FROM full_nodes f JOIN member m ON m.c = f.conv_id AND m.d <= f.d GROUP BY ALL)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, f.parent_conv_id, f.n_convs, f.n_children,
  CAST(t.n_leaves AS BIGINT) AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, f.ends_sha256
FROM full_nodes f JOIN totals t ON t.conv_id = f.conv_id AND t.d = f.d"""
