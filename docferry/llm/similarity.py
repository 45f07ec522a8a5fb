"""Near-duplicate join of word shingles by parity sketches (Jaccard >= 0.75).

Exact: every pair of texts whose sets of five-word shingles have a Jaccard
similarity of 0.75 or more is linked, and no other.

1. ``profile``: each document's number of shingles and the digest of its set.
   Documents with equal sets are one class from here on.
2. ``keys``: a class takes part in one or two levels of size (see ``shingles``);
   its set falls into the level's blocks, each sketched by XOR. Sketches of
   partners differ in at most as many blocks as their sets do in elements, so
   partners share a known number of block keys (pigeonhole). A task gives the
   keys of a set once, however many copies it reads.
3. ``survivors``: classes with fewer keys in common with any others than a
   partner would have, drop out; what is left is read again as sets, and those
   with less than 3/4 of their shingles in common with other survivors drop
   out, too. Both tests are necessary conditions: no link is lost. A passage
   that thousands of documents share goes no further than here.
4. ``links``: survivors keep their rarest keys, as many as a partner must share
   one of, and buckets with the same members count once. First ``STARS`` members
   of each bucket, one after another and the same ones in most buckets of a
   group, are compared with the others, so a group of near copies is a few
   stars, not all its pairs. Then members of a bucket whose components still
   differ are compared by their parity sketches, block by block inside a task;
   only pairs whose Hamming distance is within their largest symmetric
   difference leave it and are counted exactly.
5. ``components`` joins the links by taking the smallest neighbour, following
   parents and contracting, as joins.

Sets are 64-bit hashes of shingles; classes are 64-bit digests.

Defined cases: a null or empty text, or one without words, has 0 shingles and
links with nothing; a text with fewer than five words is one shingle; repeated
rows and equal texts are one component; a component's id is the smallest id in
it, null only where all ids are; an empty table gives no rows. Other columns
are ignored.
"""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from docferry.llm.common import release, settle, unused, utf8
from docferry.llm.shingles import block_keys, levels, scrambled, set_digests, shingle_sets, sketch

BROADCAST_IDS = 300_000  # ids of 8 bytes; beyond that they are joined by shuffle
STARS = 3  # leaders of a bucket that are compared with all its members first
EARLIER = 8  # keys of a class before a bucket's, by which a pair is known to be compared already
CHUNK = 2_048  # members of a bucket compared in one task; larger buckets are cut
ROWS_OUT = 200_000
BATCH_ROWS = 1_000


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def profile(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, cls (null without shingles)."""

    def run(batches):
        for batch in batches:
            sets = shingle_sets(utf8(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(set_digests(sets), pa.int64())],
                names=["doc_id", "n_shingles", "cls"])

    return _texts(docs).mapInArrow(run, "doc_id long, n_shingles long, cls long")


def keys(docs: DataFrame) -> DataFrame:
    """key, cls, tag: block keys of every class; tag is level * 2^32 + the
    number of keys that partners share at least."""

    def run(batches):
        seen: set[int] = set()
        out: list[tuple[np.ndarray, int, int]] = []
        held = 0

        def flush():
            sizes = [len(k) for k, _, _ in out]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([k for k, _, _ in out]).view(np.int64)),
                 pa.array(np.repeat(np.array([c for _, c, _ in out], np.int64), sizes)),
                 pa.array(np.repeat(np.array([t for _, _, t in out], np.int64), sizes))],
                names=["key", "cls", "tag"])

        for batch in batches:
            sets = shingle_sets(utf8(batch.column(0)))
            for s, cls in zip(sets, set_digests(sets), strict=True):
                if cls is None or cls in seen:
                    continue
                seen.add(cls)
                mixed = scrambled(s)
                for level, spoilt in levels(len(s)):
                    k, need = block_keys(s, level, spoilt, mixed)
                    out.append((k, cls, level << 32 | need))
                    held += len(k)
                if held > ROWS_OUT:
                    yield flush()
                    out, held = [], 0
        if out:
            yield flush()

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "key long, cls long, tag long")


def _shared(rows: DataFrame) -> DataFrame:
    """Rows whose key another class has, too, with the key's number of rows."""
    w = W.partitionBy("key")
    return (rows.withColumn("lo", F.min("cls").over(w)).withColumn("hi", F.max("cls").over(w))
            .withColumn("n", F.count(F.lit(1)).over(w)).filter("lo != hi").drop("lo", "hi"))


def _need() -> Column:
    """Shared keys that a partner must have, from ``tag``."""
    return F.col("tag").bitwiseAND(F.lit((1 << 32) - 1))


def _enough(shared: DataFrame) -> DataFrame:
    """cls, tag, keys (count, key) of the classes with as many shared keys as
    their partners must have."""
    return (shared.groupBy("cls", "tag").agg(F.collect_set(F.struct("n", "key")).alias("keys"))
            .filter(F.size("keys") >= _need()))


def _without_id(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """One text of each wanted class (cls), from the rows without an id."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            cls, texts = [], []
            found = utf8(batch.column(0))
            for text, c in zip(found, set_digests(shingle_sets(found)), strict=True):
                if c is not None and c not in seen:
                    seen.add(c)
                    cls.append(c)
                    texts.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())],
                                             names=["cls", "text"])

    return _texts(docs).filter("doc_id IS NULL").select("text").mapInArrow(run, "cls long, text string") \
        .join(wanted, "cls", "left_semi").dropDuplicates(["cls"]).select("text")


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """cls, size, hashes, sketch of the wanted classes (cls, doc_id). A class is
    read again by its smallest doc_id or, if no row of it has one, by itself."""
    bare = wanted.filter("doc_id IS NULL").select("cls").distinct()
    without = bare.count()
    wanted = wanted.filter("doc_id IS NOT NULL").select("doc_id").distinct()
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)

    def run(batches):
        for batch in batches:
            sets = [s for s in shingle_sets(utf8(batch.column(0))) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(set_digests(sets), pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                 pa.array([sketch(s, levels(len(s))[0][0]) for s in sets], pa.list_(pa.int64()))],
                names=["cls", "size", "hashes", "sketch"])

    texts = _texts(docs).join(wanted, "doc_id", "left_semi").select("text")
    if without:
        texts = texts.unionByName(_without_id(docs, F.broadcast(bare) if without <= BROADCAST_IDS else bare))
    return texts.mapInArrow(run, "cls long, size long, hashes array<long>, sketch array<long>")


def survivors(docs: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, cls) rows to compare and (cls, size, hashes, sketch) of their
    classes. ``classes``: cls, doc_id (the smallest)."""
    first = settle(_enough(_shared(keys(docs))), "keys")
    again = first.select("cls", "tag", F.explode("keys.key").alias("key"))
    second = settle(_enough(_shared(again)), "keys")
    release(first)
    kept = second.select("cls").distinct()
    read = sets = settle(sets_of(docs, classes.join(kept, "cls", "left_semi")), "sets")
    elements = sets.select("cls", "size", F.explode("hashes").alias("key"))
    common = (_shared(elements).groupBy("cls", "size").agg(F.countDistinct("key").alias("common"))
              .filter(F.col("common") * 4 >= F.col("size") * 3).select("cls"))
    common = settle(common, "common")
    sets = settle(sets.join(common, "cls", "left_semi").dropDuplicates(["cls"]), "sets")
    release(read)
    third = _enough(_shared(second.join(common, "cls", "left_semi")
                            .select("cls", "tag", F.explode("keys.key").alias("key"))))
    # Rarest first: all but the last ``need - 1`` of the shared keys.
    rare = F.slice(F.array_sort("keys"), F.lit(1), (F.size("keys") - _need() + 1).cast("int"))
    rows = third.select("cls", F.explode(rare).alias("e")).select(F.col("e.key").alias("key"), "cls").distinct()
    rows = settle(rows, "buckets")
    release(second)
    return rows, sets


def _fold(s: Column, n: Column) -> Column:
    """A sketch at the length ``n`` of the other one, or of the level below."""
    half = (F.size(s) / 2).cast("int")
    return F.when(F.size(s) > n, F.zip_with(F.slice(s, F.lit(1), half), F.slice(s, half + 1, half),
                                            lambda a, b: a.bitwiseXOR(b))).otherwise(s)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (x, y) with 100 * intersection >= 75 * union."""
    thin = sets.select("cls", "size", "sketch")
    a = thin.select(F.col("cls").alias("x"), F.col("size").alias("nx"), F.col("sketch").alias("sx"))
    b = thin.select(F.col("cls").alias("y"), F.col("size").alias("ny"), F.col("sketch").alias("sy"))
    n = F.least(F.size("sx"), F.size("sy"))
    apart = F.aggregate(F.zip_with(_fold(F.col("sx"), n), _fold(F.col("sy"), n),
                                   lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, v: t + v)
    near = pairs.join(a, "x").join(b, "y").filter(apart * 7 <= F.col("nx") + F.col("ny")).select("x", "y", "nx", "ny")
    near = settle(near, "near")
    if near.count() <= BROADCAST_IDS:  # then the sets needn't be shuffled
        near = F.broadcast(near)
    p = sets.select(F.col("cls").alias("x"), F.col("hashes").alias("hx"))
    q = sets.select(F.col("cls").alias("y"), F.col("hashes").alias("hy"))
    common = F.size(F.array_intersect("hx", "hy"))
    return near.join(p, "x").join(q, "y").filter(common * 7 >= (F.col("nx") + F.col("ny")) * 3).select("x", "y")


def merge(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (node, root) with the components that ``edges`` (x, y, all of
    them nodes) join made one."""
    def roots(edges: DataFrame, of: DataFrame) -> DataFrame:
        a = of.select(F.col("node").alias("x"), F.col("root").alias("rx"))
        b = of.select(F.col("node").alias("y"), F.col("root").alias("ry"))
        return settle(edges.join(a, "x").join(b, "y").filter("rx != ry")
                      .select(F.least("rx", "ry").alias("x"), F.greatest("rx", "ry").alias("y")).distinct(), "edges")

    rest = roots(edges, labels)
    while not rest.isEmpty():
        both = rest.select("x", "y").unionByName(rest.select(F.col("y").alias("x"), F.col("x").alias("y")))
        parent = settle(both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("m"))
                        .select("node", F.least("node", "m").alias("root")), "parents")
        while True:
            up = parent.select(F.col("node").alias("mid"), F.col("root").alias("top"))
            jumped = settle(parent.join(up, F.col("root") == F.col("mid"))
                            .select("node", F.col("top").alias("root"), (F.col("root") != F.col("top")).alias("moved")),
                            "parents")
            parent = jumped.drop("moved")
            if jumped.filter("moved").isEmpty():
                break
        up = parent.select(F.col("node").alias("mid"), F.col("root").alias("top"))
        labels = settle(labels.join(up, F.col("root") == F.col("mid"), "left")
                        .select("node", F.coalesce("top", "root").alias("root")), "labels")
        rest = roots(rest, parent)
    return labels


def components(edges: DataFrame) -> DataFrame:
    """node, root (the component's smallest node) for every node of ``edges``."""
    nodes = edges.select(F.col("x").alias("node")).unionByName(edges.select(F.col("y").alias("node"))).distinct()
    return merge(settle(nodes.select("node", F.col("node").alias("root")), "labels"), edges)


def distinct_buckets(rows: DataFrame) -> DataFrame:
    """``rows`` (key, cls) without buckets whose members are those of another
    one: copies and near copies share most of their keys."""
    members = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("cls")).alias("a"),
        F.bit_xor(F.xxhash64(F.lit(1), "cls")).alias("b"))
    one = members.filter("n > 1").groupBy("n", "a", "b").agg(F.min("key").alias("key")).select("key")
    return rows.join(one, "key", "left_semi")


def _fold_to(rows: list[np.ndarray], words: int) -> np.ndarray:
    """Sketches of one length; longer ones (of the level above) are folded."""
    out = np.empty((len(rows), words), np.uint64)
    for i, r in enumerate(rows):
        while len(r) > words:
            half = len(r) // 2
            r = r[:half] ^ r[half:]
        out[i] = r
    return out


def _close_pairs(cls, roots, sizes, sketches, side, across: bool, earlier, filled) -> tuple[np.ndarray, np.ndarray]:
    """Members of different components (and sides, if ``across``) whose sketches
    are within their largest symmetric difference. Members with a common key
    among the last ones before this bucket's met there or earlier still: in
    the bucket of their smallest common key they have none."""
    order = np.argsort(roots, kind="stable")
    cls, roots, sizes, side = cls[order], roots[order], sizes[order], side[order]
    earlier, filled = earlier[order], filled[order]
    x = _fold_to([sketches[i] for i in order], min(len(r) for r in sketches))
    ends = np.searchsorted(roots, roots, side="right")
    left, right = [], []
    for i in range(len(cls)):
        j = ends[i]  # later members of the same component need no comparison
        if j == len(cls):
            break
        apart = np.bitwise_count(x[j:] ^ x[i]).sum(axis=1, dtype=np.int64)
        near = apart * 7 <= sizes[j:] + sizes[i]
        if across:
            near &= side[j:] != side[i]
        at = np.flatnonzero(near)
        if len(at):
            met = (earlier[j + at][:, :, None] == earlier[i]) & filled[j + at][:, :, None] & filled[i]
            at = at[~met.any(axis=(1, 2))]
        if len(at):
            left.append(np.full(len(at), cls[i]))
            right.append(cls[j + at])
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(left), np.concatenate(right)
    return np.minimum(a, b), np.maximum(a, b)


def close_pairs(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """x, y: pairs of one bucket and different components with close sketches.
    ``rows``: key, cls, root, n (the bucket's members). A bucket of more than
    ``CHUNK`` members is cut by a hash, and each two of its cuts are a group.
    Near copies share many buckets: a pair leaves few of them (see
    ``_close_pairs``), not each."""
    before = W.partitionBy("cls").orderBy("key").rowsBetween(-EARLIER, -1)
    rows = rows.withColumn("earlier", F.collect_list("key").over(before))
    cuts = F.ceil(F.col("n") / F.lit(CHUNK)).cast("int")
    own = F.pmod(F.xxhash64("cls"), cuts).cast("int")
    grouped = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), cuts - 1))) \
        .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cls", "root", "earlier")
    thin = sets.select("cls", "size", "sketch")
    dealt = grouped.join(thin, "cls").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def run(batches):
        held: list[pa.RecordBatch] = []

        def pairs(table: pa.Table):
            """All whole groups of ``table``, which is in order."""
            if not table.num_rows:
                return None
            key, i, j, own, cls, root, size = (table.column(c).to_numpy() for c in
                                               ("key", "i", "j", "own", "cls", "root", "size"))
            sk = table.column("sketch").combine_chunks()
            offsets, words = sk.offsets.to_numpy(), sk.values.to_numpy().view(np.uint64)
            lists = table.column("earlier").combine_chunks()
            ends = lists.offsets.to_numpy()
            filled = np.arange(EARLIER) < np.diff(ends)[:, None]
            earlier = np.zeros(filled.shape, np.int64)
            earlier[filled] = lists.values.to_numpy()[ends[0]:ends[-1]]
            new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
            found = []
            for a, b in zip(new, np.r_[new[1:], len(key)], strict=True):
                if b - a > 1:
                    found.append(_close_pairs(cls[a:b], root[a:b], size[a:b],
                                              [words[offsets[r]:offsets[r + 1]] for r in range(a, b)],
                                              own[a:b], i[a] != j[a], earlier[a:b], filled[a:b]))
            if not found:
                return None
            both = np.unique(np.stack([np.concatenate([f[0] for f in found]),
                                       np.concatenate([f[1] for f in found])]), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["x", "y"])

        for batch in batches:
            if not batch.num_rows:
                continue
            # The last group of what is held may go on in the next batch.
            held.append(batch)
            table = pa.Table.from_batches(held)
            key, i, j = (table.column(c).to_numpy() for c in ("key", "i", "j"))
            last = int(np.argmax((key == key[-1]) & (i == i[-1]) & (j == j[-1])))
            if last:
                out = pairs(table.slice(0, last).combine_chunks())
                held = table.slice(last).to_batches()
                if out is not None:
                    yield out
        if held:
            out = pairs(pa.Table.from_batches(held).combine_chunks())
            if out is not None:
                yield out

    return dealt.select("key", "i", "j", "own", "cls", "root", "size", "sketch", "earlier") \
        .mapInArrow(run, "x long, y long").distinct()


def _mixed(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """key, cls, root, n of the buckets with more than one component. A large
    bucket leaves each task as one row of the aggregate, and its rows are joined
    with that in as many tasks as Spark cuts a large key into."""
    rooted = rows.join(labels, F.col("cls") == F.col("node")).select("key", "cls", "root")
    mixed = (rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("n"))
             .filter("lo != hi").select("key", "n"))
    return rooted.join(mixed, "key")


def links(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """node, root: components of the classes in ``rows`` (others are alone)."""
    spent, rows = rows, settle(distinct_buckets(rows), "buckets")
    release(spent)
    labels = settle(rows.select(F.col("cls").alias("node"), F.col("cls").alias("root")).distinct(), "labels")
    for order in range(STARS):
        mixed = settle(_mixed(rows, labels), "mixed")
        rank = F.struct(F.xxhash64(F.lit(order), "cls").alias("h"), "cls", "root")
        leader = mixed.groupBy("key").agg(F.min(rank).alias("l")).select(
            "key", F.col("l.cls").alias("l"), F.col("l.root").alias("r"))
        stars = mixed.join(leader, "key").filter("root != r") \
            .select(F.least("cls", "l").alias("x"), F.greatest("cls", "l").alias("y")).distinct()
        labels = merge(labels, settle(verified(settle(stars, "pairs"), sets), "links"))
        release(mixed)
    rest = close_pairs(settle(_mixed(rows, labels), "mixed"), sets)
    return merge(labels, settle(verified(settle(rest, "pairs"), sets), "links"))


@contextmanager
def small_batches(spark: SparkSession):
    """Texts and their shingles are some KB a row: hand few rows at a time to Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before) if int(before) > 0 else BATCH_ROWS, BATCH_ROWS)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def classes_of(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The profile of the documents, and of each class its component: cls,
    root, component_id, and its smallest doc_id."""
    with small_batches(docs.sparkSession):
        return _classes_of(docs)


def _classes_of(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    thin = settle(profile(docs), "profile")
    classes = settle(thin.filter("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("doc_id")), "classes")
    rows, sets = survivors(docs, classes)
    labels = links(rows, sets).select(F.col("node").alias("cls"), "root")
    rooted = classes.join(labels, "cls", "left").select("cls", "doc_id", F.coalesce("root", "cls").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return thin, settle(rooted.join(ids, "root").select("cls", "root", "component_id", F.col("doc_id").alias("least_id")),
                        "ids")


def _assigned(thin: DataFrame, ids: DataFrame) -> DataFrame:
    filled = thin.filter("cls IS NOT NULL").join(ids, "cls").select("doc_id", "n_shingles", "component_id")
    alone = thin.filter("cls IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return filled.unionByName(alone)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    return _assigned(*classes_of(docs))


def _with_class(docs: DataFrame, column: str) -> DataFrame:
    """``docs`` with its class (null without shingles)."""
    at = docs.schema.fieldNames().index("text")

    def run(batches):
        for batch in batches:
            cls = pa.array(set_digests(shingle_sets(utf8(batch.column(at)))), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, cls], names=[*batch.schema.names, column])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(column, LongType())]))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without near duplicates: of each component the row with the
    smallest id stays. Rows of one id are told apart by their texts: a text of
    another component keeps its row, and of one id's near copies one stays (the
    least class; of its rows, one by a hash of the row). A row without an id
    stays only in a component without any id, one row for each. Rows without
    shingles all stay."""
    thin, ids = classes_of(docs)
    found = settle(_assigned(thin, ids), "components")
    p = unused(docs, "near_")
    stay = found.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(p + "id")).distinct()
    if found.filter("doc_id = component_id").count() <= BROADCAST_IDS:  # then the texts needn't be shuffled
        stay = F.broadcast(stay)
    cols = [F.col(f"`{c}`") for c in docs.columns]
    out = docs.join(stay, F.col("doc_id") == F.col(p + "id"), "left_semi")
    rows, distinct, null = found.agg(F.count("doc_id"), F.countDistinct("doc_id"),
                                     F.count_if(F.col("doc_id").isNull())).first()
    if rows != distinct:
        first = ids.filter("least_id = component_id").groupBy("root").agg(
            F.min(F.struct(F.col("component_id").alias("id"), F.col("cls").alias("cls"))).alias("r")).select(
            F.col("r.id").alias(p + "id"), F.col("r.cls").alias(p + "first"))
        known = _with_class(out, p + "cls")
        one = known.join(first, (F.col("doc_id") == F.col(p + "id")) & (F.col(p + "cls") == F.col(p + "first")), "left_semi")
        one = one.groupBy("doc_id", p + "cls").agg(
            F.min_by(F.struct(*cols), F.struct(F.xxhash64(*cols), "text")).alias(p + "row")).select(p + "row.*")
        out = one.unionByName(known.filter(F.col(p + "cls").isNull()).select(*cols))
    out = out.select(*cols)
    if null:
        bare = _with_class(docs.filter("doc_id IS NULL"), p + "cls")
        first = ids.filter("component_id IS NULL").groupBy("root").agg(F.min("cls").alias(p + "first"))
        kept = bare.join(first, F.col(p + "cls") == F.col(p + "first"), "left_semi").dropDuplicates([p + "cls"])
        out = out.unionByName(kept.select(*cols)).unionByName(bare.filter(F.col(p + "cls").isNull()).select(*cols))
    return out
