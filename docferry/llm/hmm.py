"""Hidden Markov language model.

Latent states (``STATES``) emit words. The ``EMISSIONS`` most frequent training
words have emissions of their own; the others are emitted as a class of words
of like count (1, 2-3, 4-7, ...) and within it by their counts, so the model's
size is bounded while every training word has its probability. A word that
training has not seen is one of a class as likely, in each state, as the words
seen once, with as many members as there are training words.

1. ``blocks`` turns texts into blocks of about ``BLOCK_TOKENS`` word codes, each
   with a dictionary of its words' hashes and training counts; nothing is
   dropped, and a block is the unit that later steps read.
2. Counts of all words are summed over the blocks; every block gets the counts
   of its own dictionary back (frequent words, a bounded list, go along with the
   task, so no key of that join is hot).
3. ``train`` runs Baum-Welch: tasks add up expected counts over their blocks by
   scaled forward and backward recursion, Spark sums the tasks' counts, and the
   driver normalises one table of bounded size. Long texts are cut into segments
   for this step, whose first states are learnt apart from those of texts.
4. ``score`` runs the scaled forward recursion over whole texts: the exact
   log-likelihood of the sequence of words and end.

Words: runs of bytes other than ASCII white space, A-Z in lower case, each text
followed by an end token. 64-bit hashes stand for words.

Defined cases: a null text is empty and consists of its end; a null id is a
training row; repeated rows count as often as they occur; without training
rows no word is known, all words share one class and the base has no counts; an
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.llm.common import crc_mod_py, settle, utf8
from docferry.llm.words import word_hashes, words

STATES = 8
EMISSIONS = 8192
ROUNDS = 6
BLOCK_TOKENS = 1 << 18  # few enough that most blocks' codes have 16 bits
SEGMENT = 256
BATCH_TOKENS = 1 << 18
END = -1  # the end token's hash, as a signed number
PRIOR = 20.0  # pseudo-counts of a state's emissions, in the training words' mix
SEED = 11
TIERS = 48


@contextmanager
def few_rows(spark: SparkSession, rows: int = 8):
    """Rows of blocks are some MB each: hand few at a time to Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


BLOCKS = ("block long, doc_ids array<long>, lengths array<int>, held array<boolean>, codes binary, "
          "words array<long>, counts array<int>")


def blocks(docs: DataFrame, modulus: int, remainder: int) -> DataFrame:
    """Blocks of coded texts; rows whose crc32(doc_id) has that remainder are
    held out of the counts."""

    def code(batches):
        part = TaskContext.get().partitionId()
        ids, lengths, held, parts, size, n = [], [], [], [], 0, 0

        def flush():
            hashes = np.concatenate(parts).view(np.int64)
            found, codes = np.unique(hashes, return_inverse=True)
            train = np.repeat(~np.array(held), lengths)
            counts = np.bincount(codes[train], minlength=len(found))
            return pa.RecordBatch.from_arrays(
                [pa.array([part << 24 | n], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([lengths], pa.list_(pa.int32())), pa.array([held], pa.list_(pa.bool_())),
                 pa.array([zstandard.compress(codes.astype("<u2" if len(found) <= 1 << 16 else "<u4").tobytes(), 1)], pa.binary()),
                 pa.array([found], pa.list_(pa.int64())), pa.array([counts.astype(np.int32)], pa.list_(pa.int32()))],
                names=[f.split()[0] for f in BLOCKS.split(", ")])

        end = np.array([END], np.int64).view(np.uint64)
        hashes = word_hashes()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                own = np.concatenate([hashes.of(words(text)), end])
                if size and size + len(own) > BLOCK_TOKENS:
                    yield flush()
                    n += 1
                    ids, lengths, held, parts, size = [], [], [], [], 0
                ids.append(doc_id)
                lengths.append(len(own))
                held.append(crc_mod_py(doc_id, modulus) == remainder)
                parts.append(own)
                size += len(own)
        if size:
            yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(code, BLOCKS)


class Vocabulary:
    """Counts of the frequent words (class 0, 1, ...), the classes of the
    others, and corpus totals."""

    def __init__(self, top_counts: np.ndarray, tiers: dict[int, int], total: int, distinct: int) -> None:
        self.counts, self.total, self.distinct = top_counts, total, distinct
        self.size = len(top_counts)
        self.classes = self.size + TIERS + 1  # the last one: unseen words
        self.sums = np.ones(TIERS)
        for t, n in tiers.items():
            self.sums[t] = n
        self.occurrences = np.zeros(self.classes)
        self.occurrences[:self.size] = top_counts
        for t, n in tiers.items():
            self.occurrences[self.size + t] = n
        self.occurrences[-1] = tiers.get(0, 0.5)

    def look_up(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class, log of the share within the class, and count of dictionary
        words; a value is a count, or ``-1 - class`` of a frequent word."""
        c = values.copy()
        top, rare = values < 0, values > 0
        cls = np.full(len(values), self.classes - 1, np.int64)
        share = np.full(len(values), -math.log(max(1, self.distinct)))
        cls[top], share[top] = -1 - values[top], 0.0
        c[top] = self.counts[cls[top]]
        tier = np.floor(np.log2(c[rare])).astype(np.int64)
        cls[rare] = self.size + tier
        share[rare] = np.log(c[rare] / self.sums[tier])
        return cls, share, c


ENCODED = ("block long, doc_ids array<long>, lengths array<int>, held array<boolean>, classes binary, "
           "known array<long>, base array<double>, rare array<double>")


def encode(coded: DataFrame) -> tuple[DataFrame, Vocabulary]:
    """Blocks of emission classes, with each text's known words, base score and
    the logs of its words' shares of their classes; and the vocabulary."""
    spark = coded.sparkSession
    entries = coded.select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("pos", "e")) \
        .select("block", "pos", F.col("e.words").alias("word"), F.col("e.counts").alias("n"))
    counts = settle(entries.filter("n > 0").groupBy("word").agg(F.sum("n").alias("c")), "counts")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    top = counts.orderBy(F.desc("c"), "word").limit(EMISSIONS).toArrow().to_pydict()
    # At most EMISSIONS rows.
    frequent = F.broadcast(spark.createDataFrame([(int(w), -1 - i) for i, w in enumerate(top["word"])],
                                                 "word long, value long"))
    others = counts.join(frequent, "word", "left_anti").withColumnRenamed("c", "value")
    tiers = {r["t"]: r["n"] for r in others.groupBy(F.floor(F.log2("value") + F.lit(1e-9)).cast("int").alias("t"))
             .agg(F.sum("value").alias("n")).collect()}
    vocabulary = Vocabulary(np.array(top["c"], np.int64), tiers, total, distinct)
    words_of = entries.select("block", "pos", "word")
    own = (words_of.join(frequent, "word").select("block", "pos", "value")
           .unionByName(words_of.join(frequent, "word", "left_anti").join(others, "word").select("block", "pos", "value"))
           .groupBy("block").agg(F.collect_list("pos").alias("places"), F.collect_list("value").alias("found")))
    shared = spark.sparkContext.broadcast(vocabulary)

    def classes(batches):
        v = shared.value
        for batch in batches:
            for r in range(batch.num_rows):
                lengths = batch.column("lengths")[r].values.to_numpy()
                raw = zstandard.decompress(batch.column("codes")[r].as_py())
                codes = np.frombuffer(raw, "<u2" if len(raw) == 2 * lengths.sum() else "<u4")
                values = np.zeros(int(codes.max()) + 1, np.int64)
                if batch.column("places")[r].is_valid:
                    values[batch.column("places")[r].values.to_numpy()] = batch.column("found")[r].values.to_numpy()
                cls, share, c = v.look_up(values)
                logp = np.log10((c + 0.5) / (v.total + 0.5 * (v.distinct + 1)))
                starts = np.cumsum(lengths) - lengths
                yield pa.RecordBatch.from_arrays(
                    [batch.column("block").slice(r, 1), batch.column("doc_ids").slice(r, 1),
                     batch.column("lengths").slice(r, 1), batch.column("held").slice(r, 1),
                     pa.array([cls.astype("<u2")[codes].tobytes()], pa.binary()),
                     pa.array([np.add.reduceat((c > 0).astype(np.int64)[codes], starts)], pa.list_(pa.int64())),
                     pa.array([np.add.reduceat(logp[codes], starts)], pa.list_(pa.float64())),
                     pa.array([np.add.reduceat(share[codes], starts)], pa.list_(pa.float64()))],
                    names=[f.split()[0] for f in ENCODED.split(", ")])

    joined = coded.drop("words", "counts").join(own, "block", "left")
    return settle(joined.mapInArrow(classes, ENCODED), "encoded"), vocabulary


class Model:
    def __init__(self, start: np.ndarray, again: np.ndarray, moves: np.ndarray, emits: np.ndarray) -> None:
        self.start, self.again, self.moves, self.emits = start, again, moves, emits  # emits: classes x states


def first_model(v: Vocabulary, states: int = STATES, seed: int = SEED) -> Model:
    rng = np.random.default_rng(seed)
    emits = (v.occurrences[:, None] + 0.5) * np.exp(rng.normal(0, 1.0, (v.classes, states)))
    moves = 0.7 * np.eye(states) + 0.3 / states
    flat = np.full(states, 1 / states)
    return Model(flat, flat, moves, emits / emits.sum(axis=0))


def _active(lengths: np.ndarray) -> np.ndarray:
    """How many of the (descending) lengths exceed each step."""
    return len(lengths) - np.searchsorted(lengths[::-1], np.arange(lengths[0] if len(lengths) else 0), side="right")


def forward(m: Model, classes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Log-likelihood of each sequence, by scaled forward recursion over many
    sequences at a time."""
    order = np.argsort(-lengths, kind="stable")
    at, out = starts[order], np.zeros(len(order))
    ones = np.ones(len(m.start))
    a = np.broadcast_to(m.start, (len(order), len(ones)))
    for t, n in enumerate(_active(lengths[order])):
        a = (a[:n] if t == 0 else a[:n] @ m.moves) * m.emits[classes[at[:n] + t]]
        s = a @ ones
        out[:n] += np.log(s)
        a /= s[:, None]
    back = np.empty_like(out)
    back[order] = out
    return back


def expect(m: Model, classes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, first: np.ndarray):
    """Expected counts of starts, segment starts, moves and emissions, and the
    log-likelihood."""
    order = np.argsort(-lengths, kind="stable")
    at, is_first = starts[order], first[order]
    active = _active(lengths[order])
    k = len(m.start)
    ones = np.ones(k)
    alphas, emitted, scales = [], [], []
    total = 0.0
    for t, n in enumerate(active):
        b = m.emits[classes[at[:n] + t]]
        a = (np.where(is_first[:, None], m.start, m.again) if t == 0 else alphas[-1][:n] @ m.moves) * b
        s = a @ ones
        total += float(np.log(s).sum())
        a /= s[:, None]
        alphas.append(a)
        emitted.append(b)
        scales.append(s)
    moves = np.zeros((k, k))
    gammas, places = [], []
    beta = None
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        later = active[t + 1] if t + 1 < len(active) else 0
        now = np.ones((n, k))
        if later:
            ahead = emitted[t + 1] * beta
            ahead /= scales[t + 1][:, None]
            moves += alphas[t][:later].T @ ahead
            now[:later] = ahead @ m.moves.T
        beta = now
        gammas.append(alphas[t] * beta)
        places.append(classes[at[:n] + t])
    gamma, place = np.concatenate(gammas), np.concatenate(places)
    emits = np.stack([np.bincount(place, weights=gamma[:, i], minlength=len(m.emits)) for i in range(k)], axis=1)
    begin = gammas[-1]
    return begin[is_first].sum(axis=0), begin[~is_first].sum(axis=0), moves * m.moves, emits, total


def _segments(lengths: np.ndarray, starts: np.ndarray, held: np.ndarray):
    """Starts, lengths and first-of-its-text flags of training segments."""
    keep = np.flatnonzero(~held)
    pieces = -(-lengths[keep] // SEGMENT)
    text = np.repeat(keep, pieces)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = starts[text] + nth * SEGMENT
    return begin, np.minimum(SEGMENT, lengths[text] - nth * SEGMENT), nth == 0


def train(encoded: DataFrame, v: Vocabulary, *, states: int = STATES, rounds: int = ROUNDS,
          seed: int = SEED) -> tuple[Model, list[float]]:
    """Baum-Welch; also the log-likelihood (of classes) before each round."""
    model = first_model(v, states, seed)
    history = []
    if not v.total:
        return model, history
    fields = "row int, " + ", ".join(f"v{i} double" for i in range(states))
    base = v.occurrences / v.occurrences.sum()

    for _ in range(rounds):
        shared = encoded.sparkSession.sparkContext.broadcast(model)

        def step(batches, shared=shared):
            m = shared.value
            emits = np.zeros_like(m.emits)
            moves, start, again, total = np.zeros_like(m.moves), 0.0, 0.0, 0.0
            seen = False
            for batch in batches:
                for r in range(batch.num_rows):
                    lengths = batch.column("lengths")[r].values.to_numpy().astype(np.int64)
                    held = batch.column("held")[r].values.to_numpy(zero_copy_only=False)
                    cls = np.frombuffer(batch.column("classes")[r].as_py(), "<u2").astype(np.int64)
                    begin, size, first = _segments(lengths, np.cumsum(lengths) - lengths, held)
                    order = np.argsort(-size, kind="stable")
                    cut = np.cumsum(size[order]) // BATCH_TOKENS
                    for c in range(int(cut[-1]) + 1 if len(cut) else 0):
                        own = order[cut == c]
                        if not len(own):
                            continue
                        s, g, mv, e, ll = expect(m, cls, begin[own], size[own], first[own])
                        start, again, total = start + s, again + g, total + ll
                        moves += mv
                        emits += e
                        seen = True
            if seen:
                k = len(m.start)
                table = np.vstack([emits, moves, np.broadcast_to(start, (1, k)), np.broadcast_to(again, (1, k)),
                                   np.full((1, k), total)])
                rows = np.flatnonzero(table.any(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows.astype(np.int32))] + [pa.array(table[rows, i]) for i in range(k)],
                    names=["row"] + [f"v{i}" for i in range(k)])

        found = (encoded.select("lengths", "held", "classes").mapInArrow(step, fields).groupBy("row")
                 .agg(*[F.sum(f"v{i}").alias(f"v{i}") for i in range(states)]).toArrow().to_pydict())
        shared.unpersist()
        table = np.zeros((v.classes + states + 3, states))
        table[np.array(found["row"], np.int64)] = np.column_stack([found[f"v{i}"] for i in range(states)])
        emits = table[:v.classes]
        # Unseen words: in each state as likely as those seen once.
        emits[-1] = emits[v.size] + 1e-3
        emits = emits + PRIOR * base[:, None]
        moves = table[v.classes:v.classes + states] + 1.0 / states
        start, again = table[v.classes + states] + 1.0 / states, table[v.classes + states + 1] + 1.0 / states
        history.append(float(table[-1, 0]))
        model = Model(start / start.sum(), again / again.sum(), moves / moves.sum(axis=1, keepdims=True),
                      emits / emits.sum(axis=0))
    return model, history


OUT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
       "score double")


def score(encoded: DataFrame, model: Model, v: Vocabulary) -> DataFrame:
    """log10 probability of every text under the model and the base."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    total = v.total

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = [batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("lengths", "held", "known", "base", "rare")]
            lengths = flat[0].astype(np.int64)
            cls = np.frombuffer(b"".join(batch.column("classes").to_pylist()), "<u2").astype(np.int64)
            logs = forward(shared.value, cls, np.cumsum(lengths) - lengths, lengths)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_ids").flatten(), pa.array(flat[1], pa.bool_()), pa.array(lengths),
                 pa.array(flat[2], pa.int64()), pa.array(np.full(len(lengths), total, np.int64)),
                 pa.array(flat[3], pa.float64()), pa.array((logs + flat[4]) / math.log(10))],
                names=[f.split()[0] for f in OUT.split(", ")])

    return encoded.select("doc_ids", "lengths", "held", "classes", "known", "base", "rare").mapInArrow(run, OUT)


def language_model(docs: DataFrame, *, modulus: int = 5, remainder: int = 1, states: int = STATES,
                   rounds: int = ROUNDS) -> DataFrame:
    """Train on the rows that aren't held out and score all rows."""
    spark = docs.sparkSession
    coded = settle(blocks(docs, modulus, remainder), "blocks")
    with few_rows(spark):
        encoded, v = encode(coded)
        model, _ = train(encoded, v, states=states, rounds=rounds)
        return settle(score(encoded, model, v), "scores")
