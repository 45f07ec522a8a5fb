"""Collocations: frequent phrases by three-way quicksort of suffix pointers.

1. ``vocabulary``: every word of a language is counted (in tasks, then one
   shuffle of the tasks' vocabularies) and known by a 64-bit hash seeded by its
   language. Hashes are checked over the whole vocabulary; if two words share
   one, all is done again with another seed, so the counts are exact.
2. ``suffixes``: each word position is a suffix pointer to at most three words
   of its piece. Tasks merge equal suffixes and deal them to ranges of (first,
   second, third word), whose borders come from a sample, as Spark's own range
   partitioning does; frequent leading words are thus spread over many ranges.
3. ``sort_range``: inside a range, multikey three-way quicksort, all partitions
   of a generation at once: pivots split them into less, equal and greater;
   equal ones go on with the next word down to the third, and their sizes are
   the phrases' counts. A partition below the least count is abandoned. Only the
   leading words of a range's borders can continue in another range; their
   partial counts are summed afterwards.
4. ``collocations``: scores from the counts of both parts, by joins on phrases.

Defined cases: a null text is empty, a null language is ``und``; repeated rows
count as often as they occur; an empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docferry.llm.common import settle, shuffle_partitions, utf8

LEAST = 10
TOP = 2000
COVERED = 50           # per cent of a phrase's occurrences inside a longer one that drop it
NO_LANGUAGE = "und"
CHUNK_WORDS = 1 << 20   # words whose suffixes a task merges at once
RANGE_WORDS = 1_500_000  # suffixes of a range, on average
SAMPLE_EVERY = 1024     # words of a task for each sampled suffix
SAMPLES_PER_RANGE = 40
SHORT_CODES = 65_535    # words with more than this part of all are written in two bytes
TOP_PARTS = 64         # in which a language's phrases are ranked first
COUNTED_WORDS = 1_000_000  # distinct words that a task holds before it hands them on

# Characters that end a piece; space and tab part its words.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TO_END = bytes.maketrans(_ENDS, b"." * len(_ENDS))

_VOCABULARY = "h long, h2 long, h3 long, lang string, word binary, n long"
_RANGE = "w1 long, w2 long, w3 long, a long, l1 long, l2 long, partial boolean"


def pieces(text: bytes) -> list[bytes]:
    """Words in order; ``.`` stands for every end of a piece."""
    return text.lower().translate(_TO_END).replace(b".", b" . ").split()


class Codes(dict):
    """Hashes of one language's words; 0 for the end of a piece."""

    def __init__(self, lang: bytes, seed: int, limit: int = 1_000_000) -> None:
        super().__init__()
        self._seed = xxhash.xxh3_64_intdigest(lang, seed)
        self._limit = limit

    def __missing__(self, word: bytes) -> int:
        code = 0 if word == b"." else xxhash.xxh3_64_intdigest(word, self._seed) or 1
        self[word] = code
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self._limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
                       F.col("text").cast("string").alias("text"))


def _signed(codes: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(codes).view(np.int64))


def _three(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of the suffixes at all places but the last two."""
    first, second, third = codes[:-2], codes[1:-1], codes[2:]
    second = np.where(first == 0, 0, second)
    return first, second, np.where(second == 0, 0, third)


def vocabulary(docs: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """(words, sample): each word's hash, language and count; sampled suffixes."""

    def run(batches):
        counts: dict[bytes, Counter] = {}
        codes: dict[bytes, Codes] = {}
        seen = held = 0

        def batch_of(rows):
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                              names=[f.split()[0] for f in _VOCABULARY.split(", ")])

        def flush():
            for lang, counter in counts.items():
                counter.pop(b".", None)
                words = list(counter)
                hashes = codes[lang].of(words).view(np.int64).tolist()
                for at in range(0, len(words), 100_000):
                    yield batch_of([(h, None, None, lang.decode(), w, counter[w]) for h, w in
                                    zip(hashes[at:at + 100_000], words[at:at + 100_000], strict=True)])
            counts.clear()

        for batch in batches:
            samples = []
            for lang, text in zip(utf8(batch.column(0)), utf8(batch.column(1)), strict=True):
                words = pieces(text)
                coded = codes.get(lang)
                if coded is None:
                    coded = codes[lang] = Codes(lang, seed)
                counter = counts.setdefault(lang, Counter())
                before = len(counter)
                counter.update(words)
                held += len(counter) - before
                for at in range(-seen % SAMPLE_EVERY, len(words), SAMPLE_EVERY):
                    a, b, c = (x[0] for x in _three(np.r_[coded.of(words[at:at + 3]), np.zeros(3, np.uint64)][:3]))
                    if a:
                        samples.append((*np.array([a, b, c], np.uint64).view(np.int64).tolist(), None, None, None))
                seen += len(words)
            if samples:
                yield batch_of(samples)
            if held > COUNTED_WORDS:
                yield from flush()
                held = 0
        yield from flush()

    found = settle(_texts(docs).mapInArrow(run, _VOCABULARY), "words")
    words = found.filter("word is not null").groupBy("h").agg(
        F.sum("n").alias("n"), F.min(F.struct("lang", "word")).alias("one"), F.max(F.struct("lang", "word")).alias("other"))
    return settle(words, "vocabulary"), found.filter("word is null").select("h", "h2", "h3")


class Borders(NamedTuple):
    """First suffixes of the ranges but the first, ascending."""

    w1: np.ndarray
    w2: np.ndarray
    w3: np.ndarray


def borders(sample: DataFrame, ranges: int) -> Borders:
    """Borders of at most ``ranges`` ranges of like size. The driver gets
    some forty sampled suffixes for each range."""
    n = sample.count()
    wanted = SAMPLES_PER_RANGE * ranges
    if n > wanted:
        sample = sample.filter(F.pmod(F.xxhash64("h", "h2", "h3", F.monotonically_increasing_id()), F.lit(n)) < wanted)
    keys = sorted(tuple(v % (1 << 64) for v in r) for r in sample.collect())
    cuts = sorted({keys[len(keys) * k // ranges] for k in range(1, ranges)}) if keys else []
    return Borders(*[np.array([c[k] for c in cuts], np.uint64) for k in range(3)])


def merge_chunk(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct suffixes of a chunk, sorted (3 rows), and their counts. The
    chunk's last two codes only complete earlier suffixes."""
    values, ranks = np.unique(codes, return_inverse=True)
    ranks = ranks.astype(np.uint64)
    bits = np.uint64(21)
    first, second, third = _three(codes)
    r1, r2, r3 = ranks[:-2], np.where(second == 0, 0, ranks[1:-1]), np.where(third == 0, 0, ranks[2:])
    # Rank 0 is the end of a piece wherever there is one; make it so always.
    shift = np.uint64(0 if len(values) and values[0] == 0 else 1)
    r1, r2, r3 = r1 + shift, np.where(second == 0, 0, r2 + shift), np.where(third == 0, 0, r3 + shift)
    values = values if not shift else np.r_[np.uint64(0), values]
    keys = np.sort((r1 << (bits + bits) | r2 << bits | r3)[first != 0])
    heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.r_[heads, len(keys)])
    keys = keys[heads]
    mask = (np.uint64(1) << bits) - np.uint64(1)
    return np.stack([values[(keys >> (bits + bits)).astype(np.int64)], values[(keys >> bits & mask).astype(np.int64)],
                     values[(keys & mask).astype(np.int64)]]), counts


def _places(keys: np.ndarray, cuts: Borders) -> np.ndarray:
    """Where the borders fall among sorted suffixes."""
    out = []
    for c in zip(cuts.w1.tolist(), cuts.w2.tolist(), cuts.w3.tolist(), strict=True):
        low, high = 0, keys.shape[1]
        for k in range(3):
            column, value = keys[k, low:high], np.uint64(c[k])
            low, high = low + int(np.searchsorted(column, value, "left")), low + int(np.searchsorted(column, value, "right"))
        out.append(low)
    return np.array(out, np.int64)


def write_codes(codes: np.ndarray, common: np.ndarray) -> bytes:
    """Two bytes for a common word's code, eight more for another's."""
    at = np.searchsorted(common, codes)
    short = np.where((at < len(common)) & (common[np.minimum(at, len(common) - 1)] == codes), at, SHORT_CODES) \
        if len(common) else np.full(len(codes), SHORT_CODES)
    return short.astype("<u2").tobytes() + codes[short == SHORT_CODES].tobytes()


def read_codes(raw: bytes, n: int, common: np.ndarray, at: int) -> tuple[np.ndarray, int]:
    short = np.frombuffer(raw, "<u2", n, at)
    other = short == SHORT_CODES
    out = np.empty(n, np.uint64)
    out[~other] = common[short[~other]]
    at += 2 * n
    rest = int(other.sum())
    out[other] = np.frombuffer(raw, np.uint64, rest, at)
    return out, at + 8 * rest


def write_block(keys: np.ndarray, counts: np.ndarray, common: np.ndarray) -> bytes:
    """Sorted suffixes with counts: first words by runs, counts of one left out."""
    heads = np.flatnonzero(np.r_[True, keys[0, 1:] != keys[0, :-1]])
    many = np.flatnonzero(counts > 1)
    sizes = np.array([keys.shape[1], len(heads), len(many)], "<u4").tobytes()
    return b"".join([sizes, np.diff(np.r_[heads, keys.shape[1]]).astype("<u4").tobytes(), many.astype("<u4").tobytes(),
                     counts[many].astype("<u4").tobytes(), write_codes(keys[0, heads], common),
                     write_codes(keys[1], common), write_codes(keys[2], common)])


def read_block(raw: bytes, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n, runs, many = np.frombuffer(raw, "<u4", 3).tolist()
    lengths = np.frombuffer(raw, "<u4", runs, 12)
    at = 12 + 4 * runs
    counts = np.ones(n, np.int64)
    counts[np.frombuffer(raw, "<u4", many, at)] = np.frombuffer(raw, "<u4", many, at + 4 * many)
    first, at = read_codes(raw, runs, common, at + 8 * many)
    second, at = read_codes(raw, n, common, at)
    third, at = read_codes(raw, n, common, at)
    return np.stack([np.repeat(first, lengths), second, third]), counts


def suffixes(docs: DataFrame, seed: int, cuts: Borders, common: np.ndarray) -> DataFrame:
    """(part, block): each task's merged suffixes, by range."""

    def run(batches):
        codes: dict[bytes, Codes] = {}
        held: list[np.ndarray] = []
        size = 0

        def blocks():
            whole = np.concatenate([*held, np.zeros(2, np.uint64)])
            for at in range(0, len(whole) - 2, CHUNK_WORDS):
                keys, counts = merge_chunk(whole[at:at + CHUNK_WORDS + 2])
                ends = np.r_[0, _places(keys, cuts), keys.shape[1]]
                some = np.flatnonzero(np.diff(ends)).tolist()
                if some:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(some, pa.int32()),
                         pa.array([write_block(keys[:, ends[k]:ends[k + 1]], counts[ends[k]:ends[k + 1]], common)
                                   for k in some], pa.binary())], names=["part", "block"])

        for batch in batches:
            for lang, text in zip(utf8(batch.column(0)), utf8(batch.column(1)), strict=True):
                coded = codes.get(lang)
                if coded is None:
                    coded = codes[lang] = Codes(lang, seed)
                held += [coded.of(pieces(text)), np.zeros(1, np.uint64)]
                size += len(held[-2]) + 1
                if size >= CHUNK_WORDS:
                    yield from blocks()
                    held.clear()
                    size = 0
        if held:
            yield from blocks()

    return _texts(docs).mapInArrow(run, "part int, block binary")


def three_way(keys: np.ndarray, counts: np.ndarray, least: int) -> list[np.ndarray]:
    """Phrases of two and three words that occur ``least`` times: columns w1,
    w2, w3 (0: none), count, count of the first word, of the first two."""
    found: list[list[np.ndarray]] = []
    pointers = np.arange(keys.shape[1])
    size = np.array([len(pointers)])[:len(pointers)]     # of each partition
    depth = np.zeros(len(size), np.int64)
    above = np.zeros((4, len(size)), np.uint64)          # first word, second, count of one, of two
    while len(size):
        # Abandon what can't hold a frequent phrase.
        starts = np.r_[0, np.cumsum(size)[:-1]]
        weight = np.add.reduceat(counts[pointers], starts) if len(pointers) else np.zeros(0, np.int64)
        good = weight >= least
        if not good.all():
            pointers = pointers[np.repeat(good, size)]
            size, depth, above = size[good], depth[good], above[:, good]
            starts = np.r_[0, np.cumsum(size)[:-1]]
        if not len(size):
            break
        value = keys[np.repeat(depth, size), pointers]
        # The middle one of three is the pivot.
        a, b, c = value[starts], value[starts + size // 2], value[starts + size - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))
        of = np.repeat(np.arange(len(size)), size)
        mine = pivot[of]
        parts = []
        for kind in (value < mine, value > mine):
            n = np.bincount(of[kind], minlength=len(size))
            some = n > 0
            parts.append((pointers[kind], n[some], depth[some], above[:, some]))
        same = value == mine
        n = np.bincount(of[same], minlength=len(size))
        equal = pointers[same]
        total = np.add.reduceat(counts[equal], np.r_[0, np.cumsum(n)[:-1]]).astype(np.uint64)
        real = (pivot != 0) & (total >= least)
        for d in (1, 2):
            hit = real & (depth == d)
            if hit.any():
                up = above[:, hit]
                found.append([up[0], pivot[hit] if d == 1 else up[1], pivot[hit] if d == 2 else np.zeros(hit.sum(), np.uint64),
                              total[hit], up[2], total[hit] if d == 1 else up[3]])
        on = real & (depth < 2)
        next_above = above[:, on].copy()
        first = depth[on] == 0
        next_above[0, first], next_above[2, first] = pivot[on][first], total[on][first]
        next_above[1, ~first], next_above[3, ~first] = pivot[on][~first], total[on][~first]
        parts.append((equal[np.repeat(on, n)], n[on], depth[on] + 1, next_above))
        pointers = np.concatenate([p[0] for p in parts])
        size = np.concatenate([p[1] for p in parts])
        depth = np.concatenate([p[2] for p in parts])
        above = np.concatenate([p[3] for p in parts], axis=1)
    if not found:
        return [np.zeros(0, np.uint64)] * 6
    return [np.concatenate(c) for c in zip(*found, strict=True)]


def sort_range(keys: np.ndarray, counts: np.ndarray, part: int, cuts: Borders, least: int) -> list[tuple]:
    """Rows of ``_RANGE`` for one range. Counts of leading words that a border
    of the range holds are partial: null as parts, flagged as phrases."""
    edge = [(cuts.w1[k], cuts.w2[k]) for k in (part - 1, part) if 0 <= k < len(cuts.w1)]
    w1, w2, w3, a, l1, l2 = three_way(keys, counts, least)
    cut1 = np.isin(w1, [e[0] for e in edge]) if edge else np.zeros(len(w1), bool)
    cut2 = np.zeros(len(w1), bool)
    rows = []
    for e in set(edge):
        cut2 |= (w1 == e[0]) & (w2 == e[1])
        n = int(counts[(keys[0] == e[0]) & (keys[1] == e[1])].sum())
        if n and e[1]:
            rows.append((*np.array([*e, 0], np.uint64).view(np.int64).tolist(), n, None, None, True))
    whole = ~(cut2 & (w3 == 0))
    columns = [w.view(np.int64)[whole].tolist() for w in (w1, w2, w3)] + [a[whole].tolist()]
    firsts = [None if c else int(n) for c, n in zip(cut1[whole].tolist(), l1[whole].tolist(), strict=True)]
    seconds = [None if c else int(n) for c, n in zip(cut2[whole].tolist(), l2[whole].tolist(), strict=True)]
    return rows + [(*r, False) for r in zip(*columns, firsts, seconds, strict=True)]


def phrases(blocks: DataFrame, cuts: Borders, common: np.ndarray, least: int) -> DataFrame:
    """Frequent phrases of all ranges, and partial counts at borders."""

    def run(batches):
        part, keys, counts = None, [], []

        def done():
            if part is None:
                return
            rows = sort_range(np.concatenate(keys, axis=1), np.concatenate(counts), part, cuts, least)
            for at in range(0, len(rows), 50_000):
                cols = zip(*rows[at:at + 50_000], strict=True)
                kinds = [pa.int64()] * 6 + [pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                                 names=[f.split()[0] for f in _RANGE.split(", ")])

        for batch in batches:
            for p, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if p != part:
                    yield from done()
                    part, keys, counts = p, [], []
                k, n = read_block(raw.as_buffer(), common)
                keys.append(k)
                counts.append(n)
        yield from done()

    return (blocks.repartitionById(len(cuts.w1) + 1, "part").sortWithinPartitions("part").mapInArrow(run, _RANGE))


def collocations(docs: DataFrame, *, least: int = LEAST, top: int = TOP, covered: int = COVERED,
                 range_words: int = RANGE_WORDS) -> DataFrame:
    """Each language's ``top`` phrases of two and three words by score."""
    spark = docs.sparkSession
    seed = 0
    while True:
        words, sample = vocabulary(docs, seed)
        if not words.filter("one != other").limit(1).count():
            break
        seed += 1
    total = words.agg(F.sum("n")).first()[0] or 0
    cuts = borders(sample, max(shuffle_partitions(spark), -(-total // range_words)))
    # Fewer than SHORT_CODES words can be as frequent as that.
    often = words.filter(F.col("n") * (SHORT_CODES - 1) > total).select("h").collect()
    common = np.sort(np.array([0] + [r.h % (1 << 64) for r in often], np.uint64))
    found = settle(phrases(suffixes(docs, seed, cuts, common), cuts, common, least), "phrases")

    frequent = words.filter(F.col("n") >= least).select(
        "h", F.col("one.lang").alias("lang"), F.col("one.word").cast("string").alias("word"), "n")
    # Two rows for each border at most: broadcast.
    split = found.filter("partial").groupBy("w1", "w2").agg(F.sum("a").alias("a"))
    split_words = frequent.join(F.broadcast(found.filter("l1 is null").select(F.col("w1").alias("h")).distinct()),
                                "h", "left_semi").select(F.col("h").alias("w1"), F.col("n").alias("whole1"))
    split_pairs = split.select("w1", "w2", F.col("a").alias("whole2"))
    pairs = found.filter("not partial and w3 = 0").select("w1", "w2", "a", "l1").unionByName(
        split.filter(F.col("a") >= least).withColumn("l1", F.lit(None).cast("long")))
    pairs = pairs.join(F.broadcast(split_words), "w1", "left").join(
        frequent.select(F.col("h").alias("w2"), "lang", F.col("n").alias("r")), "w2").select(
        "lang", "w1", "w2", "a", F.coalesce("l1", "whole1").alias("l"), "r")
    pairs = settle(pairs, "pairs")
    triples = found.filter("w3 != 0").join(F.broadcast(split_words), "w1", "left").join(
        F.broadcast(split_pairs), ["w1", "w2"], "left").select(
        "w1", "w2", "w3", "a", F.coalesce("l1", "whole1").alias("l1"), F.coalesce("l2", "whole2").alias("l2"))
    # The rest of a phrase of three is itself a frequent pair.
    rest = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("r1"),
                        F.col("r").alias("r2"))
    triples = settle(triples.join(rest, ["w2", "w3"]), "triples")

    longer = triples.select("w1", "w2", "a").unionByName(
        triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a")).groupBy("w1", "w2").agg(
        F.max("a").alias("longer"))
    kept = pairs.join(longer, ["w1", "w2"], "left").filter(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * covered))

    def cut(k: int, left: str, right: str):
        wide = "decimal(15,0)"
        value = F.expr(f"(cast(1000000 as decimal(7,0)) * cast(a as {wide}) * cast(a as {wide}))"
                       f" div (cast({left} as {wide}) * cast({right} as {wide}))")
        return F.struct(value.cast("long").alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"),
                        F.col(right).alias("r"))

    two = kept.select("lang", "w1", "w2", F.lit(0).cast("long").alias("w3"), "a", cut(1, "l", "r").alias("c"))
    three = triples.select("lang", "w1", "w2", "w3", "a",
                           F.least(cut(1, "l1", "r1"), cut(2, "l2", "r2")).alias("c"))
    # The best of each of many parts of a language, then of the language. Ties
    # of the last rank stay until the phrases' texts are there.
    ranked = two.unionByName(three).withColumn("part", F.pmod(F.xxhash64("w1", "w2", "w3"), F.lit(TOP_PARTS)))
    for by in (["lang", "part"], ["lang"]):
        best = Window.partitionBy(*by).orderBy(F.desc("c.score"), F.desc("a"))
        ranked = ranked.withColumn("place", F.rank().over(best)).filter(F.col("place") <= top)
    ranked = settle(ranked, "ranked")
    for k in (1, 2, 3):
        ranked = ranked.join(frequent.select(F.col("h").alias(f"w{k}"), F.col("word").alias(f"t{k}")), f"w{k}", "left")
    sizes = words.groupBy(F.col("one.lang").alias("lang")).agg(F.sum("n").alias("n"))
    texts = ranked.select("lang", F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"), "a", "c.l", "c.r", "c.score")
    last = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return texts.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= top).join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle() -> str:
    """The same report in DuckDB."""
    return rf"""WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '{NO_LANGUAGE}') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
parts AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM docs),
lists AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM parts),
places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM lists WHERE len(ws) > 0),
grams AS (
  SELECT lang, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM places),
f1 AS (SELECT lang, a, count(*) AS f FROM grams GROUP BY ALL),
f2 AS (SELECT lang, a, b, count(*) AS f FROM grams WHERE b IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, a, b, c, count(*) AS f FROM grams WHERE c IS NOT NULL GROUP BY ALL HAVING count(*) >= {LEAST}),
longer AS (SELECT lang, a, b, max(f) AS f FROM (
  SELECT lang, a, b, f FROM f3 UNION ALL SELECT lang, b, c, f FROM f3) GROUP BY ALL),
cuts AS (
  SELECT f2.lang, f2.a || ' ' || f2.b AS phrase, f2.f AS a, 1 AS k, x.f AS l, y.f AS r FROM f2
  JOIN f1 x ON x.lang = f2.lang AND x.a = f2.a JOIN f1 y ON y.lang = f2.lang AND y.a = f2.b
  LEFT JOIN longer g ON g.lang = f2.lang AND g.a = f2.a AND g.b = f2.b
  WHERE f2.f >= {LEAST} AND (g.f IS NULL OR 100 * g.f < {COVERED} * f2.f)
  UNION ALL
  SELECT t.lang, t.a || ' ' || t.b || ' ' || t.c, t.f, 1, x.f, y.f FROM f3 t
  JOIN f1 x ON x.lang = t.lang AND x.a = t.a JOIN f2 y ON y.lang = t.lang AND y.a = t.b AND y.b = t.c
  UNION ALL
  SELECT t.lang, t.a || ' ' || t.b || ' ' || t.c, t.f, 2, x.f, y.f FROM f3 t
  JOIN f2 x ON x.lang = t.lang AND x.a = t.a AND x.b = t.b JOIN f1 y ON y.lang = t.lang AND y.a = t.c),
scored AS (SELECT *, (1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS score FROM cuts),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best),
n AS (SELECT lang, sum(f) AS n FROM f1 GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= {TOP}"""
