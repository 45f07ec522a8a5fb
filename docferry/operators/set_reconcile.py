"""Which documents are missing or extra when counts differ.

Both sides' ids go into invertible Bloom lookup tables: each id adds its count,
its value and a checksum to one cell in each of three parts of the table. The
cells are sums, so a side is one aggregate that combines map-side (at most the
table's cells for each task, however many ids), and the difference of the two
tables holds only ids that the sides don't share. Cells with one id left give
it away; it is taken out of its other cells, until none is left (``peel``). The
cost follows the difference, not the sides: the table starts small and grows
fourfold until peeling empties it.

Ids are 64-bit numbers; ids of other types go in as a hash and are looked up
again in the sides afterwards (``differences``). An id that a side has several
times counts so many times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIRST_CELLS = 3 * 512
GROWTH = 4
HASHES = 3
_SUM = "decimal(38,0)"


class TooSmall(Exception):
    """The table can't be emptied; a larger one may be."""


def _key(df: DataFrame, column: str) -> Column:
    whole = isinstance(df.schema[column].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    return F.col(f"`{column}`").cast("bigint") if whole else F.xxhash64(F.lit("id"), F.col(f"`{column}`").cast("string"))


def _check(key: Column) -> Column:
    return F.xxhash64(F.lit("check"), key).bitwiseAND(F.lit(0xFFFFFFFF))


def _spread(rows: DataFrame, cells: int) -> DataFrame:
    """(cell, n, keys, checks) of rows (key, n), summed."""
    part = cells // HASHES
    places = F.array(*[F.pmod(F.xxhash64(F.lit(i), F.col("key")), F.lit(part)) + i * part for i in range(HASHES)])
    n = F.col("n").cast(_SUM)
    return rows.select(F.explode(places).alias("cell"), "n", (n * F.col("key").cast("decimal(19,0)")).cast(_SUM).alias("keys"),
                       (F.col("n") * _check(F.col("key"))).cast(_SUM).alias("checks")).groupBy("cell").agg(
        F.sum("n").alias("n"), F.sum("keys").cast(_SUM).alias("keys"), F.sum("checks").cast(_SUM).alias("checks"))


def sketch(ids: DataFrame, column: str, cells: int = FIRST_CELLS) -> DataFrame:
    """The lookup table of one side; rows without an id aren't documents."""
    keys = ids.filter(F.col(f"`{column}`").isNotNull()).select(_key(ids, column).alias("key"))
    return _spread(keys.select("key", F.lit(1).cast("bigint").alias("n")), cells)


def subtract(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Cells that differ."""
    negative = theirs.select("cell", (-F.col("n")).alias("n"), (-F.col("keys")).cast(_SUM).alias("keys"),
                             (-F.col("checks")).cast(_SUM).alias("checks"))
    return _sum(ours.unionByName(negative))


def _sum(cells: DataFrame) -> DataFrame:
    return cells.groupBy("cell").agg(
        F.sum("n").alias("n"), F.sum("keys").cast(_SUM).alias("keys"), F.sum("checks").cast(_SUM).alias("checks")).filter(
        "n != 0 or keys != 0 or checks != 0")


def peel(cells: DataFrame, size: int) -> DataFrame:
    """(key, n) of all ids in the difference: n times more in ours (negative:
    in theirs). Raises ``TooSmall`` where a rest stays."""
    cells = cells.checkpoint()
    spark = cells.sparkSession
    found = spark.createDataFrame([], "key bigint, n bigint")
    while not cells.isEmpty():
        # A cell of one id: the value is a whole number of times the count.
        key = F.expr("cast(try_divide(keys, n) as decimal(38,0))")
        pure = cells.filter("n != 0").withColumn("key", key).filter(
            (F.col("key") * F.col("n") == F.col("keys")) & F.expr("key between -9223372036854775808 and 9223372036854775807"))
        pure = pure.withColumn("key", F.col("key").cast("bigint")).filter(
            F.col("checks") == (F.col("n") * _check(F.col("key"))).cast(_SUM))
        # The same id may be alone in several cells; other ones can't be there.
        out = pure.groupBy("key").agg(F.max_by("n", F.abs("n")).alias("n")).checkpoint()
        if out.isEmpty():
            raise TooSmall
        found = found.unionByName(out)
        cells = subtract(cells, _spread(out, size)).checkpoint()
    return found.checkpoint()


def differences(ours: DataFrame, theirs: DataFrame, column: str, *, cells: int = FIRST_CELLS) -> DataFrame:
    """(id, surplus): ids of which one side has more than the other; surplus is
    positive for ``ours``. Reads each side once for each size that is tried."""
    from docferry.session import checkpoint_dir

    checkpoint_dir(ours.sparkSession)
    while True:
        size = -(-cells // HASHES) * HASHES
        try:
            found = peel(subtract(sketch(ours, column, size), sketch(theirs, column, size)), size)
            break
        except TooSmall:
            cells *= GROWTH
    if isinstance(ours.schema[column].dataType, T.StringType):
        known = ours.select(F.col(f"`{column}`").alias("id")).unionByName(theirs.select(F.col(f"`{column}`").alias("id")))
        names = known.withColumn("key", _key(known, "id")).join(found.select("key"), "key", "left_semi").distinct()
        return found.join(names, "key").select("id", F.col("n").alias("surplus"))
    return found.select(F.col("key").cast(ours.schema[column].dataType).alias("id"), F.col("n").alias("surplus"))
