"""Registered queries: ordered exports and their hash trees."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docferry.functions.render import csv_line
from docferry.operators import tree_digest
from docferry.operators.ordered_export import OrderedExport, numbered_lines, write_ordered
from docferry.operators.projection import project
from docferry.plans.projections import ORDER_EXPORT_COLUMNS, ORDER_EXPORT_PATHS, with_line
from docferry.plans.sqltext import ITEMS_CTE, csv_line_sql, txt
from docferry.session import checkpoint_dir
from docferry.sources.documents import order_documents
from docferry.sources.tables import read_table

PART_BYTES = 1 << 16
FLAG_COLUMNS = ["l_returnflag", "l_linestatus"]


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/exports/{name}-{uuid.uuid4().hex}"


def ordered_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export whose lines are few and very frequent, by a key that is
    too: its lines with their place in all parts, read from the files."""
    li = read_table(spark, sf_dir, "lineitem").select(*FLAG_COLUMNS)
    rows = li.select("*", csv_line([F.col(c) for c in FLAG_COLUMNS]).alias("line"))
    done = write_ordered(rows, ["l_returnflag"], FLAG_COLUMNS, out_dir=_scratch(spark, "flags"),
                         target_bytes=PART_BYTES)
    return numbered_lines(spark, done)


def ordered_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the same export, whether parts adjoin, and whether any is larger
    than one and a half times the target."""
    li = read_table(spark, sf_dir, "lineitem").select(*FLAG_COLUMNS)
    rows = li.select("*", csv_line([F.col(c) for c in FLAG_COLUMNS]).alias("line"))
    done = write_ordered(rows, ["l_returnflag"], FLAG_COLUMNS, out_dir=_scratch(spark, "flags"),
                         target_bytes=PART_BYTES)
    parts = spark.read.parquet(done.manifest_path)
    return parts.agg(
        F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"),
        (F.max("bytes") <= PART_BYTES * 3 // 2).alias("balanced"),
        (F.max(F.col("first") + F.col("rows")) == F.sum("rows")).alias("adjoining"))


def _orders(spark: SparkSession, sf_dir: str) -> OrderedExport:
    rows = with_line(project(order_documents(spark, sf_dir), ORDER_EXPORT_COLUMNS, ORDER_EXPORT_PATHS,
                             keep=["order_id"]), ORDER_EXPORT_COLUMNS)
    return write_ordered(rows.select(F.col("__keep_0").alias("order_id"), "line"), ["order_id"], ORDER_EXPORT_COLUMNS,
                         out_dir=_scratch(spark, "orders"), name="orders.csv", target_bytes=PART_BYTES)


def export_tree_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: one digest of the flagship export, whatever its parts."""
    done = _orders(spark, sf_dir)
    nodes = tree_digest.read(spark, done.tree_path)
    return nodes.orderBy(F.desc("level"), "idx").limit(1).select(
        F.lit(done.row_count).cast("bigint").alias("rows"), F.col("hash").alias("root"))


def export_tree_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places at which another copy of the export differs, found from the
    two trees' roots down and in the chunks they lead to."""
    done = _orders(spark, sf_dir)
    lines = numbered_lines(spark, done)
    order = F.split("line", ",")[0].cast("bigint")
    copy = lines.select("idx", F.when(order % 997 == 0, F.concat("line", F.lit("!"))).otherwise(F.col("line")).alias("line"))
    theirs = tree_digest.build(copy, _scratch(spark, "copy"))
    chunks = tree_digest.changed_chunks(tree_digest.read(spark, done.tree_path), theirs)
    return tree_digest.changed_lines(lines, copy, chunks)


def export_line_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: proofs that every 500th line belongs to the export's digest."""
    done = _orders(spark, sf_dir)
    lines = numbered_lines(spark, done)
    wanted = lines.filter(F.col("idx") % 500 == 0)
    proof = tree_digest.proofs(tree_digest.read(spark, done.tree_path), lines, wanted.select("idx"))
    return tree_digest.proven(wanted, proof, done.root)


_FLAG_LINE = csv_line_sql([txt(c) for c in FLAG_COLUMNS])
_CELLS = [txt("o.o_orderkey"), txt("c.c_name"), txt("CAST(round(o.o_totalprice * 100) AS BIGINT)"), txt("i0.l_partkey")]
_ORDER_LINES = f"""{ITEMS_CTE},
numbered AS (
  SELECT row_number() OVER (ORDER BY k, md5(line)) - 1 AS idx, k, line FROM (
    SELECT o.o_orderkey AS k, {csv_line_sql(_CELLS)} AS line
    FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
    LEFT JOIN items i0 ON i0.l_orderkey = o.o_orderkey AND i0.rn = 1))"""


QUERIES = {
    "ordered_export": (ordered_export, lambda: f"""SELECT
  CAST(row_number() OVER (ORDER BY l_returnflag NULLS FIRST, md5(line)) - 1 AS BIGINT) AS idx, line
FROM (SELECT l_returnflag, {_FLAG_LINE} AS line FROM lineitem)"""),
    "ordered_parts": (ordered_parts, lambda: f"""SELECT count(*) AS rows,
  CAST(sum(strlen(line) + 1) + {len(','.join(FLAG_COLUMNS)) + 1} AS BIGINT) AS bytes, true AS balanced, true AS adjoining
FROM (SELECT {_FLAG_LINE} AS line FROM lineitem)"""),
    "export_tree_root": (export_tree_root, lambda: f"""WITH {_ORDER_LINES},
{tree_digest.root_sql("SELECT idx, line FROM numbered").replace(
    "SELECT coalesce", "SELECT (SELECT count(*) FROM numbered) AS rows, coalesce")}"""),
    "export_tree_changes": (export_tree_changes, lambda: f"""WITH {_ORDER_LINES}
SELECT idx FROM numbered WHERE k % 997 = 0"""),
    "export_line_proofs": (export_line_proofs, lambda: f"""WITH {_ORDER_LINES},
n AS (SELECT count(*) AS n FROM numbered)
SELECT idx, CAST(list_sum(list_transform(range(0, 40), lambda k:
    CASE WHEN ((n + (1::BIGINT << k) - 1) >> k) > 1 AND xor(idx >> k, 1) < ((n + (1::BIGINT << k) - 1) >> k)
    THEN 1 ELSE 0 END)) AS INTEGER) AS steps, true AS proven
FROM numbered, n WHERE idx % 500 = 0"""),
}
