"""Document tables.

A job reads *documents*: nested records addressed by dotted paths. Two kinds
of source are supported:

* a DataFrame whose rows already are the documents (nested structs, arrays,
  maps, or ``variant`` columns for schemaless JSON) — ``DocumentView.of``;
* a document assembled from relational tables — a root table, to-one
  *lookups* (``customer`` of an order) and ordered to-many *child lists*
  (``items`` of an order).

For the relational kind the documents are never materialised as a whole.
``bind`` joins only the relations the job's paths touch: a lookup is an equi
join; ``items[k]`` ranks the child rows per parent and keeps ranks ``<= k+1``
(Spark runs that limit map-side, before the shuffle, so a parent with
millions of children ships at most k+1 rows per task); only a path that asks
for a *whole* child list collects that list per document.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docferry.functions.paths import MISSING, Index, Key, PathError, Resolved, tokenize, walk
from docferry.functions.paths import resolve as resolve_path
from docferry.sources.tables import read_table


@dataclass(frozen=True)
class Lookup:
    """To-one relation: ``root[fk] = frame[key]``; document field = ``value``."""

    frame: DataFrame
    key: str
    fk: str
    value: Column


@dataclass(frozen=True)
class Children:
    """To-many relation: ``frame[parent] = root[id]``; list ordered by ``order``."""

    frame: DataFrame
    parent: str
    order: tuple[str, ...]
    value: Column


@dataclass
class Bound:
    """A document frame with the columns a set of paths needs, plus the
    resolver that turns those paths into columns of that frame."""

    frame: DataFrame
    id_column: str | None
    extra: dict[str, tuple[str, T.DataType]] = field(default_factory=dict)
    visible: T.StructType | None = None
    variant_root: str | None = None

    def resolve(self, path: str, *, fan_out: bool = False) -> Resolved:
        if path == "":
            raise PathError("empty path")
        steps = tokenize(path)
        if not steps:
            return MISSING
        if self.variant_root is not None:
            if self.id_column is not None and steps == [Key("_id")]:
                return resolve_path(self.frame.schema, "_id", id_column=self.id_column)
            return walk(F.col(f"`{self.variant_root}`"), T.VariantType(), steps, fan_out=fan_out)
        head = steps[0]
        if isinstance(head, Key) and head.name in self.extra and (
                self.id_column is None or steps != [Key("_id")]):
            col_name, dtype = self.extra[head.name]
            return walk(F.col(col_name), dtype, steps[1:], fan_out=fan_out)
        if len(steps) >= 2 and isinstance(head, Key) and isinstance(steps[1], Index):
            slot = f"{head.name}[{steps[1].pos}]"
            if slot in self.extra:
                col_name, dtype = self.extra[slot]
                return walk(F.col(col_name), dtype, steps[2:], fan_out=fan_out)
        schema = self.visible if self.visible is not None else self.frame.schema
        return resolve_path(schema, path, id_column=self.id_column, fan_out=fan_out)


def _orderable(dt: T.DataType) -> bool:
    """Whether Spark can compare values of this type (maps and variants not)."""
    if isinstance(dt, (T.MapType, T.VariantType)):
        return False
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    return True


def _by_keys(n: int):
    """Comparator on the fields ``o0..o{n-1}`` (nulls first, like a sort)."""
    def compare(a: Column, b: Column) -> Column:
        out = F.lit(0)
        for i in reversed(range(n)):
            x, y = a[f"o{i}"], b[f"o{i}"]
            out = (F.when(x.isNull() & y.isNotNull(), -1).when(x.isNotNull() & y.isNull(), 1)
                   .when(x < y, -1).when(x > y, 1).otherwise(out))
        return out
    return compare


class DocumentView:
    def __init__(self, root: DataFrame, id_column: str | None,
                 lookups: dict[str, Lookup] | None = None,
                 children: dict[str, Children] | None = None, *,
                 variant_root: str | None = None) -> None:
        self.root = root
        self.id_column = id_column
        self.variant_root = variant_root
        self.lookups = dict(lookups or {})
        self.children = dict(children or {})
        clash = set(self.lookups) | set(self.children)
        clash &= set(root.columns)
        if clash:
            raise ValueError(f"relation names shadow root columns: {sorted(clash)}")

    @classmethod
    def of(cls, df: DataFrame, id_column: str | None = None) -> DocumentView:
        return cls(df, id_column)

    @classmethod
    def schemaless(cls, df: DataFrame, doc_column: str, id_column: str | None = None) -> DocumentView:
        """Documents held whole in one ``variant`` column; paths start inside it."""
        return cls(df, id_column, variant_root=doc_column)

    @property
    def schema(self) -> T.StructType:
        """The document schema as paths see it (relations as struct / array)."""
        fields = list(self.root.schema.fields)
        for name, lk in self.lookups.items():
            fields.append(T.StructField(name, lk.frame.select(lk.value).schema[0].dataType))
        for name, ch in self.children.items():
            elem = ch.frame.select(ch.value).schema[0].dataType
            fields.append(T.StructField(name, T.ArrayType(elem)))
        return T.StructType(fields)

    def bind(self, paths: list[str]) -> Bound:
        """Join the relations ``paths`` reach; everything else stays a scan."""
        if not self.lookups and not self.children:
            return Bound(self.root, self.id_column, variant_root=self.variant_root)
        want_lookup: set[str] = set()
        want_rank: dict[str, set[int]] = defaultdict(set)
        want_whole: set[str] = set()
        # First-level fields of each relation's value that some path reads
        # (None: the whole value). Values are built from only these, so the
        # scan, sort and shuffle carry no unused columns.
        needed: dict[str, set[str] | None] = {}

        def need(name: str, step) -> None:
            if name in needed and needed[name] is None:
                return
            if isinstance(step, Key):
                needed.setdefault(name, set()).add(step.name)
            else:
                needed[name] = None

        for p in paths:
            steps = tokenize(p)
            if not steps or not isinstance(steps[0], Key):
                continue
            name = steps[0].name
            if name in self.lookups:
                want_lookup.add(name)
                need(name, steps[1] if len(steps) > 1 else None)
            elif name in self.children:
                if len(steps) == 1:
                    want_whole.add(name)
                    need(name, None)
                elif isinstance(steps[1], Index):
                    want_rank[name].add(steps[1].pos)
                    need(name, steps[2] if len(steps) > 2 else None)
        df = self.root
        extra: dict[str, tuple[str, T.DataType]] = {}
        for name in sorted(want_lookup):
            lk = self.lookups[name]
            lk = Lookup(lk.frame, lk.key, lk.fk, self._pruned(lk.frame, lk.value, needed.get(name)))
            alias = f"__lk_{name}"
            side = lk.frame.select(F.col(lk.key).alias(f"{alias}_key"), lk.value.alias(alias))
            df = df.join(side, df[lk.fk] == side[f"{alias}_key"], "left").drop(f"{alias}_key")
            extra[name] = (alias, side.schema[alias].dataType)
        for name in sorted(want_rank):
            ch = self.children[name]
            ch = Children(ch.frame, ch.parent, ch.order, self._pruned(ch.frame, ch.value, needed.get(name)))
            ranks = sorted(want_rank[name])
            elem = ch.frame.select(ch.value).schema[0].dataType
            if ranks == [0] and _orderable(elem):
                # Only the first child: a min aggregate, combined map-side.
                alias = f"__ch_{name}_0"
                side = self._first(ch, alias)
                df = df.join(side, df[self.id_column] == side[f"{alias}_p"], "left")
                df = df.drop(f"{alias}_p")
                extra[f"{name}[0]"] = (alias, elem)
                continue
            # One window limited to the largest rank (the limit runs map-side);
            # only the wanted ranks go on, and each is a conditional aggregate,
            # so a parent leaves every task as one row and nothing is gathered.
            alias = f"__ch_{name}"
            side = self._ranked(ch, ranks).groupBy(F.col("__parent").alias(f"{alias}_p")).agg(
                *[F.first(F.when(F.col("__rn") == k + 1, F.col("__v")), ignorenulls=True).alias(f"{alias}_{k}")
                  for k in ranks])
            df = df.join(side, df[self.id_column] == side[f"{alias}_p"], "left").drop(f"{alias}_p")
            for k in ranks:
                extra[f"{name}[{k}]"] = (f"{alias}_{k}", elem)
        for name in sorted(want_whole):
            ch = self.children[name]
            alias = f"__arr_{name}"
            keyed = ch.frame.select(
                F.col(ch.parent).alias("__parent"),
                F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(ch.order)],
                         ch.value.alias("v")).alias("__kv"))
            # Sorted by the order keys only (values need not be orderable).
            side = keyed.groupBy("__parent").agg(
                F.transform(F.array_sort(F.collect_list("__kv"), _by_keys(len(ch.order))),
                            lambda x: x["v"]).alias(alias))
            df = df.join(side, df[self.id_column] == side["__parent"], "left").drop("__parent")
            # A document without children still has the list, empty.
            list_type = side.schema[alias].dataType
            df = df.withColumn(alias, F.coalesce(F.col(alias), F.array().cast(list_type)))
            extra[name] = (alias, list_type)
        return Bound(df, self.id_column, extra, visible=self.root.schema)

    @staticmethod
    def _pruned(frame: DataFrame, value: Column, fields: set[str] | None) -> Column:
        """``value`` (a struct) reduced to ``fields``; fields a path names but
        the struct lacks are left out (the path then reads as missing)."""
        if fields is None:
            return value
        st = frame.select(value.alias("v")).schema["v"].dataType
        if not isinstance(st, T.StructType):
            return value
        keep = [f.name for f in st.fields if f.name in fields]
        if not keep:
            keep = [st.fields[0].name]
        return F.struct(*[value.getField(f).alias(f) for f in keep])

    @staticmethod
    def _first(ch: Children, alias: str) -> DataFrame:
        """First child per parent as a min over (order keys, value): an
        aggregate that combines map-side, so a parent with any number of
        children leaves each task as one row."""
        keyed = F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(ch.order)],
                         ch.value.alias("v"))
        return (ch.frame.groupBy(F.col(ch.parent).alias(f"{alias}_p"))
                .agg(F.min(keyed)["v"].alias(alias)))

    @staticmethod
    def _ranked(ch: Children, ranks: list[int]) -> DataFrame:
        w = Window.partitionBy(F.col(ch.parent)).orderBy(*[F.col(o) for o in ch.order])
        ranked = ch.frame.select(F.col(ch.parent).alias("__parent"), ch.value.alias("__v"),
                                 F.row_number().over(w).alias("__rn"))
        return ranked.where(F.col("__rn") <= ranks[-1] + 1).where(F.col("__rn").isin([k + 1 for k in ranks]))

    def nested(self) -> DataFrame:
        """Whole documents as one nested row each (every relation joined).

        Each child list is collected per document; use for exports that need
        full documents (NDJSON), not for column projection.
        """
        paths = list(self.lookups) + list(self.children)
        b = self.bind(paths)
        cols = [F.col(f"`{c}`") for c in self.root.columns]
        for name in self.lookups:
            cols.append(F.col(b.extra[name][0]).alias(name))
        for name in self.children:
            cols.append(F.col(b.extra[name][0]).alias(name))
        return b.frame.select(*cols)


# ---------------------------------------------------------------------------
# Document views over the driver tables.
# ---------------------------------------------------------------------------

def order_documents(spark: SparkSession, sf_dir: str) -> DocumentView:
    """Order documents: order fields, ``customer`` (to-one), ``items`` (list of
    line items ordered by line number, part and supplier)."""
    orders = read_table(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer")
    lineitem = read_table(spark, sf_dir, "lineitem")
    root = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_key"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").alias("order_date"),
        F.struct(
            F.round(F.col("o_totalprice") * 100).cast("bigint").alias("amount_cents"),
            F.col("o_totalprice").alias("price"),
        ).alias("totals"),
    )
    cust = Lookup(
        frame=customer, key="c_custkey", fk="customer_key",
        value=F.struct(
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_nationkey").alias("nation_key"),
            F.round(F.col("c_acctbal") * 100).cast("bigint").alias("balance_cents"),
        ))
    items = Children(
        frame=lineitem, parent="l_orderkey",
        order=("l_linenumber", "l_partkey", "l_suppkey"),
        value=F.struct(
            F.col("l_linenumber").alias("line"),
            F.col("l_partkey").alias("sku"),
            F.col("l_suppkey").alias("supplier"),
            F.col("l_quantity").alias("qty"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_discount").alias("discount"),
            F.struct(
                F.col("l_shipdate").alias("date"),
                F.col("l_returnflag").alias("flag"),
                F.col("l_linestatus").alias("status"),
            ).alias("ship"),
        ))
    return DocumentView(root, "order_id", {"customer": cust}, {"items": items})


def event_documents(spark: SparkSession, sf_dir: str) -> DocumentView:
    """Event documents; ``props`` holds schemaless JSON and is read as variant."""
    events = read_table(spark, sf_dir, "events")
    root = events.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.try_parse_json("props").alias("props"),
    )
    return DocumentView(root, "event_id")


def json_documents(spark: SparkSession, path: str, *, id_path: str | None = None) -> DocumentView:
    """Schemaless documents from JSON-lines files (one object per line).

    Each line is parsed once into a ``variant`` (duplicate keys: last wins);
    a line that is not JSON becomes a null document, which every path reads
    as missing. ``id_path`` names the field that serves as ``_id``.
    """
    docs = spark.read.option("lineSep", "\n").text(path).select(
        F.try_parse_json("value").alias("_source"))
    if id_path is not None:
        r = walk(F.col("_source"), T.VariantType(), tokenize(id_path))
        docs = docs.select(F.try_variant_get(r.column, "$", "string").alias("_id"), "_source")
        return DocumentView.schemaless(docs, "_source", "_id")
    return DocumentView.schemaless(docs, "_source")


def json_string_documents(df: DataFrame, column: str, *, id_column: str | None = None) -> DocumentView:
    """Schemaless documents from a JSON string column of a table."""
    keep = [id_column] if id_column else []
    docs = df.select(*keep, F.try_parse_json(F.col(column)).alias("_source"))
    return DocumentView.schemaless(docs, "_source", id_column)


def conversation_documents(spark: SparkSession, sf_dir: str) -> DocumentView:
    """One document per conversation with its ``turns`` in turn order."""
    conv = read_table(spark, sf_dir, "conversations")
    root = conv.select("conv_id").distinct()
    turns = Children(
        frame=conv, parent="conv_id", order=("turn", "role", "text"),
        value=F.struct(F.col("turn"), F.col("role"), F.col("text")))
    return DocumentView(root, "conv_id", children={"turns": turns})
