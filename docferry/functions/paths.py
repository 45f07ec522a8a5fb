"""Dotted-path language: ``a``, ``a.b.c``, ``a.b[0]``, ``a.b[0].c``.

A path is split once per job on the driver (``tokenize``) and compiled to one
Spark ``Column`` per output column (``resolve``). Nothing here runs per row in
Python: the compiled expressions stay inside whole-stage codegen.

Semantics kept from the source system:

* a key step needs an object with exactly that key (case-sensitive);
* an index step ``[N]`` needs a list with ``0 <= N < len``;
* any failed step, or a null anywhere on the way, makes the value *missing*,
  which renders as the empty string;
* a key step on a list is missing (no fan-out over list items);
* ``a.0`` is the key ``"0"``, never an index; ``a[x]`` reads the key ``x]``;
  empty segments vanish (``a..b`` is ``a.b``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


class PathError(ValueError):
    """A path that can never be compiled (raised when the plan is built)."""


@dataclass(frozen=True)
class Key:
    name: str


@dataclass(frozen=True)
class Index:
    pos: int


Step = Key | Index


def tokenize(path: str) -> list[Step]:
    """Split a path into key and index steps.

    Scanning rule: ``.`` separates segments and is dropped; ``[`` followed by
    digits and ``]`` is an index step; a ``[`` that does not open such an index
    is dropped; any other run of characters up to the next ``.`` or ``[`` is a
    key step.
    """
    steps: list[Step] = []
    i, n = 0, len(path)
    while i < n:
        ch = path[i]
        if ch == ".":
            i += 1
            continue
        if ch == "[":
            j = i + 1
            while j < n and path[j].isdecimal():
                j += 1
            if j > i + 1 and j < n and path[j] == "]":
                steps.append(Index(int(path[i + 1:j])))
                i = j + 1
            else:
                i += 1
            continue
        j = i
        while j < n and path[j] not in ".[":
            j += 1
        steps.append(Key(path[i:j]))
        i = j
    return steps


@dataclass(frozen=True)
class Resolved:
    """A compiled path: the value column and its Spark type (None = missing)."""

    column: Column | None
    dtype: T.DataType | None

    @property
    def missing(self) -> bool:
        return self.column is None


MISSING = Resolved(None, None)


def _top_level(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _struct_field(st: T.StructType, name: str) -> T.StructField | None:
    for f in st.fields:
        if f.name == name:
            return f
    return None


def _json_path(steps: list[Step]) -> str:
    out = "$"
    for s in steps:
        if isinstance(s, Index):
            out += f"[{s.pos}]"
        else:
            out += '["' + s.name + '"]'
    return out


# No array holds more elements than this; a larger index reads as missing.
_MAX_INDEX = 2**31 - 1


def _path_safe(step: Step) -> bool:
    """Steps a variant path string can carry (it has no escapes)."""
    if isinstance(step, Index):
        return step.pos <= _MAX_INDEX
    return '"' not in step.name and "\\" not in step.name


def _walk_variant(cur: Column, steps: list[Step]) -> Resolved:
    """Variant steps: runs of safe steps become one path lookup; a key the
    path syntax cannot spell is looked up in the object as a map."""
    run: list[Step] = []
    for step in steps:
        if _path_safe(step):
            run.append(step)
            continue
        if run:
            cur = F.try_variant_get(cur, _json_path(run), "variant")
            run = []
        if isinstance(step, Index):
            return MISSING
        cur = F.try_element_at(F.try_variant_get(cur, "$", "map<string,variant>"), F.lit(step.name))
    if run:
        cur = F.try_variant_get(cur, _json_path(run), "variant")
    return Resolved(cur, T.VariantType())


def variant_values(root: Column, steps: list[Step]) -> Resolved:
    """All values a query path reaches in a schemaless document, as a list: a
    key on a list reads that key from every element, and a list at the end
    counts as its elements. An index step takes that element."""
    def elements(v: Column) -> Column:
        return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v))

    def read(step: Step):
        if _path_safe(step):
            return lambda v: F.try_variant_get(v, _json_path([step]), "variant")
        return lambda v: F.try_element_at(F.try_variant_get(v, "$", "map<string,variant>"), F.lit(step.name))

    values = F.array(root)
    for step in steps:
        if isinstance(step, Index):
            if step.pos > _MAX_INDEX:
                return MISSING
        else:
            values = F.flatten(F.transform(values, elements))
        values = F.transform(values, read(step))
    return Resolved(F.flatten(F.transform(values, elements)), T.ArrayType(T.VariantType()))


def walk(col: Column | None, dtype: T.DataType, steps: list[Step], *,
         fan_out: bool = False) -> Resolved:
    """Apply ``steps`` to a value of type ``dtype`` held by ``col``.

    ``col`` is None at document root, where ``dtype`` is the row schema and
    the first key step selects a top-level column. With ``fan_out`` (query
    fields) a key step on a list of objects reads that key from every
    element, giving a list of values, as a search engine treats such fields.
    """
    cur, typ = col, dtype
    for pos, step in enumerate(steps):
        if isinstance(typ, T.VariantType):
            return variant_values(cur, steps[pos:]) if fan_out else _walk_variant(cur, steps[pos:])
        if isinstance(step, Key):
            if isinstance(typ, T.StructType):
                field = _struct_field(typ, step.name)
                if field is None:
                    return MISSING
                cur = _top_level(step.name) if cur is None else cur.getField(step.name)
                typ = field.dataType
            elif isinstance(typ, T.MapType) and isinstance(typ.keyType, T.StringType):
                cur = F.try_element_at(cur, F.lit(step.name))
                typ = typ.valueType
            elif (fan_out and cur is not None and isinstance(typ, T.ArrayType)
                  and isinstance(typ.elementType, T.StructType)):
                field = _struct_field(typ.elementType, step.name)
                if field is None:
                    return MISSING
                cur = cur.getField(step.name)  # the field of every element
                typ = T.ArrayType(field.dataType)
                if isinstance(field.dataType, T.ArrayType):
                    cur, typ = F.flatten(cur), field.dataType
            else:
                return MISSING
        else:
            if cur is None or not isinstance(typ, T.ArrayType) or step.pos > _MAX_INDEX:
                return MISSING
            cur = F.get(cur, F.lit(step.pos))
            typ = typ.elementType
        if isinstance(typ, T.NullType):
            return MISSING
    return Resolved(cur, typ)


def resolve(schema: T.StructType, path: str, *, id_column: str | None = None,
            fan_out: bool = False) -> Resolved:
    """Compile ``path`` against a document schema.

    ``id_column`` names the column holding the document id; the path ``_id``
    resolves to it (the id wins over a document field of that name). A path
    without any step (``"."``) is missing rather than the whole document.
    """
    if path == "":
        raise PathError("empty path")
    steps = tokenize(path)
    if not steps:
        return MISSING
    if id_column is not None and steps == [Key("_id")]:
        field = _struct_field(schema, id_column)
        if field is None:
            raise PathError(f"id column {id_column!r} not in schema")
        return Resolved(_top_level(id_column), field.dataType)
    return walk(None, schema, steps, fan_out=fan_out)
