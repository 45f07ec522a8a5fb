"""Cell and line rendering, all as built-in Spark expressions.

* ``cell_text``: a typed value -> the text the CSV cell carries
  (null -> "", booleans lower case, floats in Python ``repr`` form,
  nested values as JSON laid out like Python's ``json.dumps``).
* ``csv_line``: cells -> one CSV record with minimal quoting, the same bytes
  Python's ``csv`` writer produces with ``lineterminator="\\n"``.
* ``formula_guard``: opt-in neutraliser for spreadsheet formulas.
"""

from __future__ import annotations

import csv
import io
import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters that force a CSV field into quotes under minimal
# quoting, and characters that start a spreadsheet formula.
CSV_SPECIAL = (",", '"', "\r", "\n")
FORMULA_START = ("=", "+", "-", "@")
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _shortest(c: Column) -> Column:
    """Spark's text of a double, trimmed to 15, 16 or 17 significant digits when
    such a shorter form reads back as the same value (the JVM's printer can
    emit one digit more than the shortest round-trip form)."""
    s = c.cast("string")
    d = c.cast("double")
    s15 = F.format_string("%.14E", d)
    s16 = F.format_string("%.15E", d)
    s17 = F.format_string("%.16E", d)
    # Rounding the 17-digit text half-up can step past the shortest form;
    # the truncated 16-digit text is the other candidate.
    s16t = F.regexp_replace(s17, "^(-?\\d\\.\\d{15})\\d", "$1")
    long_form = F.length(F.regexp_replace(F.substring_index(s, "E", 1), "[^0-9]", "")) >= 17
    return (F.when(~long_form | F.isnan(d) | (F.abs(d) == float("inf")), s)
            .when(s15.try_cast("double") == d, s15)
            .when(s16.try_cast("double") == d, s16)
            .when(s16t.try_cast("double") == d, s16t)
            .when(s17.try_cast("double") == d, s17)
            .otherwise(s))


def py_float_text(c: Column) -> Column:
    """Render a float/double column the way Python's ``repr(float)`` does.

    Spark prints positional text only for magnitudes in [1e-3, 1e7) and
    ``1.0E16`` style elsewhere; Python is positional in [1e-4, 1e16) and
    writes ``1e+16`` / ``1.5e-05`` beyond. Inside Spark's positional range the
    two agree; the rest of Python's positional range is laid out through an
    exact decimal cast, and the scientific form is rewritten by regex.
    """
    # Fast path, in generated code: Spark's positional text with at most 16
    # significant digits is already Python's text. Other values bind their
    # shortest text once (a one-element array and a lambda) so the layout
    # below does not repeat its expression tree.
    s = c.cast("string")
    # Spark's text of a double always holds a '.', so 17 characters or fewer
    # means at most 16 digits; E / NaN / Infinity take the slow path.
    fast = (F.length(s) <= 17) & ~s.contains("E") & ~s.contains("N") & ~s.contains("I")
    slow = F.element_at(F.transform(F.array(_shortest(c)), _layout), 1)
    return F.when(fast, s).otherwise(slow)


def _layout(s: Column) -> Column:
    num = s.try_cast("double")
    a = F.abs(num)
    plain = F.regexp_replace(
        F.regexp_replace(s.cast("decimal(38,22)").cast("string"), "0+$", ""), "\\.$", ".0")
    sci = F.regexp_replace(F.regexp_replace(s, "\\.?0+E", "E"), "E(\\d)", "E+$1")
    sci = F.lower(F.regexp_replace(sci, "E([+-])(\\d)$", "E$1#$2"))
    sci = F.replace(sci, F.lit("#"), F.lit("0"))
    return (F.when(s.isNull(), F.lit(None).cast("string"))
            .when(s == "NaN", F.lit("nan"))
            .when(s == "Infinity", F.lit("inf"))
            .when(s == "-Infinity", F.lit("-inf"))
            .when(~s.contains("E"), s)
            .when((a >= 1e-4) & (a < 1e16), plain)
            .otherwise(sci))


def _variant_text(v: Column) -> Column:
    kind = F.schema_of_variant(v)
    return (
        F.when(v.isNull() | F.is_variant_null(v), F.lit(None).cast("string"))
        .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), respace_json(F.to_json(v)))
        # JSON numbers with a fraction or exponent are floats to a JSON
        # reader; the variant may hold them as decimals (1.0 -> DECIMAL(2,1)).
        .when(kind.isin("DOUBLE", "FLOAT")
              | (kind.startswith("DECIMAL") & ~kind.endswith(",0)")),
              py_float_text(F.try_variant_get(v, "$", "double")))
        .otherwise(F.try_variant_get(v, "$", "string")))


def value_text(c: Column, dtype: T.DataType) -> Column:
    """Text of a typed value; null stays null (``cell_text`` maps it to "")."""
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return py_float_text(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, TIMESTAMP_FORMAT)
    if isinstance(dtype, T.VariantType):
        return _variant_text(c)
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        # Nested values as JSON text, laid out like Python's json.dumps.
        return F.when(c.isNotNull(), py_json(c, dtype))
    if isinstance(dtype, T.NullType):
        return F.lit(None).cast("string")
    return c.cast("string")


def cell_text(c: Column | None, dtype: T.DataType | None) -> Column:
    """Cell text of a resolved path value; a missing path is the empty string."""
    if c is None or dtype is None:
        return F.lit("")
    return F.coalesce(value_text(c, dtype), F.lit(""))


def csv_field(text: Column) -> Column:
    """Quote one non-null cell when it holds a delimiter, quote or line break."""
    # Plain substring tests (byte searches), cheaper than a regex per cell.
    special = text.contains(CSV_SPECIAL[0])
    for ch in CSV_SPECIAL[1:]:
        special = special | text.contains(ch)
    return (F.when(special,
                   F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"')))
            .otherwise(text))


def csv_line(cells: list[Column]) -> Column:
    """One CSV record (without the line terminator) from non-null text cells."""
    if not cells:
        raise ValueError("a CSV line needs at least one column")
    if len(cells) == 1:
        # A lone empty field is written as "" so the record is not a blank line.
        return F.when(cells[0] == "", F.lit('""')).otherwise(csv_field(cells[0]))
    return F.concat_ws(",", *[csv_field(c) for c in cells])


def header_line(columns: list[str]) -> str:
    """Header record for ``columns`` (driver side: it is one small string)."""
    buf = io.StringIO()
    csv.writer(buf, lineterminator="\n").writerow(columns)
    return buf.getvalue()[:-1]


def formula_guard(text: Column) -> Column:
    """Prefix ``'`` to a text cell that a spreadsheet would run as a formula."""
    return (F.when(F.substring(text, 1, 1).isin(*FORMULA_START), F.concat(F.lit("'"), text))
            .otherwise(text))


def basename(remote: Column) -> Column:
    """Last non-empty segment of a ``/`` path (``a/b/c.csv`` -> ``c.csv``)."""
    return F.regexp_extract(remote, "([^/]*)/*$", 1)


def sidecar_name(remote: Column) -> Column:
    return F.concat(remote, F.lit(".sha256"))


# The control characters whose \u escape holds a hex letter
# (Spark writes it upper case, Python lower case); the others use a short
# escape (\b \t \n \f \r) or digits only.
_HEX_LETTER_ESCAPES = ("000B", "000E", "000F", "001A", "001B", "001C", "001D", "001E", "001F")


# Fixed value: a JSON string token, or a separator outside strings.
_JSON_TOKEN = r'("(?:[^"\\]++|\\.)*+")|([:,])'
_MARK = "\u0001"  # never raw in Spark's JSON output (escaped inside strings)


def _lower_hex_escapes(text: Column) -> Column:
    lower = text
    for code in _HEX_LETTER_ESCAPES:
        lower = F.replace(lower, F.lit("\\u" + code), F.lit("\\u" + code.lower()))
    return F.when(text.contains("\\u00"), lower).otherwise(text)


def respace_json(compact: Column) -> Column:
    """Compact JSON (as Spark writes it) -> Python's ``json.dumps`` spacing:
    a space after every ``:`` and ``,`` outside strings (marked in one regex
    pass, since only the separators are followed by the marker)."""
    marked = F.regexp_replace(compact, _JSON_TOKEN, "$1$2" + _MARK)
    spaced = F.replace(F.replace(marked, F.lit(":" + _MARK), F.lit(": ")),
                       F.lit("," + _MARK), F.lit(", "))
    return _lower_hex_escapes(F.replace(spaced, F.lit(_MARK), F.lit("")))


def _json_string(c: Column) -> Column:
    """A string as a JSON string literal (quotes, escapes; non-ASCII kept).

    Without control characters only ``\\`` and ``"`` need escaping; the
    rest go through Spark's JSON writer."""
    plain = F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")),
                                           F.lit('"'), F.lit('\\"')), F.lit('"'))
    enc = F.to_json(F.struct(c.alias("s")))
    full = _lower_hex_escapes(F.substring(enc, 6, F.length(enc) - 6))  # strip '{"s":' and '}'
    return F.when(c.rlike("[\\x00-\\x1f]"), full).otherwise(plain)


def py_json(c: Column, dtype: T.DataType) -> Column:
    """JSON text of a value laid out like Python's ``json.dumps`` defaults:
    ``", "`` and ``": "`` separators, floats as ``repr``, non-ASCII kept.
    Built from the schema when the plan is made (no per-row Python)."""
    if isinstance(dtype, T.StructType):
        parts = []
        for i, f in enumerate(dtype.fields):
            key = F.lit(("" if i == 0 else ", ") + json.dumps(f.name, ensure_ascii=False) + ": ")
            parts += [key, py_json(c.getField(f.name), f.dataType)]
        body = F.concat(F.lit("{"), *parts, F.lit("}")) if parts else F.lit("{}")
        return F.when(c.isNull(), F.lit("null")).otherwise(body)
    if isinstance(dtype, T.ArrayType):
        items = F.transform(c, lambda x: py_json(x, dtype.elementType))
        return F.when(c.isNull(), F.lit("null")).otherwise(
            F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]")))
    if isinstance(dtype, T.MapType):
        entries = F.transform(F.map_entries(c), lambda e: F.concat(
            _json_string(e["key"].cast("string")), F.lit(": "), py_json(e["value"], dtype.valueType)))
        return F.when(c.isNull(), F.lit("null")).otherwise(
            F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}")))
    if isinstance(dtype, T.BooleanType):
        return F.when(c.isNull(), F.lit("null")).when(c, F.lit("true")).otherwise(F.lit("false"))
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)):
        return F.coalesce(c.cast("string"), F.lit("null"))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        # Python writes NaN / Infinity for non-finite floats.
        t = py_float_text(c)
        return (F.when(c.isNull(), F.lit("null")).when(t == "nan", F.lit("NaN"))
                .when(t == "inf", F.lit("Infinity")).when(t == "-inf", F.lit("-Infinity"))
                .otherwise(t))
    if isinstance(dtype, T.VariantType):
        return F.coalesce(respace_json(F.to_json(c)), F.lit("null"))
    text = value_text(c, dtype)
    return F.when(text.isNull(), F.lit("null")).otherwise(_json_string(text))


def json_line(*cols: Column, schema: T.StructType | None = None) -> Column:
    """One JSON object per row with every field, nulls kept (NDJSON record).

    With the columns' ``schema`` the text is laid out like Python's
    ``json.dumps``; without it, compact JSON."""
    if schema is None:
        return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    return py_json(F.struct(*cols), schema)
