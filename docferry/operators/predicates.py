"""Job query (search-DSL object) -> one Spark boolean ``Column``.

Clauses: ``match_all``, ``range`` (gte/gt/lte/lt, date math on ``now``),
``term``, ``terms``, ``exists``, ``prefix``, ``ids`` and ``bool``
(must / filter / should / must_not, minimum_should_match).

Rules kept throughout:

* A field that is missing never matches a positive clause and always
  matches a negated one: every leaf is two-valued — ``col IS NOT NULL AND
  col op literal`` — before any ``NOT`` is applied (plain SQL ``NOT`` would
  drop null rows). Both parts are forms the parquet reader filters on, so
  the predicate reaches the scan.
* ``now`` is a parameter, resolved once per job run, so the count, the
  extract and a re-extract all see the same bounds.
* Anything not understood is a ``QueryError`` when the plan is built, never a
  silent ``true``.

The same Column drives the count and the scan of a job (they are
comparable by construction) and is pushed into the parquet scan by Catalyst
when it touches scan columns.
"""

from __future__ import annotations

import calendar
import re
from collections.abc import Callable, Mapping
from datetime import date, datetime, timedelta, timezone, tzinfo
from decimal import Decimal, InvalidOperation
from typing import Any
from zoneinfo import ZoneInfo, ZoneInfoNotFoundError

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docferry.functions.paths import Resolved


class QueryError(ValueError):
    """The job's query cannot be compiled."""


Resolver = Callable[[str], Resolved]

# Date-math steps — +/-N of a unit, or /unit rounding; units
# y (year), M (month), w (week), d (day), h/H (hour), m (minute), s (second).
_MATH = re.compile(r"([+-])(\d+)([yMwdhHms])|/([yMwdhHms])")


def _add_months(t: datetime, months: int) -> datetime:
    m = t.month - 1 + months
    y, m = t.year + m // 12, m % 12 + 1
    day = min(t.day, calendar.monthrange(y, m)[1])
    return t.replace(year=y, month=m, day=day)


def _floor(t: datetime, unit: str) -> datetime:
    if unit == "y":
        return datetime(t.year, 1, 1)
    if unit == "M":
        return datetime(t.year, t.month, 1)
    if unit == "w":
        d = t - timedelta(days=t.weekday())
        return datetime(d.year, d.month, d.day)
    if unit == "d":
        return datetime(t.year, t.month, t.day)
    if unit in ("h", "H"):
        return t.replace(minute=0, second=0, microsecond=0)
    if unit == "m":
        return t.replace(second=0, microsecond=0)
    return t.replace(microsecond=0)


def _ceil_end(t: datetime, unit: str) -> datetime:
    """Last millisecond of the ``unit`` that contains ``t``."""
    start = _floor(t, unit)
    if unit == "y":
        nxt = datetime(start.year + 1, 1, 1)
    elif unit == "M":
        nxt = _add_months(start, 1)
    else:
        span = {"w": timedelta(weeks=1), "d": timedelta(days=1), "h": timedelta(hours=1),
                "H": timedelta(hours=1), "m": timedelta(minutes=1), "s": timedelta(seconds=1)}
        nxt = start + span[unit]
    return nxt - timedelta(milliseconds=1)


def resolve_date_math(text: str, now: datetime, *, round_up: bool = False,
                      zone: tzinfo = timezone.utc) -> datetime:
    """``now-1d``, ``now+2h/d``, ``2024-01-01||+1M`` -> a datetime in UTC.

    Rounding (``/unit``) goes down, or to the unit's last millisecond when
    ``round_up`` (used for ``gt`` and ``lte``). A date without a zone is in
    ``zone``, and rounding is done there; ``now`` is an instant."""
    if text.startswith("now"):
        anchor, rest = _shift(now, timezone.utc, zone), text[3:]
    elif "||" in text:
        head, rest = text.split("||", 1)
        anchor = _shift(_parse_datetime(head, zone), timezone.utc, zone)
    else:
        return _parse_datetime(text, zone, round_up=round_up)
    t = anchor
    pos = 0
    while pos < len(rest):
        m = _MATH.match(rest, pos)
        if m is None:
            raise QueryError(f"bad date math {text!r}")
        if m.group(4):
            unit = m.group(4)
            t = _ceil_end(t, unit) if round_up else _floor(t, unit)
        else:
            n = int(m.group(2)) * (1 if m.group(1) == "+" else -1)
            unit = m.group(3)
            if unit == "y":
                t = _add_months(t, 12 * n)
            elif unit == "M":
                t = _add_months(t, n)
            else:
                t = t + {"w": timedelta(weeks=n), "d": timedelta(days=n),
                         "h": timedelta(hours=n), "H": timedelta(hours=n),
                         "m": timedelta(minutes=n), "s": timedelta(seconds=n)}[unit]
        pos = m.end()
    return _shift(t, zone, timezone.utc)


def _shift(t: datetime, source: tzinfo, target: tzinfo) -> datetime:
    """A wall-clock time of one zone as the other's (both without zone)."""
    return t.replace(tzinfo=source).astimezone(target).replace(tzinfo=None)


# A date with parts missing at its end.
_PARTIAL = re.compile(r"(\d{4})(?:-(\d{2})(?:-(\d{2})(?:T(\d{2})(?::(\d{2}))?)?)?)?(Z|[+-]\d{2}:?\d{2})?")


def _parse_datetime(text: str, zone: tzinfo = timezone.utc, *, round_up: bool = False) -> datetime:
    """A date in UTC. Missing month and day are 01; missing time parts are 0,
    or with ``round_up`` the last ones (23:59:59.999999)."""
    partial = _PARTIAL.fullmatch(text)
    try:
        if partial:
            year, month, day, hour, minute, offset = partial.groups()
            last = round_up
            v = datetime(int(year), int(month or 1), int(day or 1),
                         int(hour) if hour else 23 * last, int(minute) if minute else 59 * last,
                         59 * last, 999_999 * last)
            if offset:
                v = v.replace(tzinfo=_zone(offset))
        else:
            v = datetime.fromisoformat(text.replace("Z", "+00:00"))
    except ValueError:
        raise QueryError(f"bad date {text!r}") from None
    return _shift(v.replace(tzinfo=None), v.tzinfo or zone, timezone.utc)


def _zone(text: Any) -> tzinfo:
    """An offset (``+05:00``, ``Z``) or a zone's name."""
    if not isinstance(text, str):
        raise QueryError(f"bad time_zone {text!r}")
    if text in ("Z", "UTC"):
        return timezone.utc
    m = re.fullmatch(r"([+-])(\d{2}):?(\d{2})", text)
    if m:
        off = timedelta(hours=int(m[2]), minutes=int(m[3]))
        return timezone(off if m[1] == "+" else -off)
    try:
        return ZoneInfo(text)
    except (ZoneInfoNotFoundError, ValueError):
        raise QueryError(f"bad time_zone {text!r}") from None


# Names of the date formats that bounds may be written in.
_ISO_FORMATS = ("date_optional_time", "strict_date_optional_time", "strict_date_optional_time_nanos",
                "yyyy-MM-dd", "strict_date", "date")
_EPOCH_FORMATS = {"epoch_millis": 1000, "epoch_second": 1}


def _date_bound(value: Any, fmt: str | None) -> Any:
    """A range bound as written -> text or milliseconds, by ``format``."""
    if fmt is None:
        return value
    formats = fmt.split("||") if isinstance(fmt, str) else [fmt]
    for f in formats:
        if f not in _ISO_FORMATS and f not in _EPOCH_FORMATS:
            raise QueryError(f"unsupported date format {f!r}")
    if isinstance(value, str) and (value.startswith("now") or "||" in value):
        return value
    digits = isinstance(value, (int, float)) and not isinstance(value, bool) or (
        isinstance(value, str) and re.fullmatch(r"-?\d+(\.\d+)?", value) is not None)
    for f in formats:
        if f in _EPOCH_FORMATS and digits:
            return float(value) * 1000 / _EPOCH_FORMATS[f]
        if f in _ISO_FORMATS and isinstance(value, str):
            return value
    raise QueryError(f"bound {value!r} isn't in format {fmt!r}")


def _is_date_type(dt: T.DataType | None) -> bool:
    return isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType))


class _NoMatch(Exception):
    """A literal that can never equal a value of the field (e.g. text for a
    number column): the clause matches nothing."""


def _decimal(value: Any) -> Decimal:
    """The number that a literal spells, exactly."""
    try:
        d = Decimal(value if isinstance(value, (int, str)) else repr(value))
    except (InvalidOperation, ValueError, TypeError):
        raise _NoMatch() from None
    if not d.is_finite() or abs(d.adjusted()) > 400:
        raise _NoMatch()
    return d


def _coerce(value: Any, dt: T.DataType) -> Any:
    """A Python literal of the field's type, converted on the driver."""
    if isinstance(value, bool):
        if isinstance(dt, T.BooleanType):
            return value
        if isinstance(dt, T.StringType):
            return "true" if value else "false"
        raise _NoMatch()
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        d = _decimal(value)
        return int(d) if d == d.to_integral_value() else float(d)
    if isinstance(dt, T.DecimalType):
        return _decimal(value)
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return float(_decimal(value))
    if isinstance(dt, T.StringType):
        return value if isinstance(value, str) else str(value)
    if isinstance(dt, T.BooleanType):
        if value in ("true", "false"):
            return value == "true"
        raise _NoMatch()
    return value


# Exact for 64-bit ids and for decimals of ten places.
_VARIANT_INT = "decimal(38,10)"


def _literal(value: Any, r: Resolved, now: datetime, *, round_up: bool = False,
             zone: tzinfo = timezone.utc) -> tuple[Column, Column]:
    """(field column, non-null literal) with the field read at a type the
    literal fits. Literals are converted here, on the driver, so comparisons
    stay plain ``column op constant`` forms that parquet can filter on."""
    col, dt = r.column, r.dtype
    if isinstance(dt, T.VariantType):
        if isinstance(value, bool):
            return F.try_variant_get(col, "$", "boolean"), F.lit(value)
        if isinstance(value, int) and abs(value) < 10**27:
            return F.try_variant_get(col, "$", _VARIANT_INT), F.lit(str(value)).cast(_VARIANT_INT)
        if isinstance(value, (int, float)):
            return F.try_variant_get(col, "$", "double"), F.lit(float(value))
        if isinstance(value, str):
            return F.try_variant_get(col, "$", "string"), F.lit(value)
        raise QueryError(f"unsupported value {value!r}")
    if _is_date_type(dt):
        if isinstance(value, str):
            t = resolve_date_math(value, now, round_up=round_up, zone=zone)
        elif isinstance(value, (int, float)) and not isinstance(value, bool):
            t = datetime(1970, 1, 1) + timedelta(milliseconds=value)
        elif isinstance(value, (datetime, date)):
            t = value
        else:
            raise QueryError(f"unsupported date bound {value!r}")
        return col, F.lit(t.isoformat(sep=" ")).cast(dt)
    if not isinstance(value, (bool, int, float, str)):
        raise QueryError(f"unsupported value {value!r}")
    v = _coerce(value, dt)
    if isinstance(v, int) and not isinstance(v, bool) and not -(1 << 63) <= v < 1 << 63:
        v = Decimal(max(-10**37, min(10**37, v)))  # beyond every value of the field
    return col, F.lit(v)


def _each(r: Resolved, leaf: Callable[[Resolved], Column]) -> Column:
    """``leaf`` on a value, or on the values of a list: any one may match."""
    if r.missing:
        return F.lit(False)
    try:
        if isinstance(r.dtype, T.ArrayType):
            elem = r.dtype.elementType
            leaf(Resolved(F.lit(None), elem))  # a literal that can't match says so here
            return F.coalesce(F.exists(r.column, lambda x: leaf(Resolved(x, elem))), F.lit(False))
        return leaf(r)
    except _NoMatch:
        return F.lit(False)


def _present(col: Column, cond: Column) -> Column:
    """Two-valued leaf: false (never null) when the field is missing or null.

    ``col IS NOT NULL AND cond`` keeps both parts in forms the parquet reader
    can filter on, unlike ``coalesce(cond, false)``."""
    return col.isNotNull() & cond


# Clause options that change scoring or labels, not matching.
_SCORING_KEYS = ("boost", "_name")


def _field_and_body(clause: str, body: Any) -> tuple[str, Any]:
    if not isinstance(body, Mapping):
        raise QueryError(f"{clause} needs exactly one field")
    fields = {k: v for k, v in body.items() if k not in _SCORING_KEYS}
    if len(fields) != 1:
        raise QueryError(f"{clause} needs exactly one field")
    (field, spec), = fields.items()
    return field, spec


def _value_of(spec: Any, key: str = "value") -> Any:
    if isinstance(spec, Mapping):
        if key not in spec:
            raise QueryError(f"missing {key!r} in {spec!r}")
        return spec[key]
    return spec


def compile_query(query: Any, resolve: Resolver, *, now: datetime,
                  id_column: tuple[Column, T.DataType] | None = None) -> Column:
    """Compile a query object to a boolean Column (never null).

    ``id_column`` is the document id column and its type (for ``ids``)."""
    if not isinstance(query, Mapping):
        raise QueryError("query must be an object")
    if len(query) != 1:
        raise QueryError(f"query must hold exactly one clause, got {sorted(query)}")
    (clause, body), = query.items()

    if clause == "__flag":
        # Internal: a boolean column computed for the clause elsewhere (a
        # per-document "any child matches" flag, see ``scan.bind_job``).
        return F.coalesce(F.col(body), F.lit(False))

    if clause == "match_all":
        if body not in ({}, None) and not (isinstance(body, Mapping) and set(body) <= set(_SCORING_KEYS)):
            raise QueryError("match_all takes no arguments")
        return F.lit(True)

    if clause == "bool":
        if not isinstance(body, Mapping):
            raise QueryError("bool must be an object")
        unknown = set(body) - {"must", "filter", "should", "must_not", "minimum_should_match",
                               *_SCORING_KEYS}
        if unknown:
            raise QueryError(f"unknown bool keys {sorted(unknown)}")

        def subs(key: str) -> list[Column]:
            v = body.get(key, [])
            items = v if isinstance(v, list) else [v]
            return [compile_query(q, resolve, now=now, id_column=id_column) for q in items]

        must = subs("must") + subs("filter")
        should = subs("should")
        must_not = subs("must_not")
        msm = body.get("minimum_should_match", 0 if must else 1)
        if isinstance(msm, str):
            if not msm.lstrip("-").isdigit():
                raise QueryError(f"unsupported minimum_should_match {msm!r}")
            msm = int(msm)
        if msm < 0:
            msm = max(len(should) + msm, 0)
        cond = F.lit(True)
        for c in must:
            cond = cond & c
        if should and msm == 1:  # a form that reaches the scan
            some = should[0]
            for c in should[1:]:
                some = some | c
            cond = cond & some
        elif should and msm > 0:
            hits = sum((F.when(c, 1).otherwise(0) for c in should), F.lit(0))
            cond = cond & (hits >= msm)
        for c in must_not:
            cond = cond & ~c
        return cond

    if clause == "range":
        field, spec = _field_and_body("range", body)
        if not isinstance(spec, Mapping):
            raise QueryError("range needs an object of bounds")
        known = {"gte", "gt", "lte", "lt"}
        extra = set(spec) - known - {"format", "time_zone", *_SCORING_KEYS}
        if extra:
            raise QueryError(f"unknown range keys {sorted(extra)}")
        if not set(spec) & known:
            raise QueryError("range needs a bound")
        zone = _zone(spec["time_zone"]) if spec.get("time_zone") is not None else timezone.utc

        def in_range(r: Resolved) -> Column:
            # A value of a list has to lie in the whole range.
            cond, col = None, None
            for key in sorted(set(spec) & known):
                bound = spec[key]
                if _is_date_type(r.dtype):
                    bound = _date_bound(bound, spec.get("format"))
                elif spec.get("format") is not None or spec.get("time_zone") is not None:
                    raise QueryError(f"format and time_zone need a date field, {field!r} is none")
                col, lit = _literal(bound, r, now, round_up=key in ("gt", "lte"), zone=zone)
                cmp = {"gte": col >= lit, "gt": col > lit, "lte": col <= lit, "lt": col < lit}[key]
                cond = cmp if cond is None else (cond & cmp)
            return _present(col, cond)

        return _each(resolve(field), in_range)

    if clause == "term":
        field, spec = _field_and_body("term", body)
        value = _value_of(spec)

        def equal(r: Resolved) -> Column:
            col, lit = _literal(value, r, now)
            return _present(col, col == lit)

        return _each(resolve(field), equal)

    if clause == "terms":
        field, values = _field_and_body("terms", body)
        if not isinstance(values, list):
            raise QueryError("terms needs a list of values")
        if not values:
            return F.lit(False)

        def one_of(r: Resolved) -> Column:
            # Literals that read the field at one type share an IN list.
            groups: dict[str, tuple[Column, list[Column]]] = {}
            for v in values:
                try:
                    col, lit = _literal(v, r, now)
                except _NoMatch:
                    continue
                kind = type(v).__name__ if isinstance(r.dtype, T.VariantType) else ""
                groups.setdefault(kind, (col, []))[1].append(lit)
            if not groups:
                raise _NoMatch()
            cond = None
            for col, lits in groups.values():
                c = _present(col, col.isin(lits))
                cond = c if cond is None else (cond | c)
            return cond

        return _each(resolve(field), one_of)

    if clause == "exists":
        if not isinstance(body, Mapping) or "field" not in body:
            raise QueryError("exists needs a field")

        def there(r: Resolved) -> Column:
            if isinstance(r.dtype, T.VariantType):
                return _present(r.column, ~F.is_variant_null(r.column))
            return r.column.isNotNull()

        return _each(resolve(body["field"]), there)

    if clause == "prefix":
        field, spec = _field_and_body("prefix", body)
        value = _value_of(spec)
        if not isinstance(value, str):
            raise QueryError("prefix needs a string")

        def starts(r: Resolved) -> Column:
            if isinstance(r.dtype, T.VariantType):
                col = F.try_variant_get(r.column, "$", "string")
            elif isinstance(r.dtype, T.StringType):
                col = r.column
            else:
                col = r.column.cast("string")
            return _present(col, col.startswith(value))

        return _each(resolve(field), starts)

    if clause == "ids":
        if not isinstance(body, Mapping) or not isinstance(body.get("values"), list):
            raise QueryError("ids needs a list of values")
        if id_column is None:
            raise QueryError("ids needs documents with an id")
        col, dt = id_column
        lits = []
        for v in body["values"]:
            try:
                lits.append(_coerce(str(v), dt))
            except _NoMatch:
                continue
        if not lits:
            return F.lit(False)
        return _present(col, col.isin(lits))

    raise QueryError(f"unknown query clause {clause!r}")
