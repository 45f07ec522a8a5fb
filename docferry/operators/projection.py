"""Ordered projection of documents to flat rows (one ``select``, no UDF).

``columns`` fixes order and header; ``column_paths`` maps a column to a path,
and a column without an entry uses its own name *as a path* (so a column
called ``a.b`` walks ``a`` then ``b``). An empty configured path is a job
error, raised when the plan is built — also for jobs that match no rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docferry.functions.paths import PathError
from docferry.functions.render import cell_text, csv_line, formula_guard
from docferry.sources.documents import Bound, DocumentView


class ProjectionError(ValueError):
    def __init__(self, message: str, *, job_id: str | None = None) -> None:
        super().__init__(message if job_id is None else f"job {job_id}: {message}")
        self.job_id = job_id


def column_path_list(columns: list[str], column_paths: Mapping[str, str] | None,
                     *, job_id: str | None = None) -> list[str]:
    """The path of each output column (default: the column's own name)."""
    if not columns:
        raise ProjectionError("columns must not be empty", job_id=job_id)
    paths = dict(column_paths or {})
    out = []
    for c in columns:
        p = paths.get(c, c)
        if p == "" or p is None:
            raise ProjectionError(f"empty path for column {c!r}", job_id=job_id)
        out.append(p)
    return out


def bind(source: DocumentView | DataFrame, paths: list[str], *,
         id_column: str | None = None) -> Bound:
    view = source if isinstance(source, DocumentView) else DocumentView.of(source, id_column)
    return view.bind(paths)


def text_cells(bound: Bound, columns: list[str], paths: list[str], *,
               guard_formulas: bool = False, job_id: str | None = None) -> list[Column]:
    """One non-null text column per output column, named after it.

    With ``guard_formulas`` a *text-typed* value that starts with ``= + - @``
    gets a leading ``'``; numbers are never touched (``-5`` stays ``-5``).
    """
    cells = []
    for c, p in zip(columns, paths):
        try:
            r = bound.resolve(p)
        except PathError as e:
            raise ProjectionError(f"column {c!r}: {e}", job_id=job_id) from e
        text = cell_text(r.column, r.dtype)
        if guard_formulas and r.dtype is not None and r.dtype.typeName() in ("string", "variant"):
            text = formula_guard(text)
        cells.append(text.alias(c))
    return cells


def project(source: DocumentView | DataFrame, columns: list[str],
            column_paths: Mapping[str, str] | None = None, *, id_column: str | None = None,
            keep: list[str] | None = None, guard_formulas: bool = False,
            job_id: str | None = None, query: Any = None,
            now: datetime | None = None) -> DataFrame:
    """Documents -> flat rows of text cells in ``columns`` order.

    ``keep`` names document paths carried along untouched (e.g. the id for
    ordering or bucketing); they come first, under ``__keep_<i>`` names.
    With ``query`` only matching documents are projected (scan, filter and
    projection share one bound frame, so the filter reaches the scan).
    """
    paths = column_path_list(columns, column_paths, job_id=job_id)
    keep = keep or []
    if query is not None:
        from docferry.operators.scan import bind_job

        if now is None:
            raise ValueError("a query needs the job-run clock `now`")
        bound, pred = bind_job(source, query, paths + keep, now=now, id_column=id_column)
        bound.frame = bound.frame.where(pred)
    else:
        bound = bind(source, paths + keep, id_column=id_column)
    kept = []
    for i, k in enumerate(keep):
        r = bound.resolve(k)
        kept.append((r.column if r.column is not None else F.lit(None)).alias(f"__keep_{i}"))
    cells = text_cells(bound, columns, paths, guard_formulas=guard_formulas, job_id=job_id)
    return bound.frame.select(*kept, *cells)


def with_line(rows: DataFrame, columns: list[str], name: str = "line") -> DataFrame:
    """Add the CSV record of the projected ``columns``."""
    return rows.withColumn(name, csv_line([F.col(f"`{c}`") for c in columns]))
