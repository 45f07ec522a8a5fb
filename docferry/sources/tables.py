"""Named tables: the document "indexes" a job can read.

A job names its source by ``data_index``; a ``Catalog`` maps that name to a
DataFrame (or a ``DocumentView``). Every read is a plain parquet scan, so
filters and column pruning reach the files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# The driver-generated test tables.
TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one table over its current files."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Catalog:
    """Name -> source. Entries are built lazily, each call gives a fresh plan
    over the current file listing (a re-extract sees new files)."""

    def __init__(self) -> None:
        self._sources: dict[str, Callable[[], object]] = {}

    def register(self, name: str, factory: Callable[[], object]) -> None:
        self._sources[name] = factory

    def names(self) -> list[str]:
        return sorted(self._sources)

    def get(self, name: str):
        try:
            factory = self._sources[name]
        except KeyError:
            raise KeyError(f"unknown data_index {name!r}") from None
        return factory()

    def verify(self, name: str) -> None:
        """Raise where the source that ``get`` returned last has changed since.
        Plain listings can't tell (``snapshots.SnapshotCatalog`` can)."""


def driver_catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """The driver tables plus the document views derived from them."""
    from docferry.sources import documents

    cat = Catalog()
    for name in TABLE_NAMES:
        cat.register(name, lambda n=name: read_table(spark, sf_dir, n))
    cat.register("order_docs", lambda: documents.order_documents(spark, sf_dir))
    cat.register("event_docs", lambda: documents.event_documents(spark, sf_dir))
    cat.register("conversation_docs",
                 lambda: documents.conversation_documents(spark, sf_dir))
    return cat


def folder_catalog(spark: SparkSession, root: str, *, ids: dict[str, str] | None = None) -> Catalog:
    """Every ``<name>.parquet`` file or ``<name>/`` parquet folder under
    ``root`` as a document table named ``<name>``. A name that isn't known yet
    is looked for in the folder again. ``ids`` names the id column of a table,
    which serves as its documents' ``_id``."""
    from docferry.sources import fs
    from docferry.sources.documents import DocumentView

    ids = ids or {}

    def found() -> dict[str, str]:
        fsys, p = fs._fs(spark, root)
        out = {}
        for st in fsys.listStatus(p):
            name = st.getPath().getName()
            if not name.startswith((".", "_")):
                out[name.removesuffix(".parquet")] = st.getPath().toString()
        return out

    class Folder(Catalog):
        def names(self) -> list[str]:
            return sorted(found())

        def get(self, name: str):
            path = found().get(name)
            if path is None:
                raise KeyError(f"unknown data_index {name!r}")
            df = spark.read.parquet(path)
            return DocumentView.of(df, ids[name]) if name in ids else df

    return Folder()
