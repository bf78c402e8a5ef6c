"""Source tables registered in Spark's own catalogue (S5, S6): databases are the source's schemas.

``refresh`` reads the catalogue anew for the schemas of a batch, so tables, views and columns that come, change or go between
batches are seen. Tables bucketed by their key column (``bucketed``) are pulled without a shuffle of their rows, and a few keys read
only their buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import VIEW_PREFIX, VIEW_SCHEMA
from .catalog import FrameCatalog


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


class SessionCatalog(FrameCatalog):
    """``prefix``: of the database names; schema ``s`` is the database ``{prefix}s``."""

    def __init__(self, spark: SparkSession, prefix: str = ""):
        super().__init__(spark, {})
        self.prefix = prefix
        self.refresh()

    def _schemas(self) -> list[str]:
        names = [d.name for d in self.spark.catalog.listDatabases(self.prefix.replace("*", "") + "*")]
        return sorted(n[len(self.prefix):] for n in names if n.startswith(self.prefix))

    def _tables(self, schema: str) -> list:
        return [t for t in self.spark.catalog.listTables(self.prefix + schema) if not t.isTemporary]

    def refresh(self, schemas: list[str] | None = None) -> None:
        """Read tables and columns of these schemas (all, if none are named) and of the document views."""
        have = set(self._schemas())
        wanted = have if schemas is None else have & {*schemas, VIEW_SCHEMA}
        self.frames, self.views = {}, set()
        for s in sorted(wanted):
            for t in self._tables(s):
                name = f"{_quote(self.prefix + s)}.{_quote(t.name)}"
                self.spark.catalog.refreshTable(name)
                self.frames[(s, t.name)] = self.spark.table(name)
                if t.tableType == "VIEW":
                    self.views.add((s, t.name))

    def known(self) -> tuple[list[str], list[str]]:
        schemas = self._schemas()
        views = [t.name for t in self._tables(VIEW_SCHEMA)] if VIEW_SCHEMA in schemas else []
        return schemas, sorted(v[len(VIEW_PREFIX):] for v in views if v.startswith(VIEW_PREFIX))


def bucketed(frame: DataFrame, name: str, key_col: str, buckets: int, path: str) -> None:
    """Write a source table bucketed and sorted by its key column, so that pulls by key join it where it lies (``path``)."""
    # rows are brought together by bucket first: one file per bucket, not one per task and bucket
    (frame.repartition(buckets, frame[key_col]).write.mode("overwrite").bucketBy(buckets, key_col).sortBy(key_col)
     .format("parquet").option("path", path).saveAsTable(name))
