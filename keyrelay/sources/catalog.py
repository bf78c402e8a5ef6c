"""Source catalogues (S5, S6) and keyed pulls (S2-S4) over DataFrame-backed sources.

A catalogue answers three questions: which tables exist (``information_schema.tables``),
which columns they have (``information_schema.columns``), and which rows of a table
match a set of keys. ``FrameCatalog`` serves tables that are already DataFrames
(Parquet/ORC/lake tables, or views over them); ``JdbcCatalog`` (sources/jdbc.py)
serves a relational source.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import VIEW_PREFIX, VIEW_SCHEMA
from ..session import local_frame

COLUMNS_SCHEMA = T.StructType([
    T.StructField("table_schema", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("ordinal_position", T.IntegerType()),
])
TABLES_SCHEMA = T.StructType([
    T.StructField("table_schema", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("table_type", T.StringType()),
])

KEY = "_k"  # name of the key column on the key side of a pull


class FrameCatalog:
    """Source tables given as DataFrames keyed by (schema, table).

    ``views`` names the entries that are views (listed in the column catalogue but not
    among the tables, like a database's information_schema for the document views).
    """

    def __init__(self, spark: SparkSession, frames: dict, views: set | None = None):
        self.spark = spark
        self.frames = dict(frames)
        self.views = set(views or ())

    # -- catalogue (metadata: sized by the number of tables, not by the data) --
    def columns(self) -> DataFrame:
        rows = [(s, t, c, i + 1) for (s, t), df in self.frames.items() for i, c in enumerate(df.columns)]
        return local_frame(self.spark, rows, COLUMNS_SCHEMA)

    def tables(self) -> DataFrame:
        rows = [(s, t, "VIEW" if (s, t) in self.views else "BASE TABLE") for (s, t) in self.frames]
        return local_frame(self.spark, rows, TABLES_SCHEMA)

    def known(self) -> tuple[list[str], list[str]]:
        """Schemas of the source, and case types that have a document view: what an event's schema can lead to."""
        return (sorted({s for s, _ in self.frames}),
                sorted(t[len(VIEW_PREFIX):] for s, t in self.frames if s == VIEW_SCHEMA and t.startswith(VIEW_PREFIX)))

    def column_names(self, schema: str, table: str) -> list[str]:
        df = self.frames.get((schema, table))
        return list(df.columns) if df is not None else []

    def frame(self, schema: str, table: str) -> DataFrame:
        return self.frames[(schema, table)]

    # -- keyed pull --
    def pull(self, schema: str, table: str, key_col: str, keys: DataFrame,
             broadcast_keys: bool, columns: list[str] | None = None,
             key_values: list[str] | None = None) -> DataFrame:
        """Rows of the table whose ``key_col`` is in ``keys._k``: the key side's columns and the row as struct ``_row``.

        The row is packed before the join, so its columns may have any names.

        One scan of the table per batch, however many events ask for it. The key
        side is broadcast only when the caller measured it under the limit; otherwise
        both sides shuffle on the key and AQE splits skewed keys. ``key_values`` (a
        counted, bounded list) is also pushed into the scan as an IN filter, so Parquet
        row groups and buckets without those keys are skipped.
        """
        src = self.frame(schema, table)
        if key_values is not None:
            src = src.filter(key_filter(src, key_col, key_values))
        return join_keys(src, key_col, keys, broadcast_keys, columns)


_INTEGERS = {"tinyint": 7, "smallint": 15, "int": 31, "bigint": 63}


def typed_key(text: Column, kind: str) -> Column:
    """A key's text in the key column's own type, so that neither side of a join casts the column; null if no row can match.

    A text equals an integer column's text only if it is that integer's plain decimal form.
    """
    if kind in _INTEGERS:
        number = text.try_cast(kind)
        return F.when(number.cast("string") == text, number)
    return text


def join_keys(src: DataFrame, key_col: str, keys: DataFrame, broadcast_keys: bool, columns: list[str] | None) -> DataFrame:
    kind = dict(src.dtypes)[key_col]
    own = kind in _INTEGERS or kind == "string"
    key = F.col(f"`{key_col}`") if own else F.col(f"`{key_col}`").cast("string")
    row = F.struct(*[F.col(f"`{c}`") for c in (columns if columns is not None else src.columns)])
    packed = src.select(key.alias("_source_key"), row.alias("_row"))
    k = keys.withColumn("_own_key", typed_key(F.col(KEY), kind)).filter(F.col("_own_key").isNotNull())
    k = F.broadcast(k) if broadcast_keys else k
    return packed.join(k, packed["_source_key"] == k["_own_key"], "inner").drop("_source_key", "_own_key")


def key_filter(src: DataFrame, key_col: str, values: list[str]) -> Column:
    """Key IN (values) in the column's own type, so that it reaches the scan.

    A text equals an integer column's text only if it is that integer's plain decimal form; others match no row.
    """
    kind = dict(src.dtypes)[key_col]
    col = F.col(f"`{key_col}`")
    if kind in _INTEGERS:
        top = 1 << _INTEGERS[kind]
        own = [int(v) for v in values if re.fullmatch(r"0|-?[1-9][0-9]{0,18}", v) and -top <= int(v) < top]
        return col.isin(own) if own else F.lit(False)
    return (col if kind == "string" else col.cast("string")).isin(values)
