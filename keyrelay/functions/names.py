"""Target-name derivation (T3), processing-date partition (T10) and load time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import (DATE_FORMAT, INDEX_SCHEMA_PREFIX, INDEX_TABLE_SUFFIX, MAIN_TABLE_PREFIX,
                      VIEW_RECORD_SUFFIX)


def record_table_name(schema: str, table: str) -> str:
    """Pulled rows land in {schema}_{table}."""
    return f"{schema}_{table}"


def view_record_table_name(schema: str, ajzlx: str) -> str:
    return f"{schema}_{MAIN_TABLE_PREFIX}{ajzlx}{VIEW_RECORD_SUFFIX}"


def tombstone_table(schema_name: Column, ajzlx: Column) -> Column:
    """Deletes land in {schema}_t_{case type}."""
    return F.concat(schema_name, F.lit("_" + MAIN_TABLE_PREFIX), ajzlx)


def view_table(schema_name: Column, ajzlx: Column) -> Column:
    return F.concat(schema_name, F.lit("_" + MAIN_TABLE_PREFIX), ajzlx, F.lit(VIEW_RECORD_SUFFIX))


def index_table(dbid: str, ajzlx: Column) -> Column:
    """index_{dbid}.t_{case type}_index"""
    return F.concat(F.lit(f"{INDEX_SCHEMA_PREFIX}{dbid}.{MAIN_TABLE_PREFIX}"), ajzlx, F.lit(INDEX_TABLE_SUFFIX))


def wall_clock(instant: Column, time_zone: str) -> Column:
    """Wall clock (NTZ) of a zone for a UTC wall clock (NTZ)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(time_zone), instant)


def run_ts_col(run_ts: str) -> Column:
    """The batch time as a wall-clock timestamp."""
    return F.lit(run_ts).cast("timestamp_ntz")


def dt_value(run_ts: str) -> Column:
    """Yyyy-MM-dd of the batch time (one value per batch, never per row)."""
    return F.date_format(run_ts_col(run_ts), DATE_FORMAT)


def update_time_text(run_ts: str) -> Column:
    """Load time as text 'yyyy-MM-dd HH:mm:ss[.ffffff]'."""
    return run_ts_col(run_ts).cast("string")
