"""Error rows.

Deterministic failures become rows of the error table, one per (event, table):
* the key column the job would query does not exist in the table (Q15) - found by
  checking the catalogue before any pull, so no query is sent at all;
* the table name has no second '_' token (F5): its matching rows are never
  emitted, and each event that matched rows gets an error row.
Transient failures (connection, timeouts) are not turned into rows: they fail the
batch, which is retried (Q12).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ERROR_JOB_MODE
from ..functions.names import dt_value, run_ts_col
from ..sources.catalog import KEY
from .catalog_ops import TablePlan

ERROR_SCHEMA = T.StructType([
    T.StructField("dbId", T.StringType()),
    T.StructField("tableName", T.StringType()),
    T.StructField("c_stm", T.StringType()),
    T.StructField("log_message", T.StringType()),
    T.StructField("job_mode", T.StringType()),
    T.StructField("c_dt", T.StringType()),
    T.StructField("create_time", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
])

MSG_MISSING_KEY = "source query failed: column {key} does not exist in {schema}.{table}"
MSG_UNROUTABLE = "record conversion failed: table name {table} has no case-type token"


def _rows(events: DataFrame, plan: TablePlan, message: str, dbid: str, run_ts: str) -> DataFrame:
    return events.select(
        F.lit(str(dbid)).alias("dbId"),
        F.lit(f"{plan.source_schema}.{plan.table}").alias("tableName"),
        F.col("c_stm"),
        F.lit(message).alias("log_message"),
        F.lit(ERROR_JOB_MODE).alias("job_mode"),
        dt_value(run_ts).alias("c_dt"),
        run_ts_col(run_ts).alias("create_time"),
        F.col("seq"),
    )


def missing_key_errors(pull_events: DataFrame, plan: TablePlan, dbid: str, run_ts: str) -> DataFrame:
    ev = pull_events.filter(F.col("schema_name") == plan.event_schema)
    msg = MSG_MISSING_KEY.format(key=plan.key_column, schema=plan.source_schema, table=plan.table)
    return _rows(ev, plan, msg, dbid, run_ts)


def unroutable_errors(pull_events: DataFrame, plan: TablePlan, matched: DataFrame, dbid: str,
                      run_ts: str) -> DataFrame:
    """``matched`` = distinct event keys (``_k``) with rows in the table."""
    ev = pull_events.filter((F.col("schema_name") == plan.event_schema) & F.col("c_stm").isNotNull())
    hit = ev.join(matched.withColumnRenamed(KEY, "c_stm"), "c_stm", "left_semi")
    return _rows(hit, plan, MSG_UNROUTABLE.format(table=plan.table), dbid, run_ts)


def empty_errors(spark) -> DataFrame:
    return spark.createDataFrame([], ERROR_SCHEMA)
