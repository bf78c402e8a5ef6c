"""Catalogue operators: table listing (S5 F3), key shape (S6 A1 T4 J5), family test (F4), fan-out.

All of these run on the source catalogue, whose size is the number of tables and
columns, not the number of rows. The per-table plan is collected to the driver
(``table_plans``) because it decides the shape of the Spark plan: one pull per table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import KEY_COLUMN, KEY_LIKE, MAIN_TABLE_PREFIX, TABLE_LIKE, VIEW_PREFIX, VIEW_SCHEMA
from ..functions.decode import case_type
from ..functions.names import record_table_name, view_record_table_name
from ..session import local_frame


def maybe_broadcast(df: DataFrame, rows: int | None, limit: int) -> DataFrame:
    """Broadcast ``df`` only when its measured row count is within ``limit``."""
    return F.broadcast(df) if rows is not None and rows <= limit else df


def listed_tables(tables: DataFrame) -> DataFrame:
    """Tables named LIKE 't_%' ('_' is a wildcard, so 'tab' matches too)."""
    return (tables.filter(F.col("table_name").like(TABLE_LIKE))
            .select("table_schema", "table_name").distinct())


def single_key_tables(columns: DataFrame) -> DataFrame:
    """A1: tables with exactly one column LIKE 'c_stm%'."""
    return (columns.filter(F.col("column_name").like(KEY_LIKE))
            .groupBy("table_schema", "table_name").agg(F.count(F.lit(1)).alias("n_key_cols"))
            .filter(F.col("n_key_cols") == 1)
            .select("table_schema", "table_name"))


def key_shape(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """T4/J5/F4/Q15 per listed table.

    Columns: table_schema, table_name, ajzlx, single_key, key_column, key_present,
    routable (table name has a second '_' token), main_family (that token = case type).
    """
    sk = single_key_tables(columns).withColumn("single_key", F.lit(True))
    t = (listed_tables(tables).join(sk, ["table_schema", "table_name"], "left")
         .withColumn("single_key", F.coalesce("single_key", F.lit(False)))
         .withColumn("ajzlx", case_type(F.col("table_schema"))))
    t = t.withColumn("key_column", F.when(F.col("single_key"), F.lit(KEY_COLUMN))
                     .otherwise(F.concat(F.lit(KEY_COLUMN + "_"), F.col("ajzlx"))))
    present = columns.select("table_schema", "table_name", F.col("column_name").alias("key_column"),
                             F.lit(True).alias("key_present")).distinct()
    t = (t.join(present, ["table_schema", "table_name", "key_column"], "left")
         .withColumn("key_present", F.coalesce("key_present", F.lit(False))))
    token = F.split_part(F.col("table_name"), F.lit("_"), F.lit(2))
    return t.select("table_schema", "table_name", "ajzlx", "single_key", "key_column", "key_present",
                    (token != "").alias("routable"), (token == F.col("ajzlx")).alias("main_family"))


def view_shape(columns: DataFrame, schemas: DataFrame) -> DataFrame:
    """The document view of each event schema, if the catalogue has it.

    ``schemas`` has one column ``schema_name``. Output: schema_name, ajzlx, view_name,
    key_column, key_present.
    """
    s = schemas.select("schema_name", case_type(F.col("schema_name")).alias("ajzlx")).filter("ajzlx IS NOT NULL")
    s = s.withColumn("view_name", F.concat(F.lit(VIEW_PREFIX), "ajzlx")) \
         .withColumn("key_column", F.concat(F.lit(KEY_COLUMN + "_"), "ajzlx"))
    vcols = columns.filter(F.col("table_schema") == VIEW_SCHEMA)
    exists = vcols.select(F.col("table_name").alias("view_name")).distinct()
    present = vcols.select(F.col("table_name").alias("view_name"), F.col("column_name").alias("key_column"),
                           F.lit(True).alias("key_present")).distinct()
    return (s.join(exists, "view_name", "left_semi")
            .join(present, ["view_name", "key_column"], "left")
            .withColumn("key_present", F.coalesce("key_present", F.lit(False))))


@dataclass(frozen=True)
class TablePlan:
    """Driver-side description of one pull: which events, which source, which key."""

    event_schema: str          # events with this schemaName use it
    source_schema: str
    table: str
    ajzlx: str
    kind: str                  # "table" or "view"
    key_column: str
    key_present: bool
    routable: bool
    main_family: bool
    record_table: str


def table_plans(tables: DataFrame, columns: DataFrame, schema_names: list[str]) -> list[TablePlan]:
    """Collect the (small) per-table plan for the schemas seen in a batch, tables and views in one job."""
    spark = tables.sparkSession
    schemas = local_frame(spark, [(s,) for s in schema_names],
                          T.StructType([T.StructField("schema_name", T.StringType())]))
    shape = key_shape(tables, columns).join(
        schemas.withColumnRenamed("schema_name", "table_schema"), "table_schema", "left_semi")
    t = shape.select(F.lit("table").alias("kind"), F.col("table_schema").alias("event_schema"),
                     F.col("table_schema").alias("source_schema"), "table_name", "ajzlx", "key_column",
                     "key_present", "routable", "main_family")
    v = view_shape(columns, schemas).select(
        F.lit("view").alias("kind"), F.col("schema_name").alias("event_schema"),
        F.lit(VIEW_SCHEMA).alias("source_schema"), F.col("view_name").alias("table_name"), "ajzlx", "key_column",
        "key_present", F.lit(True).alias("routable"), F.lit(False).alias("main_family"))
    plans = []
    for r in t.unionByName(v).collect():
        name = (record_table_name(r.source_schema, r.table_name) if r.kind == "table"
                else view_record_table_name(r.event_schema, r.ajzlx))
        plans.append(TablePlan(r.event_schema, r.source_schema, r.table_name, r.ajzlx or "", r.kind, r.key_column,
                               bool(r.key_present), bool(r.routable), bool(r.main_family), name))
    return sorted(plans, key=lambda p: (p.kind != "table", p.event_schema, p.source_schema, p.table))


def fanout(pull_events: DataFrame, tables: DataFrame, catalog_rows: int | None, limit: int) -> DataFrame:
    """Each pull-path event meets every listed table of its schema.

    Returned aggregated per table (events and distinct keys), which is what the pull stage consumes: events and keys are
    counted per schema first, and only the counts meet the tables.
    """
    t = maybe_broadcast(listed_tables(tables), catalog_rows, limit)
    counts = pull_events.groupBy(F.col("schema_name").alias("table_schema")).agg(
        F.count(F.lit(1)).alias("n_events"), F.countDistinct("c_stm").alias("n_keys"))
    return counts.join(t, "table_schema").select("table_schema", "table_name", "n_events", "n_keys")


def main_table(ajzlx: str) -> str:
    return f"{MAIN_TABLE_PREFIX}{ajzlx}"
