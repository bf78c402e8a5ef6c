"""Mapping of the provided test tables onto the sync job's inputs (see FIXTURES.md).

* ``cdc``        - typed change events derived from ``events``
* ``raw_events`` - the same events as JSON text with deliberate defects, plus ``seq``
                   and ``apply_ts`` (the analogue of the Kafka record timestamp)
* ``source_frames`` - the source database: eight logical tables/views over the test tables
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import FrameCatalog
from .session_catalog import bucketed

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed change events (FIXTURES B1)."""
    ev = load_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("seq"),
        F.col("user_id").cast("string").alias("c_stm"),
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("d_xgsj"),
        F.when(F.col("event_type") == "signup", 1).when(F.col("event_type") == "error", 0)
         .otherwise(2).alias("data_state"),
        F.when(F.col("event_id") % 11 != 0, F.concat(F.lit("BA"), F.col("event_id").cast("string")))
         .alias("c_baah"),
        F.when(F.col("event_id") % 7 != 0, F.floor("value").cast("int")).alias("n_jbfy"),
        F.when(F.col("user_id") % 2 == 0, F.lit("db_customer")).otherwise(F.lit("db_supplier"))
         .alias("schema_name"),
        F.col("ts").alias("apply_ts"),
    )


# FIXTURES B2: the events as JSON text; remainders mod 97 inject defects. 7 and 8: valid events that the variant parser
# rejects (a repeated key beside an unknown one; single quotes).
RAW_VALUE_SQL = """
CASE WHEN seq % 97 = 0 THEN 'oops' WHEN seq % 97 = 8 THEN replace(plain, '"', '''') ELSE plain END
"""
PLAIN_VALUE_SQL = """
  CASE WHEN seq % 97 = 7 THEN '{"c_stm":"first","extra":{"a":[1,2]},"c_stm":"' ELSE '{"c_stm":"' END || c_stm || '"'
    || CASE WHEN seq % 97 = 3 THEN ',"d_xgsj":"not a time"'
            WHEN seq % 13 = 0 THEN ',"d_xgsj":""'
            ELSE ',"d_xgsj":"' || CAST(d_xgsj AS STRING) || '"' END
    || CASE WHEN seq % 97 = 1 THEN ''
            WHEN seq % 97 = 4 THEN ',"data_state":"x"'
            WHEN seq % 5 = 0 THEN ',"data_state":"' || CAST(data_state AS STRING) || '"'
            ELSE ',"data_state":' || CAST(data_state AS STRING) END
    || coalesce(',"c_baah":"' || c_baah || '"', '')
    || CASE WHEN seq % 97 = 5 THEN ',"n_jbfy":"many"'
            WHEN seq % 7 = 0 AND seq % 2 = 0 THEN ',"n_jbfy":null'
            ELSE coalesce(',"n_jbfy":' || CAST(n_jbfy AS STRING), '') END
    || ',"schemaName":"' || CASE WHEN seq % 97 = 2 THEN 'nounderscore' ELSE schema_name END || '"}'
    || CASE WHEN seq % 97 = 6 THEN ' tail' ELSE '' END
"""


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(seq BIGINT, value STRING, apply_ts TIMESTAMP_NTZ)`` - what the event source delivers."""
    plain = cdc(spark, sf_dir).selectExpr("seq", f"{PLAIN_VALUE_SQL} AS plain", "apply_ts")
    return plain.selectExpr("seq", f"{RAW_VALUE_SQL} AS value", "apply_ts")


def source_frames(spark: SparkSession, sf_dir: str) -> dict:
    """FIXTURES B3: the logical source tables, keyed by (schema, table)."""
    t = lambda n: load_table(spark, sf_dir, n)
    c = F.col
    # columns keep their own types: records cast them to text, and key lists reach the scan as numbers
    return {
        ("db_customer", "t_customer"): t("customer").select(
            c("c_custkey").alias("c_stm"), "c_name", c("c_nationkey").alias("n_nation"), "c_mktsegment"),
        ("db_customer", "t_customer_order"): t("orders").select(
            c("o_orderkey").alias("c_stm"), c("o_custkey").alias("c_stm_customer"),
            "o_orderstatus", "o_orderpriority"),
        ("db_customer", "t_label"): t("labels").select(
            c("doc_id").alias("c_stm"), c("quality").alias("n_quality"), c("toxic").alias("data_state")),
        ("db_customer", "t_note"): t("region").select("r_name"),
        ("db_customer", "tab"): t("nation").select(c("n_nationkey").alias("c_stm"), "n_name"),
        ("db_supplier", "t_supplier"): t("supplier").select(
            c("s_suppkey").alias("c_stm"), "s_name", c("s_nationkey").alias("n_nation")),
        ("db_supplier", "t_lineitem"): t("lineitem").select(
            F.concat(c("l_orderkey").cast("string"), F.lit("-"), c("l_linenumber").cast("string")).alias("c_stm"),
            c("l_suppkey").alias("c_stm_supplier"), "l_returnflag", "l_linestatus"),
        ("db_fyygx", "v_customer"): t("documents").select(
            c("doc_id").alias("c_stm_customer"), "lang", "source", "n_chars"),
    }


def fixture_catalog(spark: SparkSession, sf_dir: str) -> FrameCatalog:
    return FrameCatalog(spark, source_frames(spark, sf_dir), views={("db_fyygx", "v_customer")})


def xzys_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of the shard-alias schema (db_xzys.t_xzys) over ``customer``, for the T8 rule."""
    c = load_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("c_stm"),
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("n_jbfymc"),
        F.col("c_name"),
    )


def _integer_types(low: int | None, high: int | None) -> tuple[str, str]:
    """Types of a small and a plain integer column, or the next wider ones where their values need them."""
    kinds = [("smallint", 15), ("int", 31), ("bigint", 63)]
    fits = [k for k, bits in kinds if low is None or (-(1 << bits) <= low and high < 1 << bits)]
    return fits[0], next(k for k in fits if k != "smallint")


def typed_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with a column of every type a source row may hold, over ``events`` (FIXTURES B6)."""
    events = load_table(spark, sf_dir, "events")
    n, v = F.col("event_id"), F.col("value")
    small, plain = _integer_types(*events.agg(F.min(n), F.max(n)).first())
    odd = F.when(n % 5 == 0, F.lit("NULL")).when(n % 5 == 1, F.lit('a "b"\\c')).when(n % 5 == 2, F.lit("")).when(n % 5 == 3, F.lit("x y"))
    scale = F.element_at(F.array(*[F.lit(x) for x in (1.0, 1e-7, 1e12, 1e20, -1e-3)]), (n % 5).cast("int") + 1)
    whole = F.when(n % 7 == 0, F.lit(0.0)).when(n % 7 == 1, F.lit(float("nan"))).when(n % 7 == 2, F.lit(float("-inf"))).otherwise(
        n.cast("double"))
    return events.select(
        n.cast("string").alias("c_stm"), (n % 3 == 0).alias("b"), n.cast(small).alias("i2"), n.cast(plain).alias("i4"),
        v.cast("decimal(20,4)").alias("num"), (F.round(v, 2) * scale).alias("f8"), whole.alias("f8_whole"),
        (n % 1000 / 8).cast("float").alias("f4"), F.to_date("ts").alias("d"), F.col("ts").cast("timestamp_ntz").alias("t"),
        F.col("user_id").cast("string").cast("binary").alias("raw"),
        F.array(n, F.when(n % 2 == 0, n), F.lit(-1)).alias("ints"), F.array(F.col("event_type"), odd).alias("texts"),
        F.array((n % 2 == 0), F.lit(None).cast("boolean")).alias("flags"),
        F.struct(n.alias("x"), F.when(n % 4 != 0, odd).alias("y"), (n % 2 == 0).alias("z")).alias("pair"),
        F.when(n % 6 != 0, F.lit("text")).alias("s"))


def register_sources(spark: SparkSession, sf_dir: str, prefix: str, location: str, buckets: int = 16) -> list[str]:
    """The source database as databases ``{prefix}{schema}`` of Spark's catalogue; returns their names.

    The two child tables are bucketed by their key columns, the other tables are views over the Parquet files.
    """
    names, spec = [], {"t_customer_order": "c_stm_customer", "t_lineitem": "c_stm_supplier"}
    for (schema, table), frame in source_frames(spark, sf_dir).items():
        db = f"{prefix}{schema}"
        if db not in names:
            names.append(db)
            spark.sql(f"CREATE DATABASE `{db}` LOCATION '{location}/{db}'")
        if table in spec:
            bucketed(frame, f"`{db}`.`{table}`", spec[table], buckets, f"{location}/files/{db}/{table}")
            continue
        spark.sql(f"CREATE VIEW `{db}`.`{table}` AS {VIEWS[table].format(sf_dir=sf_dir.rstrip('/'))}")
    return names


#: The source tables that are registered as views, as SQL (the same columns as in ``source_frames``).
VIEWS = {
    "t_customer": "SELECT c_custkey AS c_stm, c_name, c_nationkey AS n_nation, c_mktsegment FROM parquet.`{sf_dir}/customer.parquet`",
    "t_label": "SELECT doc_id AS c_stm, quality AS n_quality, toxic AS data_state FROM parquet.`{sf_dir}/labels.parquet`",
    "t_note": "SELECT r_name FROM parquet.`{sf_dir}/region.parquet`",
    "tab": "SELECT n_nationkey AS c_stm, n_name FROM parquet.`{sf_dir}/nation.parquet`",
    "t_supplier": "SELECT s_suppkey AS c_stm, s_name, s_nationkey AS n_nation FROM parquet.`{sf_dir}/supplier.parquet`",
    "v_customer": "SELECT doc_id AS c_stm_customer, lang, source, n_chars FROM parquet.`{sf_dir}/documents.parquet`",
}


def clashing_catalog(spark: SparkSession, sf_dir: str) -> FrameCatalog:
    """A source table whose columns are named like the job's own helpers."""
    c = load_table(spark, sf_dir, "customer")
    key, seg = F.col("c_custkey"), F.col("c_mktsegment")
    t = c.select(key.alias("c_stm"), F.col("c_name").alias("seq"), seg.alias("_k"), F.col("c_nationkey").alias("_cnt"),
                 F.concat(F.lit("r"), seg).alias("_row"), F.concat(F.lit("v"), seg).alias("value"), key.alias("_c"))
    return FrameCatalog(spark, {("db_customer", "t_customer"): t})


def shared_name_catalog(spark: SparkSession, sf_dir: str) -> FrameCatalog:
    """A document view and a table whose rows land in the same record table (db_customer_t_customerws)."""
    frames = source_frames(spark, sf_dir)
    keep = {("db_customer", "t_customer"), ("db_fyygx", "v_customer")}
    c = load_table(spark, sf_dir, "customer")
    both = {k: v for k, v in frames.items() if k in keep}
    both[("db_customer", "t_customerws")] = c.select(F.col("c_custkey").alias("c_stm"), F.col("c_name"))
    return FrameCatalog(spark, both, views={("db_fyygx", "v_customer")})
