"""A third of all events on one key: broadcast and shuffle join paths both give the
brute-force per-event record counts, and copies of the hot key stay chunked."""

from collections import Counter

from pyspark.sql import functions as F

from keyrelay.config import FIXTURE_OPTIONS
from keyrelay.plans.batch import plan_batch
from keyrelay.sources import fixtures

SF = "/root/testdata/sf0.001"


def _hot_raw(spark):
    raw = fixtures.raw_events(spark, SF)
    hot = F.regexp_replace("value", '"c_stm":"[0-9]+"', '"c_stm":"2"')
    return raw.withColumn("value", F.when(F.col("seq") % 3 == 0, hot).otherwise(F.col("value")))


def _brute_force(spark, bf):
    ev = [(r.schema_name, r.c_stm) for r in bf.pull_events.select("schema_name", "c_stm").collect()]
    frames = fixtures.source_frames(spark, SF)
    key_of = {("db_customer", "t_customer"): "c_stm", ("db_customer", "t_customer_order"): "c_stm_customer",
              ("db_customer", "t_label"): "c_stm", ("db_supplier", "t_supplier"): "c_stm",
              ("db_supplier", "t_lineitem"): "c_stm_supplier", ("db_fyygx", "v_customer"): "c_stm_customer"}
    out = Counter()
    for (schema, table), key in key_of.items():
        rows = Counter(str(r[0]) for r in frames[(schema, table)].select(key).collect())
        ev_schema = "db_customer" if schema == "db_fyygx" else schema
        name = "db_customer_t_customerws" if table == "v_customer" else f"{schema}_{table}"
        out[name] = sum(rows[k] for s, k in ev if s == ev_schema)
    for r in bf.deletes.select("schema_name", "ajzlx").collect():
        out[f"{r.schema_name}_t_{r.ajzlx}"] += 1
    return {k: v for k, v in out.items() if v}


def test_hot_key_paths_match_brute_force(spark):
    raw = _hot_raw(spark)
    base = plan_batch(raw, fixtures.fixture_catalog(spark, SF), FIXTURE_OPTIONS)
    hot_share = base.pull_events.filter("c_stm = '2'").count() / base.pull_events.count()
    assert hot_share > 0.3
    want = _brute_force(spark, base)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for limit in (1_000_000, 0):
            bf = plan_batch(raw, fixtures.fixture_catalog(spark, SF), FIXTURE_OPTIONS.with_(broadcast_key_limit=limit))
            got = {r.tableName: r.n for r in bf.records(expand=False).groupBy("tableName")
                   .agg(F.sum("_cnt").alias("n")).collect()}
            assert got == want, limit
            expanded = {r.tableName: r["count"] for r in bf.records().groupBy("tableName").count().collect()}
            assert expanded == want, limit
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
