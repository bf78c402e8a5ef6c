"""Record and tombstone construction (T5-T9, T14, quirks Q1 Q2 Q24)."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyrelay.config import ALIAS_RULES
from keyrelay.functions.records import record_fields, record_value, tombstone_value
from keyrelay.functions.sqltext import row_texts, text_of

RUN_TS = "2024-02-01 00:00:00"


def _records(spark, rows, schema, dbid="00", s="db_x", t="t_x", how="database"):
    df = spark.createDataFrame(rows, schema).select(F.struct("*").alias("_row"))
    columns = df.schema["_row"].dataType.names
    fields = record_fields(columns, s, t, f"{s}_{t}", dbid, RUN_TS, row_texts(df, how), ALIAS_RULES)
    return [json.loads(r[0]) for r in df.select(record_value(fields)).collect()]


def test_metadata_wins_and_nulls_are_omitted(spark):
    out = _records(spark, [("k1", "5", None, "src-dt", "src-table", 7)],
                   "c_stm string, n_a string, n_b string, dt string, tableName string, data_state int")
    assert out == [{"c_stm": "k1", "n_a": "5", "tableName": "db_x_t_x", "dt": "2024-02-01",
                    "update_time": "2024-02-01 00:00:00", "dbid": "00", "data_state": 1}]


def test_all_columns_are_text(spark):
    row, schema = [("k", 3, 2.5, True)], "c_stm string, n int, x double, b boolean"
    out = _records(spark, row, schema)
    assert (out[0]["n"], out[0]["x"], out[0]["b"]) == ("3", "2.5", "t")
    out = _records(spark, row, schema, how="spark")
    assert (out[0]["n"], out[0]["x"], out[0]["b"]) == ("3", "2.5", "true")


def test_numbers_as_the_source_prints_them(spark):
    want = {0.0: "0", -0.0: "-0", 100.0: "100", -1.5: "-1.5", 1e14: "100000000000000", 1e15: "1e+15", 1.5e10: "15000000000",
            1e-4: "0.0001", 1.25e-5: "1.25e-05", 1 / 3: "0.3333333333333333", 1e300: "1e+300", 5e-324: "5e-324",
            6.526e21: "6.526e+21", 12345678.9: "12345678.9", float("inf"): "Infinity", float("-inf"): "-Infinity"}
    df = spark.createDataFrame([(v,) for v in want], "d double")
    for r in df.select("d", text_of(F.col("d"), T.DoubleType()).alias("t")).collect():
        assert r.t == want[r.d] or (r.d == 0 and r.t in ("0", "-0")), r
    single = {1e6: "1e+06", 123456.0: "123456", 1234567.0: "1.234567e+06", 1.5e10: "1.5e+10", 0.1: "0.1", 1e-5: "1e-05"}
    df = spark.createDataFrame([(v, v) for v in single], "d double, f float")
    assert {r.d: r.t for r in df.select("d", text_of(F.col("f"), T.FloatType()).alias("t")).collect()} == single
    assert spark.range(1).select(text_of(F.lit(float("nan")), T.DoubleType())).first()[0] == "NaN"


def test_nested_and_timed_values_as_the_source_prints_them(spark):
    df = spark.sql("""SELECT timestamp'2024-01-02 03:04:05.5' AS t, timestamp_ntz'2024-01-02 03:04:05.120' AS n, array(array(1, 2), array(3)) AS aa,
        array('a,b', '', 'null', 'x"y') AS s, cast(null AS array<int>) AS z, X'00ff' AS b, date'2024-02-01' AS d,
        named_struct('x', array('q r', 's'), 'y', cast(null AS int)) AS st, 1.50BD AS num""")
    got = {f.name: df.select(text_of(F.col(f.name), f.dataType, "Asia/Kolkata")).first()[0] for f in df.schema}
    assert got == {"t": "2024-01-02 08:34:05.5+05:30", "n": "2024-01-02 03:04:05.12", "aa": "{{1,2},{3}}",
                   "s": '{"a,b","","null","x\\"y"}', "z": None, "b": "\\x00ff", "d": "2024-02-01", "st": '("{""q r"",s}",)', "num": "1.50"}


def test_alias_rule_by_shard(spark):
    rows, schema = [("k", "v1"), ("j", None)], "c_stm string, n_jbfymc string"
    for dbid, expect in (("6", True), ("22", True), ("0", False)):
        out = _records(spark, rows, schema, dbid=dbid, s="db_xzys", t="t_xzys")
        assert ("c_jbfymc" in out[0]) is expect
        if expect:
            assert out[0]["c_jbfymc"] == "v1"
        assert "c_jbfymc" not in out[1]
    other = _records(spark, rows, schema, dbid="6", s="db_xzys", t="t_other")
    assert "c_jbfymc" not in other[0]


def test_alias_rule_against_real_column(spark):
    # real column after the source column: the real value is put last and wins
    after = _records(spark, [("k", "alias", "real")], "c_stm string, n_jbfymc string, c_jbfymc string",
                     dbid="6", s="db_xzys", t="t_xzys")
    assert after[0]["c_jbfymc"] == "real"
    # real column before: the alias is put last and wins when non-null
    before = _records(spark, [("k", "real", "alias"), ("j", "real", None)],
                      "c_stm string, c_jbfymc string, n_jbfymc string", dbid="6", s="db_xzys", t="t_xzys")
    assert before[0]["c_jbfymc"] == "alias" and before[1]["c_jbfymc"] == "real"


def test_tombstone_keeps_event_fields_and_types(spark):
    ev = spark.createDataFrame([(
        '{"c_stm":"k","data_state":"0","n_jbfy":null,"extra":{"a":[1,2]},"f":1.5,"dt":"x","schemaName":"db_x"}',)],
        "value string")
    out = json.loads(ev.select(tombstone_value(F.col("value"), F.lit("db_x_t_x"), RUN_TS, "00")).first()[0])
    assert out == {"c_stm": "k", "extra": {"a": [1, 2]}, "f": 1.5, "schemaName": "db_x",
                   "tableName": "db_x_t_x", "dt": "2024-02-01", "update_time": "2024-02-01 00:00:00",
                   "dbid": "00", "data_state": 0}


def test_tombstone_of_event_with_repeated_key(spark):
    from keyrelay.config import SyncOptions
    from keyrelay.plans.batch import plan_batch
    from keyrelay.sources.catalog import FrameCatalog
    raw = spark.createDataFrame([(1, '{"c_stm":"1","c_stm":"2","data_state":0,"n_jbfy":5,"schemaName":"db_a"}')],
                                "seq long, value string")
    cat = FrameCatalog(spark, {("db_a", "t_a"): spark.createDataFrame([("2",)], "c_stm string")})
    bf = plan_batch(raw, cat, SyncOptions(run_ts=RUN_TS))
    out = json.loads(bf.tombstones().first().value)
    assert out == {"c_stm": "2", "n_jbfy": 5, "schemaName": "db_a", "tableName": "db_a_t_a", "dt": "2024-02-01",
                   "update_time": "2024-02-01 00:00:00", "dbid": "00", "data_state": 0}


def test_tombstones_lose_nothing(spark):
    """Texts that the variant parser rejects keep unknown fields and JSON types; of a repeated key the last value counts."""
    base = '"data_state":0,"schemaName":"db_x"'
    texts = {'{"c_stm":"a",%s,"extra":{"k":[1,"x"]},"n":1.5,"c_stm":"b"}' % base: {"c_stm": "b", "extra": {"k": [1, "x"]}, "n": 1.5},
             "{'c_stm':'a','extra':{'k':true},%s}" % base.replace('"', "'"): {"c_stm": "a", "extra": {"k": True}},
             '{"c_stm":"a",%s,"extra":null,"extra":2,"z":3,"z":null}' % base: {"c_stm": "a", "extra": 2}}
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    for r in df.select("value", tombstone_value(F.col("value"), F.lit("db_x_t_x"), RUN_TS, "00").alias("t")).collect():
        out = json.loads(r.t)
        assert {k: v for k, v in out.items() if k not in ("tableName", "dt", "update_time", "dbid", "data_state", "schemaName")} == texts[r.value]
        assert out["data_state"] == 0 and out["schemaName"] == "db_x"


def test_typed_rows_of_any_id(spark, tmp_path):
    """Ids beyond a small integer's range, and beyond an integer's, print as they are; where they fit, the types stay small."""
    from keyrelay.plans.registry import q_record_text
    from keyrelay.sources.fixtures import typed_frame
    for ids, kinds in (((5, 6), ("smallint", "int")), ((5, 40_000), ("int", "int")), ((-40_000, 3_000_000_000), ("bigint", "bigint")),
                       ((), ("smallint", "int"))):
        path = str(tmp_path / f"t{len(ids)}{max(ids, default=0)}")
        rows = [(n, 7, "view", 1.5) for n in ids]
        spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double").withColumn(
            "ts", F.lit("2024-01-01 00:00:01").cast("timestamp_ntz")).write.parquet(f"{path}/events.parquet")
        assert tuple(dict(typed_frame(spark, path).dtypes)[c] for c in ("i2", "i4")) == kinds
        got = {(r.c_stm, r.i2, r.i4) for r in q_record_text(spark, path).collect()}
        assert got == {(str(n),) * 3 for n in ids}
