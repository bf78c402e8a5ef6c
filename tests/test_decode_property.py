"""Property tests for decoding: any text is decoded or quarantined, never raises, and
well-formed events round-trip their fields."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from keyrelay.functions.decode import REASONS, decode_events

key = st.text(alphabet="abc019_-'\" ", min_size=0, max_size=6)
event = st.fixed_dictionaries(
    {"c_stm": key, "data_state": st.sampled_from([0, 1, 2, 3]), "schemaName": st.sampled_from(["db_x", "db_yy_z"])},
    optional={"c_baah": st.one_of(st.none(), key), "n_jbfy": st.one_of(st.none(), st.integers(-1000, 1000)),
              "d_xgsj": st.sampled_from(["", "2024-01-02 03:04:05", "2024-1-2 3:4:5.5"]),
              "extra": st.integers()})


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.text(max_size=30), st.none()), min_size=1, max_size=20))
def test_arbitrary_text_never_raises(spark, values):
    rows = [(i, v) for i, v in enumerate(values)]
    out = decode_events(spark.createDataFrame(rows, "seq long, value string")).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.reason is None or r.reason in REASONS
        if r.reason is None:
            assert r.data_state is not None and r.ajzlx


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(event, min_size=1, max_size=15))
def test_valid_events_round_trip(spark, events):
    rows = [(i, json.dumps(e)) for i, e in enumerate(events)]
    out = {r.seq: r for r in decode_events(spark.createDataFrame(rows, "seq long, value string")).collect()}
    for i, e in enumerate(events):
        r = out[i]
        assert r.reason is None, (e, r.reason)
        assert (r.c_stm, r.data_state, r.schema_name) == (e["c_stm"], e["data_state"], e["schemaName"])
        assert r.c_baah == e.get("c_baah") and r.n_jbfy == e.get("n_jbfy")
        assert r.ajzlx == e["schemaName"].split("_")[1]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.text(max_size=12)), st.one_of(st.none(), st.text(max_size=12))),
                min_size=1, max_size=10))
def test_record_json_round_trips_any_text(spark, rows):
    from pyspark.sql import functions as F

    from keyrelay.functions.records import record_fields, record_value
    df = spark.createDataFrame(rows, "`c_stm` string, `a.b` string")
    from keyrelay.functions.sqltext import row_texts
    packed = df.select(F.struct("*").alias("_row"))
    fields = record_fields(df.columns, "db_x", "t_x", "db_x_t_x", "00", "2024-02-01 00:00:00", row_texts(packed))
    got = [json.loads(r[0]) for r in packed.select(record_value(fields)).collect()]
    for (k, v), obj in zip(rows, got):
        assert obj.get("c_stm") == k and obj.get("a.b") == v
        assert ("c_stm" in obj) == (k is not None) and ("a.b" in obj) == (v is not None)
        assert obj["tableName"] == "db_x_t_x" and obj["data_state"] == 1 and "lsn" not in obj
