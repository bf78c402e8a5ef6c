"""Rule tests for event decoding and quarantine (T1 T2 T12 T13 F6, quirks Q3 Q14 Q22 Q23)."""

import datetime as dt

from keyrelay.functions.decode import decode_events

RAW = "seq long, value string"


def _decode(spark, rows):
    df = decode_events(spark.createDataFrame(rows, RAW))
    return {r.seq: r for r in df.collect()}


def test_types_are_coerced_like_the_original_parser(spark):
    r = _decode(spark, [
        (1, '{"c_stm":"a","data_state":1,"schemaName":"db_xzys"}'),
        (2, '{"c_stm":"a","data_state":"2","schemaName":"db_xzys"}'),
        (3, '{"c_stm":7,"data_state":0,"n_jbfy":"12","schemaName":"db_xzys"}'),
    ])
    assert (r[1].data_state, r[1].ajzlx, r[1].reason) == (1, "xzys", None)
    assert (r[2].data_state, r[2].reason) == (2, None)
    assert (r[3].c_stm, r[3].n_jbfy, r[3].reason) == ("7", 12, None)


def test_optional_fields_default_to_null(spark):
    r = _decode(spark, [
        (1, '{"c_stm":"a","data_state":1,"schemaName":"db_x","n_jbfy":null}'),
        (2, '{"c_stm":"a","data_state":1,"schemaName":"db_x","d_xgsj":""}'),
    ])
    for s in (1, 2):
        assert r[s].reason is None
        assert r[s].c_baah is None and r[s].n_jbfy is None and r[s].d_xgsj is None


def test_modification_time_formats(spark):
    r = _decode(spark, [
        (1, '{"c_stm":"a","data_state":1,"schemaName":"db_x","d_xgsj":"2024-01-02 03:04:05"}'),
        (2, '{"c_stm":"a","data_state":1,"schemaName":"db_x","d_xgsj":"2024-1-2 3:4:5.25"}'),
        (3, '{"c_stm":"a","data_state":2,"schemaName":"db_x","d_xgsj":"2024-01-02"}'),
        (4, '{"c_stm":"a","data_state":0,"schemaName":"db_x","d_xgsj":"not a time"}'),
    ])
    assert r[1].d_xgsj == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert r[2].d_xgsj == dt.datetime(2024, 1, 2, 3, 4, 5, 250000)
    assert r[3].reason == "bad_d_xgsj"        # date only is not a timestamp
    assert r[4].reason is None and r[4].d_xgsj is None   # a delete never reads the time


def test_quarantine_reasons(spark):
    r = _decode(spark, [
        (1, "oops"), (2, ""), (3, "[1]"), (4, None),
        (5, '{"c_stm":"a","schemaName":"db_x"}'),
        (6, '{"c_stm":"a","data_state":"x","schemaName":"db_x"}'),
        (7, '{"c_stm":"a","data_state":1,"schemaName":"nounderscore"}'),
        (8, '{"c_stm":"a","data_state":1,"schemaName":"db_"}'),
        (9, '{"c_stm":"a","data_state":1}'),
        (10, '{"c_stm":"a","data_state":1,"schemaName":"db_x","n_jbfy":"abc"}'),
        (11, '{"c_stm":"a","data_state":"1.0","schemaName":"db_x"}'),
    ])
    assert [r[i].reason for i in range(1, 12)] == [
        "bad_json", "bad_json", "bad_json", "bad_json", "no_data_state", "bad_data_state",
        "bad_schema_name", "bad_schema_name", "bad_schema_name", "bad_n_jbfy", "bad_data_state"]


def test_null_key_is_valid(spark):
    r = _decode(spark, [(1, '{"data_state":0,"schemaName":"db_x"}')])
    assert r[1].reason is None and r[1].c_stm is None


def test_text_after_the_object_is_bad_json(spark):
    good = '{"c_stm":"a","data_state":1,"schemaName":"db_x"}'
    r = _decode(spark, [(1, good), (2, good + " xyz"), (3, good + "}"), (4, good + good), (5, f" {good}\n"), (6, good + ", 1"),
                        (7, good[:-1])])
    assert [r[k].reason for k in range(1, 8)] == [None, "bad_json", "bad_json", "bad_json", None, "bad_json", "bad_json"]


def test_modification_time_ignores_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = _decode(spark, [(1, '{"c_stm":"a","data_state":1,"schemaName":"db_x","d_xgsj":"2024-03-10 02:30:00"}')])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert r[1].d_xgsj == dt.datetime(2024, 3, 10, 2, 30)      # an hour that New York skipped
