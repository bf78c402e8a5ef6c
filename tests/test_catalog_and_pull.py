"""Catalogue rules (S5 S6 A1 T4 J5 F3 F4 Q7 Q15) and keyed pulls."""

from keyrelay.config import SyncOptions
from keyrelay.operators import catalog_ops as cat
from keyrelay.plans.batch import plan_batch
from keyrelay.sources.catalog import FrameCatalog

RUN_TS = "2024-02-01 00:00:00"


def _catalog(spark):
    f = {
        ("db_a", "t_a"): spark.createDataFrame([("1", "x"), ("2", "y")], "c_stm string, name string"),
        ("db_a", "t_a_child"): spark.createDataFrame([("c1", "1"), ("c2", "1"), ("c3", "2")],
                                                     "c_stm string, c_stm_a string"),
        ("db_a", "t_only_fk"): spark.createDataFrame([("1",)], "c_stm_a string"),   # single key, not c_stm
        ("db_a", "t_nokey"): spark.createDataFrame([("z",)], "r string"),
        ("db_a", "tab"): spark.createDataFrame([("1", "n")], "c_stm string, n string"),
        ("db_a", "x_other"): spark.createDataFrame([("1",)], "c_stm string"),       # not LIKE 't_%'
        ("db_fyygx", "v_a"): spark.createDataFrame([("1", "doc")], "c_stm_a string, body string"),
    }
    return FrameCatalog(spark, f, views={("db_fyygx", "v_a")})


def _raw(spark, events):
    rows = [(i, f'{{"c_stm":"{k}","data_state":{s},"schemaName":"db_a"}}') for i, (k, s) in enumerate(events)]
    return spark.createDataFrame(rows, "seq long, value string")


def test_key_shape(spark):
    c = _catalog(spark)
    shape = {r.table_name: r for r in cat.key_shape(c.tables(), c.columns()).collect()}
    assert set(shape) == {"t_a", "t_a_child", "t_only_fk", "t_nokey", "tab"}
    assert (shape["t_a"].key_column, shape["t_a"].key_present, shape["t_a"].main_family) == ("c_stm", True, True)
    assert (shape["t_a_child"].key_column, shape["t_a_child"].main_family) == ("c_stm_a", True)
    assert (shape["t_only_fk"].key_column, shape["t_only_fk"].key_present) == ("c_stm", False)
    assert (shape["t_nokey"].key_column, shape["t_nokey"].key_present) == ("c_stm_a", False)
    assert (shape["tab"].routable, shape["tab"].main_family) == (False, False)


def test_pull_multiplicity_and_routing(spark):
    c = _catalog(spark)
    ev = [("1", 1), ("1", 2), ("2", 1), ("9", 1), ("1", 0)]
    for limit, push in ((10**6, 10**4), (0, 10**4), (0, 0)):      # broadcast path, shuffle path, written keys
        opts = SyncOptions(run_ts=RUN_TS, broadcast_key_limit=limit, pushdown_key_limit=push)
        bf = plan_batch(_raw(spark, ev), c, opts)
        counts = {r.tableName: r["count"] for r in bf.records().groupBy("tableName").count().collect()}
        # key 1 has two pull events -> two copies of each row; key 9 matches nothing
        assert counts == {"db_a_t_a": 3 + 1, "db_a_t_a_child": 2 * 2 + 1, "db_a_t_aws": 2}
        errs = {r.tableName: r["count"] for r in bf.errors().groupBy("tableName").count().collect()}
        assert errs == {"db_a.t_only_fk": 4, "db_a.t_nokey": 4, "db_a.tab": 2}
    latest = plan_batch(_raw(spark, ev), c, SyncOptions(run_ts=RUN_TS, multiplicity="latest"))
    lc = {r.tableName: r["count"] for r in latest.records().groupBy("tableName").count().collect()}
    assert lc == {"db_a_t_a": 2 + 1, "db_a_t_a_child": 3, "db_a_t_aws": 1}


def test_gate_uses_main_family_only(spark):
    c = _catalog(spark)
    bf = plan_batch(_raw(spark, [("1", 1), ("9", 2), ("9", 0)]), c, SyncOptions(run_ts=RUN_TS))
    got = sorted((r.c_stm, r.data_state) for r in bf.index_events().collect())
    assert got == [("1", 1), ("9", 0)]


def test_null_key_matches_nothing(spark):
    c = _catalog(spark)
    raw = spark.createDataFrame([(0, '{"data_state":1,"schemaName":"db_a"}'),
                                 (1, '{"data_state":0,"schemaName":"db_a"}')], "seq long, value string")
    bf = plan_batch(raw, c, SyncOptions(run_ts=RUN_TS))
    recs = bf.records().collect()
    assert [r.tableName for r in recs] == ["db_a_t_a"]            # only the tombstone
    assert bf.index_events().count() == 0


def test_chunked_copies_equal_per_event_rows(spark):
    from keyrelay.operators.pull import pulled_row_copies, pulled_rows, replicate
    c = _catalog(spark)
    ev = [("1", 1)] * 5 + [("2", 2)] * 3 + [("9", 1)]
    bf = plan_batch(_raw(spark, ev), c, SyncOptions(run_ts=RUN_TS))
    plan = next(p for p in bf.record_plans() if p.table == "t_a_child")
    want = sorted(tuple(r) for r in pulled_rows(c, plan, bf.side("db_a"), bf.opts)
                  .select("_row.c_stm", "_k").collect())
    for chunk in (1, 2, 10_000):
        rows = pulled_row_copies(c, plan, bf.side("db_a"), bf.opts, chunk=chunk)
        assert rows.agg({"_cnt": "max"}).first()[0] <= chunk
        got = sorted(tuple(r) for r in replicate(rows).select("_row.c_stm", "_k").collect())
        assert got == want, chunk


def test_state_three_pulls_rows_and_shared_index_table(spark):
    from keyrelay.operators import index as idx
    frames = {
        ("db_a", "t_a"): spark.createDataFrame([("1", "x")], "c_stm string, name string"),
        ("xx_a", "t_a"): spark.createDataFrame([("1", "y")], "c_stm string, name string"),
    }
    c = FrameCatalog(spark, frames)
    rows = [(0, '{"c_stm":"1","data_state":3,"schemaName":"db_a"}'),     # Q18: pulls, no index change
            (1, '{"c_stm":"1","data_state":1,"schemaName":"xx_a"}'),     # Q21: same case type "a"
            (2, '{"c_stm":"1","data_state":2,"schemaName":"db_a"}')]
    bf = plan_batch(spark.createDataFrame(rows, "seq long, value string"), c, SyncOptions(run_ts=RUN_TS))
    counts = {r.tableName: r["count"] for r in bf.records().groupBy("tableName").count().collect()}
    assert counts == {"db_a_t_a": 2, "xx_a_t_a": 1}
    ie = bf.index_events()
    assert sorted((r.seq, r.index_table) for r in ie.collect()) == [
        (1, "index_00.t_a_index"), (2, "index_00.t_a_index")]
    out = idx.fold(ie).collect()
    assert len(out) == 1 and out[0].data_state == 2          # the update from db_a lands on xx_a's insert


def test_unknown_schemas_stay_off_the_driver(spark):
    """Made-up schema names of events are not counted one by one; a schema known by its view alone still is."""
    frames = {("db_a", "t_a"): spark.createDataFrame([("1",)], "c_stm string"),
              ("db_fyygx", "v_b"): spark.createDataFrame([("1", "doc")], "c_stm_b string, body string")}
    rows = [(k, f'{{"c_stm":"1","data_state":{k % 2},"schemaName":"db_x{k}"}}') for k in range(200)]
    rows += [(200, '{"c_stm":"1","data_state":1,"schemaName":"db_a"}'), (201, '{"c_stm":"1","data_state":2,"schemaName":"yy_b"}')]
    bf = plan_batch(spark.createDataFrame(rows, "seq long, value string"),
                    FrameCatalog(spark, frames, views={("db_fyygx", "v_b")}), SyncOptions(run_ts=RUN_TS))
    assert set(bf.stats) == {"db_a", "yy_b"} and bf.n_deletes == 100
    counts = {r.tableName: r["count"] for r in bf.records().groupBy("tableName").count().collect()}
    assert counts["db_a_t_a"] == 1 and counts["yy_b_t_bws"] == 1 and sum(counts.values()) == 102
