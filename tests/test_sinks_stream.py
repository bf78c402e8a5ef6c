"""Sinks (K1-K3), visibility of batches, repeated batches, the partitioned index, and the stream with an injected failure."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from keyrelay.config import FIXTURE_OPTIONS
from keyrelay.operators import index as idx
from keyrelay.plans import batch as batch_module
from keyrelay.plans.batch import plan_batch, process_batch
from keyrelay.session import list_dirs, scratch_path
from keyrelay.sinks import index_table, warehouse
from keyrelay.sources import events as evsrc
from keyrelay.sources import fixtures
from keyrelay.sources.catalog import FrameCatalog
from keyrelay.streaming.stream import start_sync

SF = "/root/testdata/sf0.001"
DT = "2024-02-01"


def _local(p):
    return p[5:] if p.startswith("file:") else p


def _same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _write(bf, root, batch_id=0):
    spark, o = bf.good.sparkSession, bf.opts
    staged = warehouse.stage_records(bf.record_groups(), root, o, batch_id)
    warehouse.finish(spark, root, o, batch_id, warehouse.write_records(staged, root, batch_id, o))


def _one_row_catalog(spark, rows):
    return FrameCatalog(spark, {("db_a", "t_a"): spark.createDataFrame(rows, "c_stm string, name string")})


def _events(spark, *keys, state=1):
    rows = [(n, f'{{"c_stm":"{k}","data_state":{state},"schemaName":"db_a"}}', None) for n, k in enumerate(keys)]
    return spark.createDataFrame(rows, "seq long, value string, apply_ts timestamp_ntz")


def test_process_batch_is_idempotent(spark):
    raw = fixtures.raw_events(spark, SF)
    cat = fixtures.fixture_catalog(spark, SF)
    root = scratch_path(spark, "t", "idem")
    process_batch(spark, raw, cat, FIXTURE_OPTIONS, root, 0)
    first = warehouse.read_records(spark, root, FIXTURE_OPTIONS).count()
    process_batch(spark, raw, cat, FIXTURE_OPTIONS, root, 0)          # replay of the same batch
    again = warehouse.read_records(spark, root, FIXTURE_OPTIONS).count()
    expect = plan_batch(raw, cat, FIXTURE_OPTIONS).records().count()
    assert first == again == expect
    errs = spark.read.parquet(root + "/errors").count()
    assert errs == plan_batch(raw, cat, FIXTURE_OPTIONS).errors().count()
    assert spark.read.parquet(root + "/quarantine").count() == 75
    assert list_dirs(spark, index_table.index_path(root, "00")) == ["of=64"]
    assert list_dirs(spark, root + "/_staging") == []
    _same(index_table.read_index(spark, root), idx.fold(plan_batch(raw, cat, FIXTURE_OPTIONS).index_events()))


def test_retry_keeps_nothing_of_the_first_attempt(spark):
    """The matching row has left the source between two attempts: neither its record nor its index row stays."""
    root = scratch_path(spark, "t", "retry")
    raw = _events(spark, "1", "2")
    process_batch(spark, raw, _one_row_catalog(spark, [("1", "x"), ("2", "y")]), FIXTURE_OPTIONS, root, 0)
    assert warehouse.read_records(spark, root, FIXTURE_OPTIONS).count() == 2
    process_batch(spark, raw, _one_row_catalog(spark, [("2", "y")]), FIXTURE_OPTIONS, root, 0)
    recs = warehouse.read_records(spark, root, FIXTURE_OPTIONS)
    assert [r[0] for r in recs.select(F.get_json_object("value", "$.c_stm")).collect()] == ["2"]
    assert [r.c_stm for r in index_table.read_index(spark, root).collect()] == ["2"]


def test_crashed_attempt_is_not_read(spark, monkeypatch):
    root = scratch_path(spark, "t", "crash")
    cat = _one_row_catalog(spark, [("1", "x"), ("2", "y")])
    process_batch(spark, _events(spark, "1"), cat, FIXTURE_OPTIONS, root, 0)

    def fail(*a, **k):
        raise RuntimeError("injected")

    with monkeypatch.context() as m:
        m.setattr(batch_module.index_table, "apply_delta", fail)
        with pytest.raises(RuntimeError, match="injected"):
            process_batch(spark, _events(spark, "2"), cat, FIXTURE_OPTIONS, root, 1)
    assert glob.glob(_local(warehouse.records_path(root, FIXTURE_OPTIONS)) + "/*/*/*/batch_id=1/part-*")
    assert warehouse.read_records(spark, root, FIXTURE_OPTIONS).count() == 1       # the unfinished batch is not seen
    process_batch(spark, _events(spark, "2"), cat, FIXTURE_OPTIONS, root, 1)
    assert warehouse.read_records(spark, root, FIXTURE_OPTIONS).count() == 2


def test_a_batch_that_finishes_during_a_read_is_not_seen(spark, monkeypatch):
    """A batch of several tables finishes between the reader's two listings: the reader sees nothing of it, then all."""
    root = scratch_path(spark, "t", "race")
    cat = FrameCatalog(spark, {("db_a", t): spark.createDataFrame([("1", "x"), ("2", "y")], "c_stm string, name string")
                               for t in ("t_a", "t_a_b", "t_a_c")})
    process_batch(spark, _events(spark, "1"), cat, FIXTURE_OPTIONS, root, 0)
    first = warehouse.batches

    def then_finish(*a):
        done = first(*a)
        process_batch(spark, _events(spark, "2"), cat, FIXTURE_OPTIONS, root, 1)
        return done

    with monkeypatch.context() as m:
        m.setattr(warehouse, "batches", then_finish)
        seen = warehouse.read_records(spark, root, FIXTURE_OPTIONS)
    assert seen.count() == 3
    assert warehouse.read_records(spark, root, FIXTURE_OPTIONS).count() == 6


def test_a_retry_after_a_lost_table_and_another_date(spark):
    """What the first attempt wrote for a table and a date that the second one no longer has is gone."""
    root = scratch_path(spark, "t", "lost")
    frame = spark.createDataFrame([("1", "x")], "c_stm string, name string")
    both, one = FrameCatalog(spark, {("db_a", "t_a"): frame, ("db_a", "t_a_b"): frame}), FrameCatalog(spark, {("db_a", "t_a"): frame})
    process_batch(spark, _events(spark, "1"), both, FIXTURE_OPTIONS, root, 0)
    process_batch(spark, _events(spark, "1"), one, FIXTURE_OPTIONS.with_(run_ts="2024-02-02 00:00:00"), root, 0)
    rows = warehouse.read_records(spark, root, FIXTURE_OPTIONS).collect()
    assert [(r.tableName, r.dt) for r in rows] == [("db_a_t_a", "2024-02-02")]
    assert len(glob.glob(_local(warehouse.records_path(root, FIXTURE_OPTIONS)) + "/*/*/*/*/part-*")) == 1


def test_restarted_numbering(spark):
    """Two streams that both count from zero: nothing is lost, and a repeated batch of the first one changes nothing."""
    root = scratch_path(spark, "t", "restart")
    cat = _one_row_catalog(spark, [(str(k), "n") for k in range(5)])
    a = FIXTURE_OPTIONS.with_(stream_id="a")
    b = a.with_(stream_id="b")
    process_batch(spark, _events(spark, "0", "1"), cat, a, root, 0)
    process_batch(spark, _events(spark, "2", "1", state=0), cat, b, root, 0)      # the other stream has deleted 1 since
    process_batch(spark, _events(spark, "3"), cat, b, root, 1)
    want = {"0": 1, "1": 0, "3": 1}
    assert {r.c_stm: r.data_state for r in index_table.read_index(spark, root).collect()} == want
    process_batch(spark, _events(spark, "2", "1", state=0), cat, b, root, 0)      # b's own older batch again
    assert {r.c_stm: r.data_state for r in index_table.read_index(spark, root).collect()} == want
    recs = warehouse.read_records(spark, root, a).groupBy("writer").count().collect()
    assert {r.writer: r["count"] for r in recs} == {"00-a": 2, "00-b": 3}


@pytest.mark.parametrize("layout", ["single", "per_table"])
def test_layouts_and_compaction(spark, layout):
    opts = FIXTURE_OPTIONS.with_(layout=layout, max_records_per_file=2000)     # many small files to compact
    raw, cat = fixtures.raw_events(spark, SF), fixtures.fixture_catalog(spark, SF)
    root = scratch_path(spark, "t", "layout")
    _write(plan_batch(raw, cat, opts), root, 3)
    base = _local(warehouse.records_path(root, opts))
    table = "db_supplier_t_lineitem" if layout == "per_table" else "tableName=db_supplier_t_lineitem"
    assert os.path.isdir(f"{base}/{table}/dt={DT}/writer=00-batch/batch_id=3")
    before = {(r.tableName, r.dt, r.value): r.n for r in warehouse.read_records(spark, root, opts).groupBy(
        "tableName", "dt", "value").agg(F.count("*").alias("n")).collect()}
    n_files = len(glob.glob(f"{base}/*/*/*/*/part-*"))
    plain = opts.with_(max_records_per_file=None)
    replaced = warehouse.compact(spark, root, plain, DT)
    assert replaced == len({k[0] for k in before}) and not glob.glob(f"{base}/*/*/writer=00-batch/*/part-*")
    assert warehouse.compact(spark, root, plain, DT) == 0           # this run is complete
    assert len(glob.glob(f"{base}/*/*/*/*/part-*")) < n_files
    _write(plan_batch(raw, cat, plain), root, 4)                    # a live batch next to the compacted date
    after = {(r.tableName, r.dt, r.value): r.n for r in warehouse.read_records(spark, root, plain).groupBy(
        "tableName", "dt", "value").agg(F.count("*").alias("n")).collect()}
    assert after == {k: 2 * n for k, n in before.items()}
    assert warehouse.compact(spark, root, plain, DT, run=1) > 0     # compacted again, first output included
    assert warehouse.read_records(spark, root, plain).count() == 2 * sum(before.values())
    assert {r.writer for r in warehouse.read_records(spark, root, plain).select("writer").distinct().collect()} == {
        f"compact-{DT}"}


def test_interrupted_compaction(spark, monkeypatch):
    """A crash before and one after the compaction becomes visible: readers see each record once, the next run cleans up."""
    root = scratch_path(spark, "t", "swap")
    cat = _one_row_catalog(spark, [("1", "x")])
    _write(plan_batch(_events(spark, "1", "1"), cat, FIXTURE_OPTIONS), root)

    def crash(*a):
        raise RuntimeError("injected")

    with monkeypatch.context() as m:
        m.setattr(warehouse, "finish", crash)
        with pytest.raises(RuntimeError):
            warehouse.compact(spark, root, FIXTURE_OPTIONS, DT)
    assert warehouse.read_records(spark, root, FIXTURE_OPTIONS).count() == 2
    calls = []
    drop = warehouse.drop_replaced
    with monkeypatch.context() as m:
        m.setattr(warehouse, "drop_replaced", lambda *a: crash() if calls else calls.append(drop(*a)))
        with pytest.raises(RuntimeError):
            warehouse.compact(spark, root, FIXTURE_OPTIONS, DT)
    base = _local(warehouse.records_path(root, FIXTURE_OPTIONS))
    assert len(glob.glob(f"{base}/*/*/writer=*")) == 2              # old and new files lie side by side
    recs = warehouse.read_records(spark, root, FIXTURE_OPTIONS)
    assert recs.count() == 2 and {r.writer for r in recs.collect()} == {f"compact-{DT}"}
    assert warehouse.compact(spark, root, FIXTURE_OPTIONS, DT) == 0
    assert not glob.glob(f"{base}/*/*/writer=00-batch/*/part-*")
    assert warehouse.read_records(spark, root, FIXTURE_OPTIONS).count() == 2


def test_copies_of_one_key_spread_over_tasks(spark):
    """One key with all events: its copies are dealt to many slots of about equal bytes."""
    cat = _one_row_catalog(spark, [("1", "x" * 50)])
    rows = spark.range(60_000).select(
        F.col("id").alias("seq"), F.lit('{"c_stm":"1","data_state":1,"schemaName":"db_a"}').alias("value"),
        F.lit(None).cast("timestamp_ntz").alias("apply_ts"))
    opts = FIXTURE_OPTIONS.with_(file_bytes=1 << 20)
    bf = plan_batch(rows, cat, opts)
    root = scratch_path(spark, "t", "spread")
    staged = warehouse.stage_records(bf.record_groups(), root, opts, 0)
    assert staged.count() == 60                            # chunks of 1,000 copies
    dealt, slots = warehouse.dealt(staged, opts)
    per_task = [r.n for r in dealt.groupBy(F.spark_partition_id()).agg(F.sum("_cnt").alias("n")).collect()]
    assert sum(per_task) == 60_000 and len(per_task) >= 8
    assert slots[0][3] >= 8


def test_slots_follow_bytes():
    sizes = [("a", DT, 10 * 2**27), ("b", DT, 5), ("c", DT, 2**27 + 1)]
    slots, total = warehouse.slots_of(sizes, FIXTURE_OPTIONS.with_(file_bytes=2**27), 8)
    # 11 files' worth for 16 slots that 8 cores ask for: eleven sixteenths of a file each
    assert [(s[0], s[3]) for s in slots] == [("a", 15), ("b", 1), ("c", 2)] and total == 18
    assert [s[2] for s in slots] == [0, 15, 16]


def test_stream_recovers_from_failure_between_sinks(spark):
    raw = fixtures.raw_events(spark, SF)
    cat = fixtures.fixture_catalog(spark, SF)
    stage = scratch_path(spark, "t", "stream_in")
    evsrc.stage_events(raw, stage, files=3)
    out = scratch_path(spark, "t", "stream_out")
    ck = out + "/_checkpoint"
    stream = lambda: evsrc.file_events(spark, stage, streaming=True, max_files_per_trigger=1)

    def failing(spark, df, catalog, opts, root, batch_id):
        """Stops batch 1 after its records are written and before its index partitions."""
        if batch_id == 1:
            opts = opts.with_(run_ts=str(df.agg(F.max("run_ts")).first()[0]))
            bf = plan_batch(df.drop("run_ts"), catalog, opts)
            staged = warehouse.stage_records(bf.record_groups(), root, opts, batch_id)
            warehouse.write_records(staged, root, batch_id, opts)
            raise RuntimeError(f"injected failure in batch {batch_id}")
        return process_batch(spark, df, catalog, opts, root, batch_id)

    q = start_sync(spark, stream(), cat, FIXTURE_OPTIONS, out, ck, {"availableNow": True}, run_batch=failing)
    try:
        q.awaitTermination()
    except Exception:
        pass
    assert q.exception() is not None
    q2 = start_sync(spark, stream(), cat, FIXTURE_OPTIONS, out, ck, {"availableNow": True})
    q2.awaitTermination()
    assert q2.exception() is None
    assert q2.id == q.id                                       # the writer id survives the restart
    got = index_table.read_index(spark, out)
    want = idx.fold(plan_batch(raw, cat, FIXTURE_OPTIONS).index_events())
    cols = ["index_table", "c_stm", "d_xgsj", "c_baah", "n_jbfy", "create_time", "data_state"]
    _same(got.select(cols), want.select(cols))
    # the replayed batch rewrote its own record files instead of adding to them
    recs = warehouse.read_records(spark, out, FIXTURE_OPTIONS)
    per_batch = {r.batch_id: r["count"] for r in recs.groupBy("batch_id").count().collect()}
    assert sorted(per_batch) == [0, 1, 2]
    assert sum(per_batch.values()) == plan_batch(raw, cat, FIXTURE_OPTIONS).records().count()


def test_backlog_is_drained_without_waiting(spark):
    """No intake cap and no pause between batches: more events than the former cap of 5,000, default trigger."""
    n = 12_000
    stage = scratch_path(spark, "t", "backlog_in")
    evsrc.stage_events(spark.range(n).select(
        F.col("id").alias("seq"), F.concat(F.lit('{"c_stm":"'), F.col("id"), F.lit('","data_state":1,"schemaName":"db_a"}'))
        .alias("value"), F.lit(None).cast("timestamp_ntz").alias("apply_ts")), stage, files=2)
    out = scratch_path(spark, "t", "backlog_out")
    cat = FrameCatalog(spark, {("db_a", "t_a"): spark.range(n).select(F.col("id").alias("c_stm"))})
    q = start_sync(spark, evsrc.file_events(spark, stage, streaming=True), cat, FIXTURE_OPTIONS, out, out + "/_checkpoint")
    try:
        q.processAllAvailable()
        assert q.lastProgress["batchId"] in (0, 1)             # one batch took all there was (an empty one may follow)
    finally:
        q.stop()
    assert warehouse.read_records(spark, out, FIXTURE_OPTIONS).count() == n


def test_batch_time_is_the_zone_clock(spark):
    from keyrelay.streaming.stream import with_batch_time
    df = spark.range(1)
    r = with_batch_time(df, "UTC").select(F.col("run_ts").alias("u")).crossJoin(
        with_batch_time(df, "Asia/Shanghai").select(F.col("run_ts").alias("s"))).first()
    assert round((r.s - r.u).total_seconds() / 3600) == 8


def _delta(spark, *rows):
    """Folded events of a key: (seq, key, state, n_jbfy)."""
    ev = spark.createDataFrame([("index_00.t_a_index", k, seq, state, None, None, n, None) for seq, k, state, n in rows],
                               "index_table string, c_stm string, seq long, data_state int, d_xgsj timestamp_ntz, c_baah string, "
                               "n_jbfy int, apply_ts timestamp_ntz")
    return idx.fold_delta(ev)


def _index(spark, root):
    rows = index_table.read_index(spark, root, "00")
    return {r.c_stm: (r.data_state, r.n_jbfy) for r in rows.collect()} if rows is not None else {}


def _apply(spark, root, batch_id, *rows, again=False, writer="w", **kw):
    return index_table.apply_delta(spark, root, "00", _delta(spark, *rows), writer, batch_id, 4, f"{root}/staged", again, **kw)


def test_index_partitions(spark, monkeypatch):
    """Untouched partitions keep their files; retries take back what an attempt wrote; replays and crashes change nothing."""
    root = scratch_path(spark, "t", "index")
    files = lambda: set(glob.glob(_local(root) + "/index/dbid=00/of=4/bucket=*/part-*"))
    keys = [str(k) for k in range(40)]
    assert _apply(spark, root, 0, *[(k, key, 1, 0) for k, key in enumerate(keys)]) == [0, 1, 2, 3]
    before = files()
    touched = _apply(spark, root, 1, (100, "7", 2, 5), (101, "new", 1, 6), broadcast_delta=True)
    assert 1 <= len(touched) <= 2
    kept = {f for f in before if int(f.split("bucket=")[1].split("/")[0]) not in touched}
    assert kept and kept <= files() and not (before - kept) & files()
    assert _index(spark, root)["7"] == (2, 5) and _index(spark, root)["new"] == (1, 6)
    # the batch again, with other rows than before: "new" and the change of 7 are taken back
    _apply(spark, root, 1, (100, "8", 2, 9), again=True)
    state = _index(spark, root)
    assert state["7"] == (1, 0) and state["8"] == (2, 9) and "new" not in state and len(state) == 40
    # a later batch, then the first one replayed: nothing moves
    _apply(spark, root, 2, (200, "8", 0, None))
    state = _index(spark, root)
    assert state["8"] == (0, 9)
    _apply(spark, root, 0, *[(k, key, 1, 0) for k, key in enumerate(keys)], again=True)
    assert _index(spark, root) == state
    # an attempt ends while partitions are replaced: the next one finishes them from the staged rows
    path, _ = index_table.table_path(spark, root, "00", 99)
    replace = index_table._replace

    def broken(spark, path, staging, touched):
        for f in glob.glob(_local(path) + "/bucket=*/*"):
            if any(f"bucket={k}/" in f for k in touched):
                os.rename(f, _local(root) + "/" + os.path.basename(f))
        raise RuntimeError("injected")

    with monkeypatch.context() as m:
        m.setattr(index_table, "_replace", broken)
        with pytest.raises(RuntimeError):
            _apply(spark, root, 3, *[(300 + k, key, 2, 1) for k, key in enumerate(keys)])
    assert index_table._replace is replace and len(_index(spark, root)) < 40
    _apply(spark, root, 3, (300, "9", 2, 4), again=True)
    assert _index(spark, root) == {**state, "9": (2, 4)}


def test_an_attempt_that_leaves_a_partition_empty(spark):
    root = scratch_path(spark, "t", "empty")
    _apply(spark, root, 0, (1, "a", 1, 1))
    _apply(spark, root, 0, (1, "a", 0, None), again=True)           # now a delete of a key that never was
    assert _index(spark, root) == {} and not glob.glob(_local(root) + "/index/dbid=00/of=4/bucket=*/part-*")
    assert _apply(spark, root, 1) == []


def test_index_in_batches_equals_the_fold(spark):
    raw = fixtures.raw_events(spark, SF)
    ie = plan_batch(raw, fixtures.fixture_catalog(spark, SF), FIXTURE_OPTIONS).index_events().persist()
    root = scratch_path(spark, "t", "batches")
    bounds = [0, 300, 650, 10**9]
    for n in range(3):
        delta = idx.fold_delta(ie.filter((F.col("seq") >= bounds[n]) & (F.col("seq") < bounds[n + 1])))
        index_table.apply_delta(spark, root, "00", delta, "w", n, 8, f"{root}/staged", broadcast_delta=n == 1)
    _same(index_table.read_index(spark, root), idx.fold(ie))
    ie.unpersist()


def test_job_count_and_figures_of_a_batch(spark):
    """No counting job runs over the events: figures are observed while they are written."""
    from keyrelay.plans.batch import Intake, event_stats
    raw, cat = fixtures.raw_events(spark, SF), fixtures.fixture_catalog(spark, SF)
    tracker, group = spark.sparkContext.statusTracker(), "figures"
    spark.sparkContext.setJobGroup(group, group)
    intake = Intake(raw, scratch_path(spark, "t", "intake"), cat.known())
    seen = intake.stats()
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("other", "other")
    assert jobs == 1
    assert seen == event_stats(intake.events.filter(F.col("reason").isNull()), cat.known())
    figures = {(k, n): v for k, n, v in intake.metrics()}
    assert figures["events", "taken in"] == 1000 and figures["reason", "bad_json"] > 0
    # a schema that only its document view leads to is counted by name
    odd = _events(spark, "1", "2").withColumn("value", F.replace("value", F.lit("db_a"), F.lit("zz_customer")))
    stats, _, _ = Intake(odd, scratch_path(spark, "t", "intake"), cat.known()).stats()
    assert list(stats) == ["zz_customer"] and stats["zz_customer"].n_events == 2


def test_key_bound_of_the_sketch(spark):
    from keyrelay.plans.batch import event_stats
    from keyrelay.functions.decode import decode_events
    n = 30_000
    raw = spark.range(2 * n).select(F.col("id").alias("seq"), F.concat(F.lit('{"c_stm":"'), F.col("id") % n, F.lit(
        '","data_state":1,"schemaName":"db_a"}')).alias("value"), F.lit(None).cast("timestamp_ntz").alias("apply_ts"))
    st = event_stats(decode_events(raw), (["db_a"], []))[0]["db_a"]
    assert st.n_events == 2 * n and n <= st.n_keys <= 1.15 * n and st.key_bytes >= 5 * n


def test_intake_bounded_in_bytes(spark):
    from keyrelay.plans import registry
    index, batches, _ = registry._streamed(spark, SF, "bound", 3, max_bytes_per_trigger=1)
    assert batches == 3                                             # a file a batch, the backlog drained
    with pytest.raises(ValueError):
        evsrc.file_events(spark, "x", True, max_files_per_trigger=1, max_bytes_per_trigger=1)


def test_compressed_record_files(spark):
    opts = FIXTURE_OPTIONS.with_(text_compression="gzip")
    bf = plan_batch(fixtures.raw_events(spark, SF), fixtures.fixture_catalog(spark, SF), opts)
    root = scratch_path(spark, "t", "gz")
    _write(bf, root)
    files = glob.glob(_local(warehouse.records_path(root, opts)) + "/*/*/*/*/part-*")
    assert files and all(f.endswith(".gz") for f in files)
    assert warehouse.read_records(spark, root, opts).count() == bf.records().count()


def test_batches_without_events(spark):
    """No rows, or rows that the optimiser knows to be none: the batch finishes and leaves nothing but its mark."""
    cat = _one_row_catalog(spark, [("1", "x")])
    schema = "seq long, value string, apply_ts timestamp_ntz"
    for raw in (spark.createDataFrame([], schema), spark.sql("SELECT 1L AS seq, 'x' AS value, CAST(NULL AS timestamp_ntz) AS apply_ts WHERE false")):
        root = scratch_path(spark, "t", "none")
        assert process_batch(spark, raw, cat, FIXTURE_OPTIONS, root, 0)["metrics"] == []
        assert warehouse.read_records(spark, root, FIXTURE_OPTIONS).count() == 0 and index_table.read_index(spark, root) is None
        assert warehouse.batches(spark, root).count() == 1
    stream = spark.createDataFrame([], schema + ", run_ts timestamp_ntz")
    assert process_batch(spark, stream, cat, FIXTURE_OPTIONS.with_(run_ts=None), root, 1) == {"batch_id": 1, "empty": True}


def test_copies_take_little_room_and_compaction_does_not_shuffle_them(spark):
    """5,000 copies of a record and one of another: lines as before, in a file of a few kB, before and after a compaction."""
    cat = _one_row_catalog(spark, [("1", "x" * 200), ("2", "y"), ("3", "z" * (2 * warehouse.BLOCK_BYTES))])
    for layout in ("single", "per_table"):
        opts = FIXTURE_OPTIONS.with_(layout=layout)
        root = scratch_path(spark, "t", "copies")
        _write(plan_batch(_events(spark, *["1"] * 5000, "2", "3", "3"), cat, opts), root)
        lines = lambda: sorted(r.n for r in warehouse.read_records(spark, root, opts).groupBy("value").agg(
            F.count("*").alias("n")).collect())
        size = lambda: sum(os.path.getsize(f) for f in glob.glob(
            _local(warehouse.records_path(root, opts)) + "/*/*/*/*/part-*"))
        assert lines() == [1, 2, 5000] and size() < 50_000
        assert warehouse.compact(spark, root, opts, DT) == 1
        assert lines() == [1, 2, 5000] and size() < 50_000


def test_plain_files_hold_the_lines_of_the_copies(spark):
    """Without a codec the files are text lines, with and without a bound of records per file."""
    cat = _one_row_catalog(spark, [("1", "x"), ("2", "y")])
    for bound in (None, 100):
        opts = FIXTURE_OPTIONS.with_(text_compression=None, max_records_per_file=bound)
        root = scratch_path(spark, "t", "plain")
        _write(plan_batch(_events(spark, *["1"] * 2500, "2"), cat, opts), root)
        texts = [open(f).read() for f in glob.glob(_local(warehouse.records_path(root, opts)) + "/*/*/*/*/part-*.txt")]
        assert sorted(map(len, (t.splitlines() for t in texts)))[-1] <= (bound or 2501)
        found = "".join(texts).splitlines()
        assert len(found) == 2501 and sum('"name":"x"' in x for x in found) == 2500
