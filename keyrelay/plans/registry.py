"""Registered queries: one per operator group of the survey, each ``(spark, sf_dir) -> DataFrame``.

All of them run the real sync functions over the provided tables (events decoded
from JSON text, the eight-table source catalogue of FIXTURES.md) with the fixture
constants dbid '00' and run_ts 2024-02-01 00:00:00. Queries that exercise sinks
write to a fresh folder under the session's checkpoint directory and read back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DATE_FORMAT, FIXTURE_DT, FIXTURE_OPTIONS, SyncOptions
from ..functions.decode import route
from ..functions.names import dt_value, index_table, tombstone_table, view_table, wall_clock
from ..operators import catalog_ops as cat
from ..operators import index as idx
from ..operators.catalog_ops import TablePlan
from ..operators.pull import full_pull
from ..session import delete_dir, scratch_path, session_with
from ..sinks import index_table as index_sink
from ..sinks import warehouse
from ..sources import events as evsrc
from ..sources import fixtures
from ..sources.catalog import KEY, FrameCatalog
from ..sources.session_catalog import SessionCatalog
from .batch import BatchFrames, plan_batch, process_batch, run_full_pull, small_delta

OPTS = FIXTURE_OPTIONS


def batch(spark: SparkSession, sf_dir: str, opts: SyncOptions = OPTS) -> BatchFrames:
    """One planned batch over the test tables; its decoded events stay cached until the session's cache is cleared."""
    return plan_batch(fixtures.raw_events(spark, sf_dir), fixtures.fixture_catalog(spark, sf_dir), opts, persist=True)


def _plans(bf: BatchFrames, pred) -> list[TablePlan]:
    return [p for p in bf.record_plans() if pred(p)]


def _row_text(p: TablePlan, bf: BatchFrames) -> Column:
    """All source columns of a pulled row as one text, name=value in column order."""
    return F.concat_ws("|", *[F.concat(F.lit(f"{c}="), F.col(f"`_row`.`{c}`").cast("string")) for c in bf.source_columns(p)])


def _pull_rows(bf: BatchFrames, plans: list[TablePlan]) -> DataFrame:
    frames = [bf.pulled(p, row=_row_text(p, bf)).select("seq", F.lit(p.record_table).alias("tableName"), F.col(KEY).alias("c_stm"),
                                                        F.col("_row").alias("row")) for p in plans]
    return reduce(DataFrame.unionByName, frames)


def _body(value: Column) -> Column:
    """A record's JSON as one text: name=value of all fields, by name."""
    fields = F.sort_array(F.map_entries(F.from_json(value, "map<string,string>")))      # parsed once, not once per field
    return F.array_join(F.transform(fields, lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")


# -- events ------------------------------------------------------------------
def q_decode_events(spark, sf_dir):
    bf = batch(spark, sf_dir)
    return bf.good.select("seq", "c_stm", "d_xgsj", "data_state", "c_baah", "n_jbfy", "schema_name", "ajzlx")


def q_route_counts(spark, sf_dir):
    bf = batch(spark, sf_dir)
    return bf.good.groupBy("schema_name", route(bf.good).alias("route")).agg(F.count(F.lit(1)).alias("n"))


def q_quarantine(spark, sf_dir):
    return batch(spark, sf_dir).quarantine.select("seq", "reason")


def q_target_names(spark, sf_dir):
    g = batch(spark, sf_dir).good
    s, a = F.col("schema_name"), F.col("ajzlx")
    return g.select("seq", tombstone_table(s, a).alias("tombstone_table"), view_table(s, a).alias("view_table"),
                    index_table(OPTS.dbid, a).alias("index_table"), dt_value(OPTS.run_ts).alias("dt"))


def q_target_names_zone(spark, sf_dir):
    """Processing dates of each event's own instant in a zone eight hours ahead (a third of each day is the next date)."""
    g = batch(spark, sf_dir).good
    clock = wall_clock(F.col("apply_ts"), "Asia/Shanghai")
    return g.select("seq", tombstone_table(F.col("schema_name"), F.col("ajzlx")).alias("tombstone_table"),
                    F.date_format(clock, DATE_FORMAT).alias("dt"))


# -- catalogue -----------------------------------------------------------------
def _event_schemas(bf: BatchFrames) -> DataFrame:
    return bf.pull_events.select(F.col("schema_name").alias("table_schema")).distinct()


def q_catalog_tables(spark, sf_dir):
    bf = batch(spark, sf_dir)
    return cat.listed_tables(bf.catalog.tables()).join(_event_schemas(bf), "table_schema", "left_semi")


def q_catalog_key_shape(spark, sf_dir):
    bf = batch(spark, sf_dir)
    return cat.key_shape(bf.catalog.tables(), bf.catalog.columns()).join(_event_schemas(bf), "table_schema",
                                                                         "left_semi")


def q_fanout(spark, sf_dir):
    bf = batch(spark, sf_dir)
    tables = bf.catalog.tables()
    return cat.fanout(bf.pull_events, tables, tables.count(), OPTS.broadcast_catalog_limit)


# -- pulls and records ----------------------------------------------------------
def q_pull_main(spark, sf_dir):
    bf = batch(spark, sf_dir)
    return _pull_rows(bf, _plans(bf, lambda p: p.kind == "table" and p.table == cat.main_table(p.ajzlx)))


def q_pull_child(spark, sf_dir):
    bf = batch(spark, sf_dir)
    return _pull_rows(bf, _plans(bf, lambda p: p.kind == "table" and p.key_column != "c_stm"))


def q_pull_irregular(spark, sf_dir):
    bf = batch(spark, sf_dir)
    return _pull_rows(bf, _plans(bf, lambda p: p.kind == "table" and p.key_column == "c_stm"
                                 and p.table != cat.main_table(p.ajzlx)))


def q_pull_docview(spark, sf_dir):
    bf = batch(spark, sf_dir)
    frames = [bf.pulled(p).select("seq", F.lit(p.record_table).alias("tableName"), F.col(KEY).alias("c_stm"),
                                  *[F.col(f"`_row`.`{c}`").cast("string").alias(c) for c in bf.source_columns(p)])
              for p in bf.plans if p.kind == "view" and p.key_present]
    return reduce(DataFrame.unionByName, frames)


def _main_and_child(bf: BatchFrames) -> DataFrame:
    return _pull_rows(bf, _plans(bf, lambda p: p.kind == "table" and (
        p.table == cat.main_table(p.ajzlx) or p.key_column != "c_stm")))


#: Every key is more than any limit, as in a batch of many millions of keys.
WIDE = OPTS.with_(pushdown_key_limit=0, broadcast_key_limit=0)
#: ... and every source is large enough for a Bloom filter and too large for a broadcast.
WIDE_SETTINGS = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
                 "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
                 "spark.sql.optimizer.runtimeFilter.number.threshold": "200", "spark.sql.autoBroadcastJoinThreshold": "-1"}


def q_pull_wide(spark, sf_dir):
    """Main and child tables by more keys than any limit: Bloom-filtered sources, shuffle joins on the keys' own types."""
    return _main_and_child(batch(session_with(spark, WIDE_SETTINGS), sf_dir, WIDE))


def _registered(spark, sf_dir, name: str) -> tuple[SessionCatalog, list[str], str]:
    root = scratch_path(spark, "q", name)
    prefix = f"kr_{root.rsplit('/', 1)[1]}_"
    return SessionCatalog(spark, prefix), fixtures.register_sources(spark, sf_dir, prefix, root), root


def _unregister(spark, databases: list[str], root: str | None = None) -> None:
    """Drop the databases, and the files of their tables, if ``root`` names them; frames over these tables need only the files."""
    for db in databases:
        spark.sql(f"DROP DATABASE `{db}` CASCADE")
    if root:
        delete_dir(spark, root)


def q_pull_bucketed(spark, sf_dir):
    """The same pulls from registered tables; the child tables are bucketed by their key and are not shuffled.

    The tables' files stay in the scratch folder for the rows, which are as many as events meet rows and are stored nowhere.
    """
    own = session_with(spark, WIDE_SETTINGS)
    catalog, databases, _ = _registered(own, sf_dir, "bucketed")
    try:
        return _main_and_child(plan_batch(fixtures.raw_events(own, sf_dir), catalog, WIDE, persist=True))
    finally:
        _unregister(own, databases)


def q_catalog_session(spark, sf_dir):
    """Key shapes and column counts of tables and views registered in Spark's catalogue after it was first read."""
    catalog, databases, root = _registered(spark, sf_dir, "catalog")
    try:
        bf = plan_batch(fixtures.raw_events(spark, sf_dir), catalog, OPTS)
        columns = catalog.columns()
        shape = cat.key_shape(catalog.tables(), columns).join(_event_schemas(bf), "table_schema", "left_semi")
        counts = columns.groupBy("table_schema", "table_name").agg(F.count(F.lit(1)).alias("n_columns"))
        return _settle(shape.join(counts, ["table_schema", "table_name"]).join(catalog.tables(), ["table_schema", "table_name"]))
    finally:
        _unregister(spark, databases, root)


def q_tombstones(spark, sf_dir):
    t = batch(spark, sf_dir).tombstones()
    v = F.col("value")
    pj = F.parse_json(v)
    return t.select(
        "seq", "tableName",
        F.get_json_object(v, "$.dt").alias("dt"),
        F.get_json_object(v, "$.dbid").alias("dbid"),
        F.variant_get(pj, "$.data_state", "int").alias("data_state"),
        F.schema_of_variant(F.variant_get(pj, "$.data_state", "variant")).alias("data_state_type"),
        F.get_json_object(v, "$.c_stm").alias("c_stm"),
        F.get_json_object(v, "$.schemaName").alias("schemaName"),
        F.get_json_object(v, "$.c_baah").alias("c_baah"),
        F.variant_get(pj, "$.n_jbfy", "int").alias("n_jbfy"),
        F.get_json_object(v, "$.d_xgsj").alias("d_xgsj_text"),
        F.get_json_object(v, "$.update_time").alias("update_time"),
        F.get_json_object(v, "$.extra").alias("extra"),
        F.array_join(F.array_sort(F.json_object_keys(v)), ",").alias("json_keys"),
    )


def _bodies(records: DataFrame, copies: Column, *by: str) -> DataFrame:
    """Distinct records with all their fields and how often each occurs; equal lines are counted before any is parsed."""
    lines = records.groupBy("tableName", *by, "value").agg(copies.cast("long").alias("n"))
    return lines.groupBy("tableName", *by, _body(F.col("value")).alias("body")).agg(F.sum("n").alias("copies"))


def q_record_cols(spark, sf_dir):
    """Every record of the batch on the production path, all tables, all fields."""
    return _bodies(batch(spark, sf_dir).records(expand=False), F.sum("_cnt"))


def q_clashing_columns(spark, sf_dir):
    """A source table with columns named like the job's helpers, on the keyed and the full pull."""
    catalog = fixtures.clashing_catalog(spark, sf_dir)
    bf = plan_batch(fixtures.raw_events(spark, sf_dir), catalog, OPTS)
    keyed = bf.records(expand=False, tombstones=False)
    full = full_pull(catalog, "db_customer", "t_customer", OPTS, expand=False)
    both = keyed.withColumn("how", F.lit("keyed")).unionByName(full.withColumn("how", F.lit("full")))
    return _bodies(both, F.sum("_cnt"), "how")


def _full_records(spark, frame: DataFrame, schema: str, table: str, opts: SyncOptions) -> DataFrame:
    """Daily full pull (no key join): every row of the table as a record, before JSON encoding."""
    cat1 = FrameCatalog(spark, {(schema, table): frame})
    return full_pull(cat1, schema, table, opts, encoded=False)


def q_alias_rule(spark, sf_dir):
    frame = fixtures.xzys_frame(spark, sf_dir)
    out = []
    for dbid in ("6", "0"):
        r = _full_records(spark, frame, "db_xzys", "t_xzys", OPTS.with_(dbid=dbid))
        if "c_jbfymc" not in r.columns:
            r = r.withColumn("c_jbfymc", F.lit(None).cast("string"))
        out.append(r.select("dbid", "c_stm", "n_jbfymc", "c_jbfymc"))
    return out[0].unionByName(out[1])


def q_record_text(spark, sf_dir):
    """Text of source columns of every type, as the relational source prints them."""
    r = _full_records(spark, fixtures.typed_frame(spark, sf_dir), "db_typed", "t_typed", OPTS)
    return r.select(*[c for c in r.columns if c not in ("event_seq", "tableName", "dt", "update_time", "dbid", "lsn", "data_state")])


def q_full_pull(spark, sf_dir):
    """The daily full pull as the job writes it, read back."""
    root, opts = scratch_path(spark, "q", "full_pull"), OPTS.with_(stream_id="full")
    run_full_pull(spark, fixtures.fixture_catalog(spark, sf_dir), "db_customer", "t_customer", opts, root)
    return _settle(_bodies(warehouse.read_records(spark, root, opts), F.count(F.lit(1)), "dt"), root)


# -- index ------------------------------------------------------------------------
def q_index_gate(spark, sf_dir):
    """Gated events, the gate read from the batch's staged records as in production."""
    bf = batch(spark, sf_dir)
    root = scratch_path(spark, "q", "gate")
    staged = warehouse.stage_records(bf.record_groups(), root, OPTS, 0)
    g = idx.gate(bf.good, bf.gate_keys(staged)).filter(F.col("data_state").isin(1, 2))
    return _settle(g.select("seq", index_table(OPTS.dbid, F.col("ajzlx")).alias("index_table"), "c_stm", "data_state"), root)


def q_index_fold(spark, sf_dir):
    return idx.fold(batch(spark, sf_dir).index_events())


def q_index_merge(spark, sf_dir):
    """Fold the events below a cut into a prior index, then merge the rest as a delta."""
    bf = batch(spark, sf_dir)
    ie = _settle(bf.index_events())         # used three times: pulled once
    cut = (ie.agg(F.max("seq")).first()[0] or 0) // 2
    prior = idx.fold(ie.filter(F.col("seq") < cut))
    delta = idx.fold_delta(ie.filter(F.col("seq") >= cut))
    return idx.merge(prior, delta, broadcast_delta=small_delta(bf))


def q_index_partitioned(spark, sf_dir):
    """The index table after three batches, the middle one applied twice and the first one replayed at the end."""
    bf = batch(spark, sf_dir)
    ie = _settle(bf.index_events())
    top = ie.agg(F.max("seq")).first()[0] or 0
    root = scratch_path(spark, "q", "index")
    cuts = [-1, top // 3, 2 * top // 3, top]
    for n, again in ((0, False), (1, False), (1, True), (2, False), (0, True)):
        delta = idx.fold_delta(ie.filter((F.col("seq") > cuts[n]) & (F.col("seq") <= cuts[n + 1])))
        index_sink.apply_delta(spark, root, OPTS.dbid, delta, "w", n, 8, f"{root}/staged", again, broadcast_delta=n == 2)
    return _settle(index_sink.read_index(spark, root, OPTS.dbid), root)


def q_error_rows(spark, sf_dir):
    return batch(spark, sf_dir).errors()


# -- sinks ---------------------------------------------------------------------------
def _settle(df: DataFrame, *scratch: str) -> DataFrame:
    """Materialise a (small) result with a reliable checkpoint, then drop the query's own scratch
    output: the files it wrote are only the means, and repeated checks must not fill the disk."""
    out = df.checkpoint(eager=True)
    for p in scratch:
        delete_dir(df.sparkSession, p)
    return out


def _write(bf: BatchFrames, root: str, batch_id: int = 0) -> None:
    """The record part of process_batch: stage, write, make visible."""
    spark, o = bf.good.sparkSession, bf.opts
    staged = warehouse.stage_records(bf.record_groups(), root, o, batch_id)
    warehouse.finish(spark, root, o, batch_id, warehouse.write_records(staged, root, batch_id, o))
    warehouse.drop_staging(spark, root, o, batch_id)


def _written(spark, sf_dir, layout: str, name: str):
    opts = OPTS.with_(layout=layout)
    root = scratch_path(spark, "q", name)
    _write(batch(spark, sf_dir, opts), root)
    return root, opts


def q_end_to_end(spark, sf_dir):
    """Records per (tableName, dt) of the whole batch: the sum of the copy counts of the
    distinct records, i.e. the number of lines the writer emits."""
    r = batch(spark, sf_dir).records(expand=False)
    return r.groupBy("tableName", "dt").agg(F.sum("_cnt").alias("n_records"))


def q_json_lines(spark, sf_dir):
    """Every written record parsed back: table, date, all fields, number of lines."""
    root, opts = _written(spark, sf_dir, "single", "json_lines")
    return _settle(_bodies(warehouse.read_records(spark, root, opts, counted=True), F.sum("n"), "dt"), root)


def q_shared_record_table(spark, sf_dir):
    """A view and a table whose rows land in one record table, staged in groups of one table, written in either layout."""
    outs, roots = [], []
    for layout in ("single", "per_table"):
        o = OPTS.with_(layout=layout, write_group_tables=1)
        bf = plan_batch(fixtures.raw_events(spark, sf_dir), fixtures.shared_name_catalog(spark, sf_dir), o)
        roots.append(scratch_path(spark, "q", "shared"))
        _write(bf, roots[-1])
        recs = warehouse.read_records(spark, roots[-1], o).filter(F.col("tableName") == "db_customer_t_customerws")
        outs.append(_bodies(recs, F.count(F.lit(1))).withColumn("layout", F.lit(layout)))
    return _settle(outs[0].unionByName(outs[1]), *roots)


def q_two_shard_batches(spark, sf_dir):
    """Two shards and a restarted numbering in one warehouse: records and index rows of all of them.

    Shard 00 writes batches 0 and 1 of one stream, then batch 0 of another stream (a new checkpoint); shard 06 writes all
    events as its batch 0; then the last batch of shard 00 is retried.
    """
    raw, catalog = fixtures.raw_events(spark, sf_dir), fixtures.fixture_catalog(spark, sf_dir)
    top = raw.agg(F.max("seq")).first()[0] or 0
    part = lambda lo, hi: raw.filter((F.col("seq") > lo) & (F.col("seq") <= hi))
    root = scratch_path(spark, "q", "two_shards")
    first, second = OPTS.with_(stream_id="a"), OPTS.with_(stream_id="b")
    process_batch(spark, part(-1, top // 3), catalog, first, root, 0)
    process_batch(spark, part(top // 3, 2 * top // 3), catalog, first, root, 1)
    process_batch(spark, part(2 * top // 3, top), catalog, second, root, 0)
    process_batch(spark, raw, catalog, OPTS.with_(dbid="06"), root, 0)
    process_batch(spark, part(2 * top // 3, top), catalog, second, root, 0)
    recs = warehouse.read_records(spark, root, OPTS, counted=True)
    shard = F.split_part("writer", F.lit("-"), F.lit(1)).alias("dbid")
    records = _bodies(recs.withColumn("dbid", shard), F.sum("n"), "dbid").select(
        "dbid", F.col("tableName").alias("name"), "body", F.col("copies").alias("n"))
    index = index_sink.read_index(spark, root)
    line = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in (
        "c_stm", "d_xgsj", "c_baah", "n_jbfy", "create_time", "update_time", "data_state")])
    rows = index.select(F.substr("index_table", F.lit(7), F.lit(2)).alias("dbid"), F.col("index_table").alias("name"),
                        line.alias("body"), F.lit(1).cast("long").alias("n"))
    return _settle(records.unionByName(rows), root)


def q_bucket_counts(spark, sf_dir):
    root, opts = _written(spark, sf_dir, "per_table", "bucket_counts")
    recs = warehouse.read_records(spark, root, opts)
    files = recs.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    out = files.groupBy(warehouse.bucket_of(F.col("file"), opts).alias("bucket")).agg(F.sum("n").alias("n_records"))
    return _settle(out, root)


def q_compaction_rows(spark, sf_dir):
    """Either layout: a batch, its date compacted, a second batch; all read together."""
    raw, catalog = fixtures.raw_events(spark, sf_dir), fixtures.fixture_catalog(spark, sf_dir)
    half = (raw.agg(F.max("seq")).first()[0] or 0) // 2
    outs = []
    for layout in ("single", "per_table"):
        o = OPTS.with_(layout=layout, file_bytes=32 * 1024 * 1024)
        root = scratch_path(spark, "q", "compaction")
        for n, part in enumerate((raw.filter(F.col("seq") <= half), raw.filter(F.col("seq") > half))):
            _write(plan_batch(part, catalog, o), root, n)
            if n == 0:
                warehouse.compact(spark, root, o, FIXTURE_DT)
        lines = warehouse.read_records(spark, root, o, counted=True).groupBy("tableName", "dt", "value", "writer").agg(
            F.sum("n").alias("n"))
        found = lines.groupBy(F.lit(layout).alias("layout"), "tableName", "dt", _body(F.col("value")).alias("body")).agg(
            F.sum("n").alias("n_records"), F.countDistinct("writer").alias("n_writers"))
        outs.append(_settle(found, root))           # the files of one layout are gone before those of the next are written
    return outs[0].unionByName(outs[1])


def q_stream_index_replay(spark, sf_dir):
    """Stage the raw events as 4 files, stream them one file per micro-batch, return the final index."""
    index, _, folders = _streamed(spark, sf_dir, "stream", 4, max_files_per_trigger=1)
    return _settle(index, *folders)


def _streamed(spark, sf_dir, name: str, files: int, **intake):
    """The raw events staged as files and streamed with an intake bound; (index, batches that took events, folders)."""
    from ..streaming.stream import start_sync
    stage, out_root = scratch_path(spark, "q", f"{name}_in"), scratch_path(spark, "q", f"{name}_out")
    evsrc.stage_events(fixtures.raw_events(spark, sf_dir), stage, files=files)
    q = start_sync(spark, evsrc.file_events(spark, stage, streaming=True, **intake), fixtures.fixture_catalog(spark, sf_dir), OPTS,
                   out_root, checkpoint_location=out_root + "/_checkpoint", trigger={"availableNow": True})
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return index_sink.read_index(spark, out_root), len([p for p in q.recentProgress if p["numInputRows"]]), (stage, out_root)


def q_intake_bound(spark, sf_dir):
    """A backlog of three files streamed with a bound in bytes that one file passes: the index after all of it."""
    index, _, folders = _streamed(spark, sf_dir, "bound", 3, max_bytes_per_trigger=1)
    return _settle(index, *folders)


def q_batch_metrics(spark, sf_dir):
    """Figures of a whole written batch, observed while its events were decoded and its records staged."""
    root = scratch_path(spark, "q", "metrics")
    done = process_batch(spark, fixtures.raw_events(spark, sf_dir), fixtures.fixture_catalog(spark, sf_dir), OPTS, root, 0)
    delete_dir(spark, root)
    kinds = "kind string, name string, n long"
    return spark.createDataFrame([m for m in done["metrics"] if m[0] != "record bytes"], kinds)


QUERIES = {
    "decode_events": q_decode_events,
    "route_counts": q_route_counts,
    "quarantine": q_quarantine,
    "catalog_tables": q_catalog_tables,
    "catalog_key_shape": q_catalog_key_shape,
    "fanout": q_fanout,
    "target_names": q_target_names,
    "bucket_counts": q_bucket_counts,
    "pull_main": q_pull_main,
    "pull_child": q_pull_child,
    "pull_irregular": q_pull_irregular,
    "pull_docview": q_pull_docview,
    "tombstones": q_tombstones,
    "record_cols": q_record_cols,
    "alias_rule": q_alias_rule,
    "index_gate": q_index_gate,
    "index_fold": q_index_fold,
    "index_merge": q_index_merge,
    "error_rows": q_error_rows,
    "json_lines": q_json_lines,
    "compaction_rows": q_compaction_rows,
    "stream_index_replay": q_stream_index_replay,
    "full_pull": q_full_pull,
    "end_to_end": q_end_to_end,
    "target_names_zone": q_target_names_zone,
    "clashing_columns": q_clashing_columns,
    "shared_record_table": q_shared_record_table,
    "two_shard_batches": q_two_shard_batches,
    "pull_wide": q_pull_wide,
    "pull_bucketed": q_pull_bucketed,
    "index_partitioned": q_index_partitioned,
    "record_text": q_record_text,
    "catalog_session": q_catalog_session,
    "batch_metrics": q_batch_metrics,
    "intake_bound": q_intake_bound,
}
