r"""One batch of change events, end to end.

    raw (seq, value, apply_ts) --decode--> good | quarantine
    good --F1--> deletes -> tombstones ------------------------------\
         \--> pull events --J4/S5/S6--> per-table plans               +--U1--> records --K1/K2--> warehouse
                           --S2-S4/J1-J3--> pulled rows -> records --/
                           --Q15/F5--> error rows
    records(main family) --J6--> gate; deletes + gated upserts --A2--> delta --J7--> index partitions

``plan_batch`` builds the DataFrames lazily after a few small metadata actions (per-schema
counts of events, keys and their bytes in one aggregate, the catalogue, bounded key lists for scan
push-down); ``process_batch`` runs and writes them, and takes the counts from figures observed while the decoded events
are written.
"""

from __future__ import annotations

import logging
import math
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import STATE_DELETE, SyncOptions
from ..functions.decode import REASONS, decode_events
from ..functions.names import dt_value, tombstone_table
from ..functions.records import decoded_event_map, tombstone_value
from ..operators import errors as err
from ..operators import index as idx
from ..operators.catalog_ops import TablePlan, table_plans
from ..operators.pull import (KeySide, KeyStats, counted_keys, full_pull, matched_keys, pulled_row_copies, pulled_rows,
                              record_frame)
from ..session import scratch_path
from ..sinks import index_table, warehouse

RECORD_COLUMNS = ["tableName", "dt", "seq", "c_stm", "schema_name", "main_family", "value"]
log = logging.getLogger("keyrelay")


@dataclass
class BatchFrames:
    decoded: DataFrame
    good: DataFrame
    quarantine: DataFrame
    deletes: DataFrame
    pull_events: DataFrame
    stats: dict            # schema_name -> KeyStats of its pull events
    plans: list            # list[TablePlan]
    opts: SyncOptions
    catalog: object
    n_deletes: int = 0
    n_bytes: int = 0       # of the events' text
    key_path: str | None = None     # where the keys of wide schemas are written; a scratch folder if unset
    _values: dict = None
    _wide: DataFrame = None

    def side(self, schema: str) -> KeySide:
        """The key side of a schema's pulls."""
        st = self.stats.get(schema, KeyStats(0, 0, 0))
        values = self.values(schema)
        return KeySide(schema, self.pull_events, st, values, self.wide_keys(schema) if values is None else None)

    def wide_keys(self, schema: str) -> DataFrame | None:
        """Counted keys of a schema with more keys than go into a scan's filter, from a table written once per batch.

        A filtered scan is what Spark builds its runtime Bloom filter from, which then thins out the source before its shuffle.
        """
        o = self.opts
        wide = sorted(s for s, st in self.stats.items() if st.n_keys > o.pushdown_key_limit)
        if schema not in wide:
            return None
        if self._wide is None:
            spark = self.good.sparkSession
            path = self.key_path or scratch_path(spark, "keys")
            keys = counted_keys(self.pull_events.filter(F.col("schema_name").isin(wide)), o.multiplicity, "schema_name")
            keys.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
            self._wide = spark.read.schema(keys.schema).parquet(path)
        return self._wide.filter(F.col("schema_name") == schema).drop("schema_name")

    def values(self, schema: str) -> list[str] | None:
        """Distinct keys of a schema for scan push-down (bounded by pushdown_key_limit).

        Collected for all small schemas of the batch in one job, then cached.
        """
        if self._values is None:
            small = [s for s, st in self.stats.items() if st.n_keys <= self.opts.pushdown_key_limit]
            self._values = {s: None for s in self.stats}
            if small:
                rows = (self.pull_events.filter(F.col("schema_name").isin(small) & F.col("c_stm").isNotNull())
                        .select("schema_name", "c_stm").distinct().collect())
                for s in small:
                    self._values[s] = []
                for r in rows:
                    self._values[r.schema_name].append(r.c_stm)
                for s in small:
                    self._values[s].sort()
        return self._values.get(schema)

    # -- lazily built outputs --
    def tombstones(self) -> DataFrame:
        o = self.opts
        tname = tombstone_table(F.col("schema_name"), F.col("ajzlx"))
        return self.deletes.select(
            tname.alias("tableName"), dt_value(o.run_ts).alias("dt"), "seq", "c_stm", "schema_name",
            F.lit(False).alias("main_family"),
            tombstone_value(F.col("value"), tname, o.run_ts, o.dbid,
                            decoded_event_map(F.col("c_stm"), F.col("d_xgsj_text"), F.col("c_baah"), F.col("n_jbfy"),
                                              F.col("schema_name"))).alias("value"))

    def pulled(self, plan: TablePlan, columns: list[str] | None = None, row: Column | None = None) -> DataFrame:
        return pulled_rows(self.catalog, plan, self.side(plan.event_schema), self.opts, columns, row)

    def source_columns(self, plan: TablePlan) -> list[str]:
        return self.catalog.column_names(plan.source_schema, plan.table)

    def record_plans(self) -> list[TablePlan]:
        return [p for p in self.plans if p.key_present and p.routable]

    def table_records(self, plan: TablePlan, expand: bool = True) -> DataFrame:
        """Records of one table: each pulled row's JSON is built once, then copied per event."""
        rows = pulled_row_copies(self.catalog, plan, self.side(plan.event_schema), self.opts, self.source_columns(plan))
        return record_frame(rows, plan, self.source_columns(plan), self.opts, expand)

    def pulled_records(self, expand: bool = True) -> DataFrame | None:
        frames = [self.table_records(p, expand) for p in self.record_plans()]
        return reduce(DataFrame.unionByName, frames) if frames else None

    def records(self, expand: bool = True, plans: list[TablePlan] | None = None,
                tombstones: bool = True) -> DataFrame:
        """Tombstones and all pulled records in the common record frame.

        ``expand=False`` keeps one row per distinct record and chunk of copies, with the copy count ``_cnt`` and chunk
        number ``_c``. ``plans``/``tombstones`` restrict the frame to a group of tables.
        """
        frames = [self.table_records(p, expand) for p in (self.record_plans() if plans is None else plans)]
        if tombstones or not frames:
            t = self.tombstones()
            frames.insert(0, t if expand else t.withColumns({"_cnt": F.lit(1).cast("long"), "_c": F.lit(0).cast("long")}))
        return reduce(DataFrame.unionByName, frames)

    def record_groups(self) -> list[DataFrame]:
        """The records to be staged, in groups of ``write_group_tables`` tables; the first group has the tombstones.

        Groups are appended to one staged table, so several may hold records of the same target table.
        """
        plans, g = self.record_plans(), max(1, self.opts.write_group_tables)
        chunks = [plans[i:i + g] for i in range(0, len(plans), g)] or [[]]
        return [self.records(expand=False, plans=c, tombstones=(i == 0)).select(*RECORD_COLUMNS, "_cnt", "_c")
                for i, c in enumerate(chunks)]

    def errors(self) -> DataFrame:
        o = self.opts
        frames = []
        for p in self.plans:
            if p.kind != "table":
                continue  # a failing view query is only logged (no error row)
            if not p.key_present:
                frames.append(err.missing_key_errors(self.pull_events, p, o.dbid, o.run_ts))
            elif not p.routable:
                m = matched_keys(self.catalog, p, self.side(p.event_schema), o)
                frames.append(err.unroutable_errors(self.pull_events, p, m, o.dbid, o.run_ts))
        if not frames:
            return err.empty_errors(self.good.sparkSession)
        return reduce(DataFrame.unionByName, frames)

    def gate_keys(self, records: DataFrame | None = None) -> DataFrame:
        """(schema_name, c_stm) of events that found a main-family row.

        ``records``: a record frame, in production the batch's staged records; without it the main-family tables are pulled.
        """
        if records is None:
            frames = [self.table_records(p, expand=False) for p in self.record_plans()
                      if p.main_family and p.kind == "table"]
            if not frames:
                return self.good.sparkSession.createDataFrame([], "schema_name string, c_stm string")
            records = reduce(DataFrame.unionByName, frames)
        keys = records.filter(F.col("main_family") & F.col("c_stm").isNotNull())
        return keys.select("schema_name", "c_stm").distinct()

    def index_events(self, records: DataFrame | None = None) -> DataFrame:
        gated = idx.gate(self.good, self.gate_keys(records))
        return idx.index_events(gated, self.opts.dbid, self.opts.apply_ts, self.opts.run_ts)


#: Distinct keys are estimated by a sketch of this relative error; the bound used is three times that above the estimate.
KEY_ERROR = 0.02


def _keys_at_most(estimate: int, n_events: int) -> int:
    return min(n_events, math.ceil(estimate * (1 + 3 * KEY_ERROR)))


def _figures() -> dict[str, Column]:
    """Counts of good events that decide a plan, for use in one aggregate."""
    pull = F.col("data_state") != STATE_DELETE
    return {"n": F.count(F.when(pull, 1)), "deletes": F.count(F.when(~pull, 1)),
            "keys": F.approx_count_distinct(F.when(pull, F.col("c_stm")), KEY_ERROR),
            "key_bytes": F.sum(F.when(pull, F.octet_length("c_stm"))), "bytes": F.sum(F.octet_length("value"))}


def event_stats(good: DataFrame, known: tuple[list[str], list[str]]) -> tuple[dict, int, int]:
    """Per schema the figures of its pull path, the number of deletes, and the bytes of all good events: one aggregate.

    ``known``: schemas and case types of the catalogue. Only their counts reach the driver (one row per schema), whatever
    schema names the events carry; an event of an unknown schema pulls nothing.
    """
    leads = F.col("schema_name").isin(known[0]) | F.col("ajzlx").isin(known[1])
    name = F.when(leads, F.col("schema_name")).alias("schema_name")
    rows = good.groupBy(name).agg(*[v.alias(k) for k, v in _figures().items()]).collect()
    return _stats(((r["schema_name"], r.asDict()) for r in rows))


def _stats(rows) -> tuple[dict, int, int]:
    out, deletes, size = {}, 0, 0
    for name, r in rows:
        deletes, size = deletes + int(r["deletes"]), size + int(r["bytes"] or 0)
        if name is not None and r["n"]:
            out[name] = KeyStats(int(r["n"]), _keys_at_most(int(r["keys"]), int(r["n"])), int(r["key_bytes"] or 0))
    return out, deletes, size


class Intake:
    """Decoded events written to the batch's staging folder, and what was observed in passing.

    The figures (routes and keys per schema of the catalogue, reasons, bytes) come from the same pass that decodes and writes,
    so no counting job runs, and what follows reads the written events: a lost executor decodes nothing again. Only if events
    name a schema that is known by its document view alone, one more aggregate runs over the written events.
    """

    def __init__(self, raw: DataFrame, path: str, known: tuple[list[str], list[str]]):
        decoded, seen = decode_events(raw), Observation()
        self.known, good = known, F.col("reason").isNull()
        figures = {"events": F.count(F.lit(1)), "text_bytes": F.sum(F.octet_length("value"))}
        figures |= {f"reason {r}": F.count(F.when(F.col("reason") == r, 1)) for r in REASONS}
        if "run_ts" in raw.columns:
            figures["run_ts"] = F.max("run_ts").cast("string")
        places = {name: F.col("schema_name") == name for name in known[0]}
        unknown = ~F.coalesce(F.col("schema_name").isin(known[0]), F.lit(False))
        places[None] = unknown
        figures["by view"] = F.count(F.when(good & unknown & F.col("ajzlx").isin(known[1]), 1))
        for k, place in enumerate(places.values()):
            here = good & place
            pull, state = here & (F.col("data_state") != STATE_DELETE), F.col("data_state")
            figures |= {f"n {k}": F.count(F.when(pull, 1)), f"deletes {k}": F.count(F.when(here & (state == STATE_DELETE), 1)),
                        f"keys {k}": F.approx_count_distinct(F.when(pull, F.col("c_stm")), KEY_ERROR),
                        f"key_bytes {k}": F.sum(F.when(pull, F.octet_length("c_stm"))),
                        f"bytes {k}": F.sum(F.when(here, F.octet_length("value")))}
        observed = decoded.observe(seen, *[v.alias(n) for n, v in figures.items()])
        observed.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        self.figures, self.names = seen.get, list(places)
        self.events = raw.sparkSession.read.schema(decoded.schema).parquet(path)

    def stats(self) -> tuple[dict, int, int]:
        if self.figures["by view"]:
            return event_stats(self.events.filter(F.col("reason").isNull()), self.known)
        rows = [(name, {f: self.figures[f"{f} {k}"] for f in _figures()}) for k, name in enumerate(self.names)]
        return _stats(rows)

    def metrics(self) -> list[tuple[str, str, int]]:
        """(kind, name, figure): events and bytes taken in, events by reason, and by schema and route."""
        out = [("events", "taken in", self.figures["events"]), ("bytes", "taken in", self.figures["text_bytes"] or 0)]
        out += [("reason", r, self.figures[f"reason {r}"]) for r in REASONS]
        for k, name in enumerate(self.names):
            out += [("pull", name or "", self.figures[f"n {k}"]), ("tombstone", name or "", self.figures[f"deletes {k}"])]
        return [(kind, name, int(n)) for kind, name, n in out if n]


def plan_batch(raw: DataFrame, catalog, opts: SyncOptions, persist: bool = False, intake: Intake | None = None) -> BatchFrames:
    """Plan one batch. ``persist`` keeps the decoded events cached for the many jobs of the batch; with an ``intake`` they are
    read from where it wrote them."""
    if opts.run_ts is None:
        raise ValueError("opts.run_ts must be set (process_batch takes it from the batch)")
    if intake:
        decoded = intake.events.drop("run_ts")
    else:
        decoded = decode_events(raw)
        if persist:
            decoded = decoded.persist(StorageLevel.MEMORY_AND_DISK)
    good = decoded.filter(F.col("reason").isNull())
    quarantine = decoded.filter(F.col("reason").isNotNull())
    deletes = good.filter(F.col("data_state") == STATE_DELETE)
    pull_events = good.filter(F.col("data_state") != STATE_DELETE)
    stats, n_deletes, n_bytes = intake.stats() if intake else event_stats(good, catalog.known())
    if hasattr(catalog, "refresh"):
        catalog.refresh(sorted(stats))          # the catalogue is re-read every batch, never cached for ever
    plans = table_plans(catalog.tables(), catalog.columns(), sorted(stats)) if stats else []
    for p in plans:
        if p.kind == "view" and not p.key_present:   # logged only, no error row (as the original)
            log.warning("document view %s.%s has no column %s; skipped", p.source_schema, p.table, p.key_column)
    return BatchFrames(decoded, good, quarantine, deletes, pull_events, stats, plans, opts, catalog, n_deletes, n_bytes)


def process_batch(spark: SparkSession, raw: DataFrame, catalog, opts: SyncOptions, out_root: str,
                  batch_id: int) -> dict:
    """Run one batch and write all outputs; safe to re-run for the same writer and ``batch_id``.

    Order: stage the decoded events -> stage the records -> remove an earlier attempt's leaves -> record files, errors, quarantine ->
    index partitions -> the batch's rows of ``batches``, which make it visible. The staged records are the one read of the source;
    record files and index gate both come from them, and the lineage ends there: a lost executor later on recomputes nothing
    upstream.
    """
    if hasattr(catalog, "begin"):
        catalog.begin(f"{opts.writer}~{int(batch_id)}")
    try:
        return _process(spark, raw, catalog, opts, out_root.rstrip("/"), batch_id)
    finally:
        if hasattr(catalog, "release"):
            catalog.release()


def _process(spark: SparkSession, raw: DataFrame, catalog, opts: SyncOptions, root: str, batch_id: int) -> dict:
    again = warehouse.begun(spark, root, opts, batch_id)
    stage = lambda what: warehouse.staging_path(root, opts, batch_id, what)
    intake = Intake(raw, stage("events"), catalog.known())
    if opts.run_ts is None:
        if "run_ts" not in raw.columns:
            raise ValueError("raw batch has no run_ts column and opts.run_ts is unset")
        if intake.figures["run_ts"] is None:
            warehouse.drop_staging(spark, root, opts, batch_id)
            return {"batch_id": batch_id, "empty": True}
        opts = opts.with_(run_ts=intake.figures["run_ts"])
    bf = plan_batch(raw, catalog, opts, intake=intake)
    bf.key_path = stage("keys")
    staged = warehouse.stage_records(bf.record_groups(), root, opts, batch_id)
    if again:
        warehouse.clear(spark, root, opts, batch_id)
    rows = warehouse.write_records(staged, root, batch_id, opts)
    own = {"writer": F.lit(opts.writer), "batch_id": F.lit(int(batch_id))}
    errors = bf.errors()
    warehouse.write_table(errors.withColumns(own), f"{root}/errors", ["c_dt", "writer", "batch_id"])
    q = bf.quarantine.select("seq", "value", "reason", dt_value(opts.run_ts).alias("dt")).withColumns(own)
    warehouse.write_table(q, f"{root}/quarantine", ["dt", "writer", "batch_id"])
    # one row per touched key, used several times below: computed once
    delta = idx.fold_delta(bf.index_events(staged)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if opts.index_jdbc:
            _index_to_database(spark, delta, errors, bf, opts, batch_id)
        else:
            index_table.apply_delta(spark, root, opts.dbid, delta, opts.writer, batch_id, opts.index_partitions, stage("index"),
                                    again, small_delta(bf))
    finally:
        delta.unpersist()
    warehouse.finish(spark, root, opts, batch_id, rows)
    warehouse.drop_staging(spark, root, opts, batch_id)
    written = [("records", t, n) for t, _, n, _, _ in rows] + [("record bytes", t, b) for t, _, _, b, _ in rows]
    return {"batch_id": batch_id, "empty": False, "run_ts": opts.run_ts, "metrics": intake.metrics() + written}


def run_full_pull(spark: SparkSession, catalog, schema: str, table: str, opts: SyncOptions, out_root: str,
                  batch_id: int = 0) -> None:
    """Write every row of a table as records, keyed and made visible like a batch; a repeated run replaces its own files."""
    root = out_root.rstrip("/")
    again = warehouse.begun(spark, root, opts, batch_id)
    frame = full_pull(catalog, schema, table, opts, expand=False).select(*RECORD_COLUMNS, "_cnt", "_c")
    staged = warehouse.stage_records([frame], root, opts, batch_id)
    if again:
        warehouse.clear(spark, root, opts, batch_id)
    warehouse.finish(spark, root, opts, batch_id, warehouse.write_records(staged, root, batch_id, opts))
    warehouse.drop_staging(spark, root, opts, batch_id)


def small_delta(bf: BatchFrames) -> bool:
    """Whether the folded delta may be broadcast: keys and bytes are bounded by those of the batch's events."""
    o, n = bf.opts, sum(st.n_keys for st in bf.stats.values()) + bf.n_deletes
    return n <= o.broadcast_key_limit and bf.n_bytes <= o.broadcast_byte_limit


def _index_to_database(spark: SparkSession, delta: DataFrame, errors: DataFrame, bf: BatchFrames, opts: SyncOptions,
                       batch_id: int) -> None:
    from ..sinks import jdbc_index
    j = opts.index_jdbc
    n = sum(st.n_keys for st in bf.stats.values()) + bf.n_deletes
    values = sorted({r.c_stm for r in delta.select("c_stm").collect()}) if n <= opts.pushdown_key_limit else None
    jdbc_index.apply_delta(spark, delta, j["url"], j["props"], f"{opts.writer}~{int(batch_id)}", j["staging_schema"],
                           values, broadcast_delta=small_delta(bf))
    jdbc_index.append_errors(spark, errors, j["url"], j["props"], f"{opts.writer}~{int(batch_id)}", j["staging_schema"])
