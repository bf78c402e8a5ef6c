"""The index table: existence gate (J6), fold (A2 with K4-K6) and merge with the prior state.

Per (index_table, c_stm) the original job applies, in event order:
  1 upsert      - insert, or overwrite attributes; data_state 1; create_time kept
  0 soft delete - if the row exists: data_state 0, update_time; attributes kept
  2 update      - if the row exists: overwrite attributes (NULL too); data_state 2
  other         - nothing
Before the row exists, 0 and 2 are no-ops; so the events that count are all of them
when a prior row exists, else those from the first insert on. The net effect of any
run of events is then determined by three aggregates per key:
  first_ins = min(seq, apply_ts) over state 1,
  last_ev   = max(seq, data_state, apply_ts) over all,
  last_attr = max(seq, d_xgsj, c_baah, n_jbfy) over states 1 and 2.
The last event and the last attribute event always lie at or after first_ins, so no
per-event scan is needed: the fold is one partial+final aggregation (map-side
combine, so a hot key is pre-aggregated before the shuffle) and one merge with the
prior row. Folding batch by batch equals folding everything at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import STATE_DELETE, STATE_INSERT, STATE_UPDATE
from ..functions.names import index_table, run_ts_col

INDEX_SCHEMA = T.StructType([
    T.StructField("index_table", T.StringType()),
    T.StructField("c_stm", T.StringType()),
    T.StructField("d_xgsj", T.TimestampNTZType()),
    T.StructField("c_baah", T.StringType()),
    T.StructField("n_jbfy", T.IntegerType()),
    T.StructField("create_time", T.TimestampNTZType()),
    T.StructField("update_time", T.TimestampNTZType()),
    T.StructField("data_state", T.IntegerType()),
])
INDEX_COLUMNS = [f.name for f in INDEX_SCHEMA.fields]
_KEYS = ["index_table", "c_stm"]


def gate(good_events: DataFrame, gate_keys: DataFrame) -> DataFrame:
    """Events that reach the index.

    Deletes always do; inserts and updates only when a row of the main family
    (t_{case type} or t_{case type}_...) was found for the key in this batch;
    other states never touch the index. ``gate_keys`` = (schema_name, c_stm), distinct.
    """
    base = good_events.filter(F.col("c_stm").isNotNull())
    deletes = base.filter(F.col("data_state") == STATE_DELETE)
    upserts = base.filter(F.col("data_state").isin(STATE_INSERT, STATE_UPDATE)) \
        .join(gate_keys, ["schema_name", "c_stm"], "left_semi")
    return deletes.unionByName(upserts)


def index_events(gated: DataFrame, dbid: str, apply_ts: str = "event", run_ts: str | None = None) -> DataFrame:
    use_event = apply_ts == "event" and "apply_ts" in gated.columns
    ts = F.col("apply_ts") if use_event else run_ts_col(run_ts)
    return gated.select(index_table(dbid, F.col("ajzlx")).alias("index_table"), "c_stm", "seq", "data_state",
                        "d_xgsj", "c_baah", "n_jbfy", ts.cast("timestamp_ntz").alias("apply_ts"))


def fold_delta(events: DataFrame) -> DataFrame:
    """A2: the net effect of a run of index events, one row per key (partial+final aggregation)."""
    ds = F.col("data_state")
    return events.groupBy(*_KEYS).agg(
        F.min(F.when(ds == STATE_INSERT, F.struct("seq", "apply_ts"))).alias("first_ins"),
        F.max(F.struct("seq", "data_state", "apply_ts")).alias("last_ev"),
        F.max(F.when(ds.isin(STATE_INSERT, STATE_UPDATE), F.struct("seq", "d_xgsj", "c_baah", "n_jbfy")))
         .alias("last_attr"),
    )


def applied(exists: Column, old) -> dict[str, Column]:
    """The index columns after a folded delta, where it reaches a key; ``old(name)``: a column of the row before."""
    attr = F.col("last_attr").isNotNull()
    return {"d_xgsj": F.when(attr, F.col("last_attr.d_xgsj")).otherwise(old("d_xgsj")),
            "c_baah": F.when(attr, F.col("last_attr.c_baah")).otherwise(old("c_baah")),
            "n_jbfy": F.when(attr, F.col("last_attr.n_jbfy")).otherwise(old("n_jbfy")),
            "create_time": F.when(exists, old("create_time")).otherwise(F.col("first_ins.apply_ts")),
            "update_time": F.col("last_ev.apply_ts"), "data_state": F.col("last_ev.data_state")}


def _merge_rows(prior: DataFrame, delta: DataFrame) -> DataFrame:
    p = prior.select(*_KEYS, F.struct(*INDEX_COLUMNS[2:]).alias("_p"))
    j = p.join(delta, _KEYS, "full_outer")
    exists, reached = F.col("_p").isNotNull(), F.col("last_ev").isNotNull()
    new = applied(exists, lambda c: F.col(f"_p.{c}"))
    return j.filter(exists | F.col("first_ins").isNotNull()).select(
        *_KEYS, *[F.when(reached, v).otherwise(F.col(f"_p.{c}")).alias(c) for c, v in new.items()])


def _from_delta(delta: DataFrame) -> DataFrame:
    """No prior rows: a key has a row iff it saw an insert; no join needed."""
    return delta.filter(F.col("first_ins").isNotNull()).select(
        *_KEYS,
        F.col("last_attr.d_xgsj").alias("d_xgsj"),
        F.col("last_attr.c_baah").alias("c_baah"),
        F.col("last_attr.n_jbfy").alias("n_jbfy"),
        F.col("first_ins.apply_ts").alias("create_time"),
        F.col("last_ev.apply_ts").alias("update_time"),
        F.col("last_ev.data_state").alias("data_state"),
    )


def merge(prior: DataFrame | None, delta: DataFrame, broadcast_delta: bool = False) -> DataFrame:
    """Apply a folded delta to the prior index rows.

    With a size-checked delta, the prior is never shuffled: untouched rows pass
    through a broadcast anti-join, touched rows a broadcast semi-join, and only those
    meet the delta. Otherwise one full outer sort-merge join.
    """
    if prior is None:
        return _from_delta(delta)
    prior = prior.select(*INDEX_COLUMNS)
    if not broadcast_delta:
        return _merge_rows(prior, delta)
    keys = F.broadcast(delta.select(*_KEYS))
    untouched = prior.join(keys, _KEYS, "left_anti")
    touched = prior.join(keys, _KEYS, "left_semi")
    return untouched.unionByName(_merge_rows(touched, F.broadcast(delta)))


def fold(events: DataFrame, prior: DataFrame | None = None, broadcast_delta: bool = False) -> DataFrame:
    return merge(prior, fold_delta(events), broadcast_delta)
