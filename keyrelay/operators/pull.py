"""Keyed pulls (S2-S4, J1-J3) and record frames.

For each table the events of its schema are reduced to the key side of one join
with the table - one scan of the source per batch instead of one query per event
and table. ``per_event`` keeps the original multiplicity (an event of a key
receives every matching row, so k events give k copies); ``latest`` keeps one copy
per key, tagged with the key's last ``seq``.

Join strategy, decided from per-batch counts measured before planning:
* events of the schema within the broadcast limits (rows and bytes): broadcast the events themselves;
  the source is scanned once, filtered map-side, and no shuffle happens at all;
* distinct keys within them: broadcast distinct keys, then join the (small) pulled
  rows back to the events with a shuffle join;
* otherwise shuffle both sides on the key; AQE splits skewed partitions. The keys are a written
  table then, from which Spark builds a Bloom filter that thins out the source ahead of its shuffle; a
  source bucketed by the key is not shuffled at all.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SyncOptions
from ..functions.records import record_fields, record_value
from ..functions.sqltext import row_texts
from ..sources.catalog import KEY
from .catalog_ops import TablePlan


class KeyStats(NamedTuple):
    """Of a schema's pull events: their number, a bound on their distinct keys, and the bytes of their keys."""

    n_events: int
    n_keys: int
    key_bytes: int


@dataclass(frozen=True)
class KeySide:
    """The events whose keys a schema's tables are asked for."""

    schema: str
    pull_events: DataFrame
    stats: KeyStats
    values: list | None = None          # the distinct keys, if they are few enough for a scan's filter
    counted: DataFrame | None = None    # else: a written table of counted keys (KEY, seq, _n)

    def events(self) -> DataFrame:
        """Pull-path events with a usable key (a NULL key matches nothing)."""
        return self.pull_events.filter((F.col("schema_name") == self.schema) & F.col("c_stm").isNotNull())

    def counts(self, multiplicity: str) -> DataFrame:
        return self.counted if self.counted is not None else counted_keys(self.events(), multiplicity)

    def small(self, rows: int, opts: SyncOptions) -> bool:
        """Whether a key side of so many rows may be broadcast; its texts are at most those of the events."""
        return rows <= opts.broadcast_key_limit and self.stats.key_bytes + 16 * rows <= opts.broadcast_byte_limit


def counted_keys(events: DataFrame, multiplicity: str, *by: str) -> DataFrame:
    """(by, KEY, seq, _n): distinct keys, their last event and number of copies (a partial aggregate)."""
    n = F.count(F.lit(1)) if multiplicity != "latest" else F.lit(1).cast("long")
    return events.filter(F.col("c_stm").isNotNull()).groupBy(*by, F.col("c_stm").alias(KEY)).agg(
        F.max("seq").alias("seq"), n.alias("_n"))


def pulled_rows(catalog, plan: TablePlan, side: KeySide, opts: SyncOptions, columns: list[str] | None = None,
                row: Column | None = None) -> DataFrame:
    """Source rows matched to events: the row as struct ``_row``, ``_k`` (event key) and ``seq``.

    ``row``: what to keep of the struct instead of it, computed once per source row where its copies are made by a later join.
    """
    n_events, n_keys, _ = side.stats

    def pull(keys: DataFrame, rows: int) -> DataFrame:
        found = catalog.pull(plan.source_schema, plan.table, plan.key_column, keys, broadcast_keys=side.small(rows, opts),
                             columns=columns, key_values=side.values)
        return found if row is None else found.withColumn("_row", row)

    if opts.multiplicity == "latest":
        return pull(side.counts("latest").select(KEY, "seq"), n_keys)
    if side.small(n_events, opts):
        return pull(side.events().select(F.col("c_stm").alias(KEY), "seq"), n_events)
    rows = pull(side.counts(opts.multiplicity).select(KEY), n_keys)
    return rows.join(side.events().select(F.col("c_stm").alias(KEY), "seq"), KEY)


#: Copies of a record that stay together; the writer deals the chunks of a hot key to different tasks.
COPY_CHUNK = 1_000


def pulled_row_copies(catalog, plan: TablePlan, side: KeySide, opts: SyncOptions, columns: list[str] | None = None,
                      chunk: int = COPY_CHUNK) -> DataFrame:
    """Source rows with a copy count ``_cnt`` instead of one row per event (record path).

    The key side is ``(key, _n)``: the events of a key are counted. After the join a count above ``chunk`` is split into
    several rows ``(_c, _cnt)``, so no row is replicated more than ``chunk`` times by one expression; ``_c`` stays
    with the record, so the writer can deal the chunks apart. Each pulled row's record is
    built once per chunk, not once per event. ``seq`` is the key's last event.
    """
    rows = catalog.pull(plan.source_schema, plan.table, plan.key_column, side.counts(opts.multiplicity).select(KEY, "seq", "_n"),
                        broadcast_keys=side.small(side.stats.n_keys, opts), columns=columns, key_values=side.values)
    return copy_chunks(rows, chunk)


def copy_chunks(rows: DataFrame, chunk: int = COPY_CHUNK) -> DataFrame:
    """Rows with a number of copies ``_n`` as chunks ``(_c, _cnt)`` of at most ``chunk`` copies."""
    last_chunk = F.floor((F.col("_n") - 1) / F.lit(chunk)).cast("long")
    return (rows.withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)))
            .withColumn("_cnt", F.least(F.lit(chunk).cast("long"), F.col("_n") - F.col("_c") * chunk)).drop("_n"))


def replicate(df: DataFrame) -> DataFrame:
    """Expand ``_cnt`` into that many identical rows (the per-event copies)."""
    return df.withColumn("_rep", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_cnt")))) \
             .drop("_rep", "_cnt", "_c")


def matched_keys(catalog, plan: TablePlan, side: KeySide, opts: SyncOptions) -> DataFrame:
    """Distinct event keys that have at least one row in the table (reads the key column only)."""
    rows = catalog.pull(plan.source_schema, plan.table, plan.key_column, side.counts(opts.multiplicity).select(KEY),
                        broadcast_keys=side.small(side.stats.n_keys, opts), columns=[plan.key_column], key_values=side.values)
    return rows.select(KEY).distinct()


def record_frame(rows: DataFrame, plan: TablePlan, source_columns: list[str], opts: SyncOptions,
                 expand: bool = True) -> DataFrame:
    """Common record frame: (tableName, dt, seq, c_stm, schema_name, main_family, value).

    With ``expand=False`` a ``_cnt`` column is kept instead of the copies (the writer
    expands them after its shuffle, so the exchange carries each row once).
    """
    fields = record_fields(source_columns, plan.source_schema, plan.table, plan.record_table,
                           opts.dbid, opts.run_ts, row_texts(rows, opts.source_text, opts.time_zone), opts.alias_rules)
    extra = [c for c in ("_cnt", "_c") if c in rows.columns]
    out = rows.select(
        F.lit(plan.record_table).alias("tableName"),
        F.date_format(F.lit(opts.run_ts).cast("timestamp_ntz"), "yyyy-MM-dd").alias("dt"),
        F.col("seq"),
        F.col(KEY).alias("c_stm"),
        F.lit(plan.event_schema).alias("schema_name"),
        F.lit(plan.main_family and plan.kind == "table").alias("main_family"),
        record_value(fields).alias("value"),
        *extra,
    )
    return replicate(out) if extra and expand else out


def record_columns(rows: DataFrame, plan: TablePlan, source_columns: list[str], opts: SyncOptions) -> DataFrame:
    """The record's named columns before JSON encoding, plus ``event_seq`` (used by tests/oracles)."""
    fields = record_fields(source_columns, plan.source_schema, plan.table, plan.record_table,
                           opts.dbid, opts.run_ts, row_texts(rows, opts.source_text, opts.time_zone), opts.alias_rules)
    return rows.select(F.col("seq").alias("event_seq"), *fields)


def full_pull(catalog, schema: str, table: str, opts: SyncOptions, encoded: bool = True,
              expand: bool = True) -> DataFrame:
    """Daily full pull of a table whose rows cannot be reached by key (no key join).

    Same record rules as the keyed path; ``encoded=False`` returns the named record
    columns before JSON encoding. One scan of the table, no shuffle.
    """
    plan = TablePlan(schema, schema, table, "", "table", "", True, True, False, f"{schema}_{table}")
    cols = catalog.column_names(schema, table)
    rows = catalog.frame(schema, table).select(
        F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"), F.lit(None).cast("long").alias("seq"),
        F.lit(None).cast("string").alias(KEY), F.lit(1).cast("long").alias("_cnt"), F.lit(0).cast("long").alias("_c"))
    if not encoded:
        return record_columns(rows, plan, cols, opts)
    return record_frame(rows, plan, cols, opts, expand)
