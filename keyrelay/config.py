"""Options and the fixed values the sync job must share with the system it replaces."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values. These must equal the original job's names and rules for the
# output to be interchangeable; they are stated here once, in plain text.
# ---------------------------------------------------------------------------
KEY_COLUMN = "c_stm"                    # business key of a case
KEY_LIKE = "c_stm%"                     # catalogue pattern for key-like columns
TABLE_LIKE = "t_%"                      # catalogue pattern for pulled tables
MAIN_TABLE_PREFIX = "t_"                # main table is t_{case type}
VIEW_SCHEMA = "db_fyygx"                # schema holding the document views
VIEW_PREFIX = "v_"                      # document view is v_{case type}
VIEW_RECORD_SUFFIX = "ws"               # view rows land in {schema}_t_{case type}ws
INDEX_SCHEMA_PREFIX = "index_"          # index table is index_{dbid}.t_{case type}_index
INDEX_TABLE_SUFFIX = "_index"
WAREHOUSE_DB = "db_ods15.db"            # warehouse directory of the record files
ERROR_JOB_MODE = "increment"            # job_mode column of error rows
DATE_FORMAT = "yyyy-MM-dd"              # dt partition value
# Metadata keys written into every record; they win over source columns of the same name.
META_KEYS = ("tableName", "dt", "update_time", "dbid", "lsn", "data_state")
# Event fields (all decoded as text first, then typed).
EVENT_FIELDS = ("c_stm", "d_xgsj", "data_state", "c_baah", "n_jbfy", "schemaName")
# Shard-specific column alias: for dbid 6 or 22, table db_xzys.t_xzys, a non-null
# n_jbfymc is also written as c_jbfymc.
ALIAS_RULES = (
    # (dbids, schema, table, from_column, to_column)
    (("6", "22"), "db_xzys", "t_xzys", "n_jbfymc", "c_jbfymc"),
)
# Index operations by data_state.
STATE_DELETE, STATE_INSERT, STATE_UPDATE = 0, 1, 2


@dataclass(frozen=True)
class SyncOptions:
    """Per-job settings. Everything that varies between shards or runs lives here."""

    dbid: str = "00"
    # Tells apart the streams and backfills of a shard that write to one warehouse; a stream gets the
    # query id of its checkpoint, which survives restarts. Part of every output path.
    stream_id: str = "batch"
    # Zone whose wall clock gives the batch time (dt, update_time) and event times.
    time_zone: str = "UTC"
    # Batch time as 'yyyy-MM-dd HH:mm:ss[.ffffff]'. Streaming batches take it from the
    # micro-batch timestamp; fixtures pin it so results are reproducible.
    run_ts: str | None = None
    # "per_event": one copy of a pulled row per event of its key (original behaviour);
    # "latest": one copy per key and batch.
    multiplicity: str = "per_event"
    # Index time source: "event" uses the event's own apply_ts column (Kafka timestamp,
    # or the fixture's event time); "batch" uses run_ts, like the index database's NOW().
    apply_ts: str = "event"
    # A key side is broadcast only when its distinct-key count, measured per batch,
    # is at most this; otherwise the join shuffles (AQE handles skewed keys).
    broadcast_key_limit: int = 1_000_000
    # ... and when the bytes of these keys (or of the events behind them) are at most this.
    broadcast_byte_limit: int = 128 * 1024 * 1024
    # Up to this many distinct keys per table and batch are also pushed into the
    # source scan as an IN list (Parquet row-group / bucket pruning, JDBC IN chunks).
    pushdown_key_limit: int = 10_000
    # Catalogue frames are broadcast only under this many rows.
    broadcast_catalog_limit: int = 100_000
    # Warehouse layout: "single" = one write partitioned by tableName/dt/writer/batch_id;
    # "per_table" = {db}/{tableName}/dt=.../writer=.../batch_id=... one write per table.
    layout: str = "single"
    warehouse_db: str = WAREHOUSE_DB
    max_records_per_file: int | None = None
    # Bytes a record file should have; compaction uses the same size.
    file_bytes: int = 122 * 1024 * 1024
    # Codec of the JSON-lines files ("gzip", "zstd", ...); None keeps plain UTF-8 text as the
    # original sink writes. The copies of a record lie one after another, so a codec cuts the written
    # volume by far more than the number of copies; readers see the same lines.
    text_compression: str | None = "gzip"
    # Tables per staging job: hundreds of tables are staged in groups instead of one very wide union plan.
    write_group_tables: int = 50
    # Hash partitions of the index table; a table keeps the number it was made with.
    index_partitions: int = 64
    # How source columns that are not text become text: "database" = as the relational source prints
    # them (functions/sqltext.py), "spark" = Spark's cast.
    source_text: str = "database"
    alias_rules: tuple = field(default=ALIAS_RULES)
    # Relational index table instead of the Parquet one: {"url", "props", "staging_schema"}.
    index_jdbc: dict | None = None

    @property
    def writer(self) -> str:
        return f"{self.dbid}-{self.stream_id}"

    def with_(self, **kw) -> "SyncOptions":
        return replace(self, **kw)


# Constants shared by every fixture query and its SQL oracle.
FIXTURE_DBID = "00"
FIXTURE_RUN_TS = "2024-02-01 00:00:00"
FIXTURE_DT = "2024-02-01"
FIXTURE_OPTIONS = SyncOptions(dbid=FIXTURE_DBID, run_ts=FIXTURE_RUN_TS)
