"""Command line: run the sync stream, a full pull or a compaction from a properties file.

    python -m keyrelay --properties job.properties [--once] [--events-dir DIR] [--fixtures SF_DIR]
    python -m keyrelay --properties job.properties --full-pull SCHEMA.TABLE
    python -m keyrelay --properties job.properties --compact YYYY-MM-DD [--run N]

Keys (one ``key=value`` per line, ``#`` comments), as in the original job: dbid, warehouse.path (default /warehouse), checkpoint.dir
(required), kafka.server, kafka.topic, kafka.input.groupId, postgres.url, postgres.username, postgres.password. Further keys, all
optional: postgres.index.url / .username / .password (relational index and error log, instead of Parquet),
postgres.staging.schema (for key lists too long for IN), time.zone, layout,
multiplicity, apply.ts, text.compression, file.bytes, index.partitions, write.group.tables, broadcast.key.limit,
broadcast.byte.limit, pushdown.key.limit, source.text (database or spark), kafka.max.offsets, events.max.bytes,
kafka.starting.offsets, trigger.interval (default: batches follow each other), source.catalog=spark with source.database.prefix
(source tables registered in Spark's catalogue instead of a database).
``--events-dir`` reads events from files (columns seq, value, apply_ts) instead of Kafka; ``--fixtures`` uses the test-table
catalogue instead of the database; ``--once`` processes what is available and stops. Master and Spark settings are the
deployment's (spark-submit); ``--master`` is for local runs.
"""

from __future__ import annotations

import argparse
from datetime import datetime
from zoneinfo import ZoneInfo

from .config import SyncOptions
from .plans.batch import run_full_pull
from .session import get_session
from .sinks import warehouse
from .sources import events as evsrc
from .streaming.stream import start_sync

#: property -> (option, type)
OPTIONS = {"dbid": ("dbid", str), "time.zone": ("time_zone", str), "layout": ("layout", str), "multiplicity": ("multiplicity", str),
           "apply.ts": ("apply_ts", str), "text.compression": ("text_compression", str), "file.bytes": ("file_bytes", int),
           "index.partitions": ("index_partitions", int), "write.group.tables": ("write_group_tables", int),
           "broadcast.key.limit": ("broadcast_key_limit", int), "broadcast.byte.limit": ("broadcast_byte_limit", int), "pushdown.key.limit": ("pushdown_key_limit", int),
           "source.text": ("source_text", str)}


def read_properties(path: str) -> dict:
    out = {}
    with open(path, encoding="utf-8") as fh:
        for line in fh:
            line = line.strip()
            if not line or line.startswith(("#", "!")) or "=" not in line:
                continue
            k, v = line.split("=", 1)
            out[k.strip()] = v.strip()
    return out


def options_of(p: dict) -> SyncOptions:
    found = {name: kind(p[key]) for key, (name, kind) in OPTIONS.items() if p.get(key)}
    if p.get("postgres.index.url"):
        found["index_jdbc"] = {
            "url": p["postgres.index.url"], "staging_schema": f"index_{p.get('dbid', '00')}",
            "props": {"user": p.get("postgres.index.username", ""), "password": p.get("postgres.index.password", ""),
                      "driver": "org.postgresql.Driver"}}
    return SyncOptions(**found)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="keyrelay")
    ap.add_argument("--properties", required=True)
    ap.add_argument("--once", action="store_true")
    ap.add_argument("--events-dir")
    ap.add_argument("--fixtures")
    ap.add_argument("--full-pull", metavar="SCHEMA.TABLE")
    ap.add_argument("--compact", metavar="DATE")
    ap.add_argument("--run", type=int, default=0)
    ap.add_argument("--master")
    a = ap.parse_args(argv)
    p = read_properties(a.properties)
    if not p.get("checkpoint.dir"):
        ap.error("the properties file has no checkpoint.dir")
    checkpoints, root = p["checkpoint.dir"].rstrip("/"), p.get("warehouse.path", "/warehouse")
    spark = get_session(master=a.master, checkpoint_fallback=f"{checkpoints}/spark")   # the session's own setting wins
    opts = options_of(p)
    if a.compact:
        warehouse.compact(spark, root, opts, a.compact, a.run)
        return 0
    if a.fixtures:
        from .sources.fixtures import fixture_catalog
        catalog = fixture_catalog(spark, a.fixtures)
    elif p.get("source.catalog") == "spark":
        from .sources.session_catalog import SessionCatalog
        catalog = SessionCatalog(spark, p.get("source.database.prefix", ""))
    else:
        from .sources.jdbc import JdbcCatalog
        catalog = JdbcCatalog(spark, p["postgres.url"], {"user": p.get("postgres.username", ""),
                                                         "password": p.get("postgres.password", ""),
                                                         "driver": "org.postgresql.Driver"},
                              staging_schema=p.get("postgres.staging.schema") or None)
    if a.full_pull:
        now = datetime.now(ZoneInfo(opts.time_zone)).strftime("%Y-%m-%d %H:%M:%S")
        schema, table = a.full_pull.split(".", 1)
        run_full_pull(spark, catalog, schema, table, opts.with_(run_ts=now, stream_id=f"full-{schema}-{table}"), root, a.run)
        return 0
    if a.events_dir:
        most = int(p["events.max.bytes"]) if p.get("events.max.bytes") else None
        raw = evsrc.file_events(spark, a.events_dir, streaming=True, max_files_per_trigger=None if most else 1,
                                max_bytes_per_trigger=most)
    else:
        opt = {"kafka.group.id": p["kafka.input.groupId"]} if p.get("kafka.input.groupId") else {}
        most = int(p["kafka.max.offsets"]) if p.get("kafka.max.offsets") else None
        raw = evsrc.kafka_events(spark, p["kafka.server"], p["kafka.topic"], max_offsets_per_trigger=most, options=opt,
                                 starting_offsets=p.get("kafka.starting.offsets", "earliest"), time_zone=opts.time_zone)
    trigger = {"availableNow": True} if a.once else (
        {"processingTime": p["trigger.interval"]} if p.get("trigger.interval") else None)
    q = start_sync(spark, raw, catalog, opts, root, f"{checkpoints}/keyrelay-sync-{opts.dbid}", trigger)
    q.awaitTermination()
    return 0 if q.exception() is None else 1


if __name__ == "__main__":
    raise SystemExit(main())
