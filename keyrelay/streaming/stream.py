"""Structured Streaming wiring.

The batch time is added to the *streaming* plan (``current_timestamp()`` is fixed per micro-batch and recorded in the
offset log), so a retried batch keeps its ``dt``. Each micro-batch runs ``process_batch`` under ``foreachBatch``; its outputs are
keyed by the query id of the checkpoint and ``batch_id``, so replays replace their own files and a new checkpoint, which counts
from zero again, is another writer. No watermark: the job keeps no event-time state (R1/R2).
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import SyncOptions
from ..plans.batch import process_batch


def with_batch_time(raw_stream: DataFrame, time_zone: str = "UTC") -> DataFrame:
    """Adds ``run_ts``, the wall clock of ``time_zone`` when the micro-batch was planned, whatever the session's zone is."""
    now = F.convert_timezone(F.current_timezone(), F.lit(time_zone), F.current_timestamp().cast("timestamp_ntz"))
    return raw_stream.withColumn("run_ts", now)


def start_sync(spark: SparkSession, raw_stream: DataFrame, catalog, opts: SyncOptions, out_root: str,
               checkpoint_location: str, trigger: dict | None = None, run_batch=process_batch) -> StreamingQuery:
    """Start the sync stream. ``trigger`` e.g. {"processingTime": "5 minutes"} or {"availableNow": True}.

    Without a trigger, batches follow each other as long as there are events. ``run_batch`` has process_batch's signature.
    """
    known, query = threading.Event(), []

    def each_batch(df: DataFrame, batch_id: int) -> None:
        known.wait()
        # the query id is kept in the checkpoint and survives restarts
        run_batch(spark, df, catalog, opts.with_(run_ts=None, stream_id=str(query[0].id)), out_root, batch_id)

    w = (with_batch_time(raw_stream, opts.time_zone).writeStream.foreachBatch(each_batch)
         .option("checkpointLocation", checkpoint_location))
    if trigger:
        w = w.trigger(**trigger)
    query.append(w.start())
    known.set()
    return query[0]
