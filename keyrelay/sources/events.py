"""Change-event sources (S1), batch and streaming.

Every source yields ``(seq BIGINT, value STRING, apply_ts TIMESTAMP_NTZ)``:
``seq`` orders events of a key, ``value`` is the JSON text, ``apply_ts`` is the
record time (Kafka timestamp). The Kafka reader needs the spark-sql-kafka package on
the classpath; it is not installed here, so the tested source is a file directory
with the same columns, read through the same function signature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("value", T.StringType()),
    T.StructField("apply_ts", T.TimestampNTZType()),
])

# Kafka offsets are unique only within a partition; an order across partitions is
# meaningless, and only the order within a key matters. Producers key by c_stm, so
# all events of a key sit in one partition and (partition, offset) packs into one long.
_PARTITION_SHIFT = 44


def kafka_events(spark: SparkSession, servers: str, topic: str, streaming: bool = True,
                 starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None,
                 options: dict | None = None, time_zone: str = "UTC") -> DataFrame:
    """Events of a topic; ``apply_ts`` is the record time on the wall clock of ``time_zone``.

    A batch takes all there is unless ``max_offsets_per_trigger`` bounds it; use a bound with back-to-back triggers only, or a
    busy topic falls behind.
    """
    reader = spark.readStream if streaming else spark.read
    r = (reader.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if streaming and max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    df = r.load()
    return df.select(
        (F.shiftleft(F.col("partition").cast("long"), _PARTITION_SHIFT) + F.col("offset")).alias("seq"),
        F.col("value").cast("string").alias("value"),
        F.convert_timezone(F.current_timezone(), F.lit(time_zone), F.col("timestamp").cast("timestamp_ntz")).alias("apply_ts"),
    )


def file_events(spark: SparkSession, path: str, streaming: bool = False, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Events staged as files with RAW_SCHEMA columns.

    A streaming batch takes all files there are, unless one of the two bounds is set (R8); with a bound in bytes it takes files until
    the bound is passed, at least one.
    """
    if max_files_per_trigger and max_bytes_per_trigger:
        raise ValueError("bound the intake by files or by bytes, not by both")
    if streaming:
        r = spark.readStream.schema(RAW_SCHEMA).format(fmt)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        if max_bytes_per_trigger:
            r = r.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
        return r.load(path)
    return spark.read.schema(RAW_SCHEMA).format(fmt).load(path)


def stage_events(raw: DataFrame, path: str, files: int) -> str:
    """Write raw events as ``files`` consecutive seq ranges, one append each, oldest first.

    A file stream picks files up by modification time, so the ranges are written one
    after another: micro-batches then see events in seq order, as a keyed Kafka topic
    delivers them.
    """
    lo, hi = raw.agg(F.min("seq"), F.max("seq")).first()
    if lo is None:
        raw.filter(F.lit(False)).write.mode("overwrite").parquet(path)
        return path
    step = (hi - lo) // files + 1
    for i in range(files):
        part = raw.filter((F.col("seq") >= lo + i * step) & (F.col("seq") < lo + (i + 1) * step))
        part.repartition(1).sortWithinPartitions("seq").write.mode("append").parquet(path)
    return path
