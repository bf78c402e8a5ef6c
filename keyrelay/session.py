"""Session construction and the shared scratch location."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Pulls with more keys than go into a scan's filter: Bloom filters of the keys thin out sources from this size on,
    # for every table of a staging job.
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "256m",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "67108864",
    "spark.sql.optimizer.runtimeFilter.number.threshold": "200",
}


def get_session(master: str | None = None, app: str = "keyrelay", shuffle_partitions: int | None = None,
                extra: dict | None = None, checkpoint_fallback: str | None = None) -> SparkSession:
    """A session with this package's settings where the deployment has none.

    What spark-submit, spark-defaults.conf or PYSPARK_SUBMIT_ARGS set stays as it is, master and shuffle partitions
    included; only values passed here explicitly (tests, the bench) win over it. Without any master the session is local.
    """
    SparkContext._ensure_initialized()          # so that SparkConf holds what the deployment set
    given = SparkConf()
    conf = {k: v for k, v in DEFAULT_CONF.items() if not given.contains(k)}
    if master or not given.contains("spark.master"):
        conf["spark.master"] = master or "local[*]"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    spark = SparkSession.builder.appName(app).config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, checkpoint_fallback)
    return spark


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]):
    """Runtime settings that hold for the work started inside, as they were before afterwards."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def session_with(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session beside ``spark`` with its settings and these, which hold for the frames made in it whenever they are run."""
    own = spark.newSession()
    for k, v in {**spark.conf.getAll, **settings}.items():
        if own.conf.isModifiable(k):
            own.conf.set(k, v)
    return own


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster this is set by the deployment and is only read here. When it is unset, ``fallback`` (e.g. the job's own
    shared checkpoint path) is used. Only a local session may fall back to a private folder of this machine.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None) or fallback
    if not conf:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir is not set: a shared folder is needed on a cluster")
        conf = tempfile.mkdtemp(prefix="keyrelay-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder (never machine-local on a cluster)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, "keyrelay", *parts, uuid.uuid4().hex[:12]])


def path_exists(spark: SparkSession, p: str) -> bool:
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(p)
    fs = hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hp))


def list_dirs(spark: SparkSession, p: str) -> list[str]:
    """Names of the sub-directories of ``p`` (Hadoop FileSystem: works on HDFS/S3/local)."""
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(p)
    fs = hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hp):
        return []
    return [s.getPath().getName() for s in fs.listStatus(hp) if s.isDirectory()]


def _fs(spark: SparkSession, p: str):
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(p)
    return hp, hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_dir(spark: SparkSession, p: str) -> None:
    hp, fs = _fs(spark, p)
    if fs.exists(hp):
        fs.delete(hp, True)


def glob_dirs(spark: SparkSession, *patterns: str) -> list[str]:
    """Folders that match path patterns, on any file system Spark knows."""
    out = []
    for p in patterns:
        hp, fs = _fs(spark, p)
        out += [x.getPath().toString() for x in (fs.globStatus(hp) or []) if x.isDirectory()]
    return out


def local_frame(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Small driver-side data (catalogue metadata) as a local relation.

    Unlike a frame over a list of rows (an RDD scan of unknown size), a frame over an Arrow table is a local relation with
    known statistics, so the planner broadcasts it and joins with it need no shuffle.
    """
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [()] * len(schema.fields)
    data = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(data, schema=schema)
