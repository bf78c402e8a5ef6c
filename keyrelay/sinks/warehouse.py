"""Warehouse sinks: JSON-lines records (K1), partition routing (K2), file sizing and compaction (K3), error and quarantine
tables.

A batch's distinct records are staged once (one row per record and chunk of copies), then written out in full. Every leaf
lies in partitions of its own writer and batch, which only that batch overwrites. The last job of a batch writes its rows of the
table ``batches`` (table, date, lines, bytes), a single file: readers list that table first and read the leaves it names, so
a batch is seen whole or not at all.
"""

from __future__ import annotations

import math
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SyncOptions
from ..operators.pull import copy_chunks
from ..session import delete_dir, glob_dirs, local_frame, path_exists, session_settings
from . import text_runs

_SIZES = T.StructType([T.StructField("tableName", T.StringType()), T.StructField("dt", T.StringType()),
                       T.StructField("first", T.IntegerType()), T.StructField("n_slots", T.IntegerType())])
#: What a batch wrote; ``replaces``: "writer/batch" of the batches whose leaves of this table and date a compaction stands for.
#: A batch without records has one row without a table.
BATCH_SCHEMA = T.StructType([
    T.StructField("tableName", T.StringType()), T.StructField("dt", T.StringType()), T.StructField("n_records", T.LongType()),
    T.StructField("n_bytes", T.LongType()), T.StructField("replaces", T.ArrayType(T.StringType()))])
_OWN = T.StructType([T.StructField("writer", T.StringType()), T.StructField("batch_id", T.IntegerType())])
_READ_SCHEMA = T.StructType([*BATCH_SCHEMA.fields, *_OWN.fields])
_LEAF = ["tableName", "dt", "writer", "batch_id"]
_PLACE = re.compile(r"/(?:tableName=)?([^/]+)/dt=([^/]+)/writer=([^/]+)/batch_id=([0-9]+)/[^/]+$")
_NAMES = T.StructType([T.StructField("_at", T.IntegerType()), T.StructField("file", T.StringType())])
_PLACES = T.StructType([*[T.StructField(n, T.StringType()) for n in _LEAF[:3]], _OWN["batch_id"], T.StructField("file", T.StringType())])


def records_path(root: str, opts: SyncOptions) -> str:
    return f"{root.rstrip('/')}/{opts.warehouse_db}"


def staging_path(root: str, opts: SyncOptions, batch_id: int, what: str = "") -> str:
    return f"{root.rstrip('/')}/_staging/{opts.writer}~{int(batch_id)}" + (f"/{what}" if what else "")


def _end(opts: SyncOptions, batch_id: int) -> str:
    if any(c in opts.writer for c in "/~="):
        raise ValueError(f"writer id {opts.writer!r} cannot be part of a path")
    return f"writer={opts.writer}/batch_id={int(batch_id)}"


# -- which batches there are -----------------------------------------------------
def batch_path(root: str, opts: SyncOptions, batch_id: int) -> str:
    return f"{root.rstrip('/')}/batches/{_end(opts, batch_id)}"


def begun(spark: SparkSession, root: str, opts: SyncOptions, batch_id: int) -> bool:
    """Whether an earlier attempt of this batch may have left anything behind."""
    return path_exists(spark, batch_path(root, opts, batch_id)) or path_exists(spark, staging_path(root, opts, batch_id))


def clear(spark: SparkSession, root: str, opts: SyncOptions, batch_id: int) -> None:
    """Remove what an earlier attempt of this batch wrote, whatever tables and dates it had; its visibility goes first."""
    end, root = _end(opts, batch_id), root.rstrip("/")
    delete_dir(spark, batch_path(root, opts, batch_id))
    for leaf in glob_dirs(spark, f"{records_path(root, opts)}/*/dt=*/{end}", f"{root}/errors/c_dt=*/{end}",
                          f"{root}/quarantine/dt=*/{end}"):
        delete_dir(spark, leaf)


def finish(spark: SparkSession, root: str, opts: SyncOptions, batch_id: int, rows: list[tuple]) -> None:
    """The last write of a batch: what it wrote, in one file."""
    rows = rows or [(None, None, 0, 0, [])]
    local_frame(spark, rows, BATCH_SCHEMA).coalesce(1).write.mode("overwrite").parquet(batch_path(root, opts, batch_id))


def batches(spark: SparkSession, root: str) -> DataFrame:
    """Rows of all finished batches, as of now."""
    path = f"{root.rstrip('/')}/batches"
    if not path_exists(spark, path):
        return local_frame(spark, [], _READ_SCHEMA)
    return spark.read.schema(_READ_SCHEMA).parquet(path)


def visible_leaves(done: DataFrame) -> DataFrame:
    """(tableName, dt, writer, batch_id, n_bytes) that readers see: written by a finished batch, and not replaced by another."""
    gone = done.select("tableName", "dt", F.explode("replaces").alias("_r")).select(
        "tableName", "dt", F.split_part("_r", F.lit("/"), F.lit(1)).alias("writer"),
        F.split_part("_r", F.lit("/"), F.lit(2)).cast("int").alias("batch_id"))
    return done.filter(F.col("tableName").isNotNull()).join(gone, _LEAF, "left_anti").select(*_LEAF, "n_bytes")


# -- records ---------------------------------------------------------------------
#: A slot's task writes one leaf, so it needs no sort of its full text by leaf; a task that meets more leaves sorts the rest.
_UNSORTED = {"spark.sql.maxConcurrentOutputFileWriters": "4"}


def _text_writer(df: DataFrame, opts: SyncOptions):
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if opts.max_records_per_file:
        w = w.option("maxRecordsPerFile", str(opts.max_records_per_file))
    if not opts.text_compression:
        return w
    # copies compress by two orders of magnitude at any level; the fastest one takes a fifth of the default's time on them
    return w.option("compression", opts.text_compression).option("zlib.compress.level", "BEST_SPEED")


def stage_records(groups: list[DataFrame], root: str, opts: SyncOptions, batch_id: int) -> DataFrame:
    """Distinct records of a batch with their copy counts, written once; several groups of tables are several jobs.

    The source is read here only: sizes, record files and index gate all come from the staged rows.
    """
    path = staging_path(root, opts, batch_id, "records")
    size = (F.octet_length("value") + 1).cast("long")
    groups = [g.withColumn("_bytes", size) for g in groups]
    for k, g in enumerate(groups):
        g.write.mode("append" if k else "overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return groups[0].sparkSession.read.schema(groups[0].schema).parquet(path)


def sizes_of(staged: DataFrame) -> list[tuple]:
    """(tableName, dt, lines, bytes) of the full output: one row per table and date of the batch."""
    return [tuple(r) for r in staged.groupBy("tableName", "dt").agg(
        F.sum("_cnt").alias("n"), F.sum(F.col("_cnt") * F.col("_bytes")).alias("b")).collect()]


def slots_of(sizes: list, opts: SyncOptions, parallelism: int) -> tuple[list[tuple], int]:
    """(tableName, dt, first slot, slots) from (tableName, dt, bytes): a slot is one task and one file of about the target size.

    The target is the file size, or less where that would leave cores idle.
    """
    total = sum(r[2] for r in sizes)
    target = min(opts.file_bytes, max(opts.file_bytes // 16, math.ceil(total / (2 * max(1, parallelism)))))
    out, at = [], 0
    for name, dt, size in sorted(sizes):
        n = max(1, math.ceil(size / target))
        out.append((name, dt, at, n))
        at += n
    return out, at


def dealt(staged: DataFrame, opts: SyncOptions, sizes: list[tuple] | None = None) -> tuple[DataFrame, list[tuple]]:
    """Staged rows (tableName, dt, seq, c_stm, value, _cnt, _c) dealt to slots sized by the bytes of their copies.

    A record's chunks of copies are dealt apart.
    """
    spark = staged.sparkSession
    sizes = [(t, d, b) for t, d, _, b in (sizes_of(staged) if sizes is None else sizes)]
    slots, total = slots_of(sizes, opts, spark.sparkContext.defaultParallelism)
    at = F.col("first") + F.pmod(F.xxhash64("value", "seq", "c_stm", "_c"), F.col("n_slots")).cast("int")
    rows = (staged.select("value", "tableName", "dt", "seq", "c_stm", "_cnt", "_c")
            .join(F.broadcast(local_frame(spark, slots, _SIZES)), ["tableName", "dt"])      # one row per table and date
            .withColumn("_slot", at))
    return rows.repartitionById(max(1, total), "_slot"), slots


#: Bytes up to which copies of a record are written as one text of several lines.
BLOCK_BYTES = 1 << 16


def _blocks(rows: DataFrame, opts: SyncOptions, *columns: str | Column) -> DataFrame:
    """Every record as often as ``_cnt`` says, copies joined by line ends into texts of about BLOCK_BYTES; then ``columns``.

    Files hold the same lines as with one row per copy. With ``max_records_per_file`` Spark's writer counts rows, so a row is a line.
    """
    per = F.lit(1).cast("long")
    if not opts.max_records_per_file:
        per = F.greatest(per, F.floor(F.lit(BLOCK_BYTES) / (F.octet_length("value") + 1)))
    rows = rows.withColumn("_per", per)
    last = F.floor((F.col("_cnt") - 1) / F.col("_per")).cast("long")
    rows = rows.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    more = (F.least(F.col("_per"), F.col("_cnt") - F.col("_block") * F.col("_per")) - 1).cast("int")
    return rows.select(F.concat(F.repeat(F.concat("value", F.lit("\n")), more), "value").alias("value"), *columns)


def write_records(staged: DataFrame, root: str, batch_id: int, opts: SyncOptions) -> list[tuple]:
    """K1/K2: one JSON object per line, UTF-8, every record as often as its copy count says. Returns the batch's rows.

    ``single``: {db}/tableName=T/dt=D/writer=W/batch_id=N/part-*.txt in one job.
    ``per_table``: {db}/T/dt=D/writer=W/batch_id=N/part-*.txt, the original directory shape, one job per table straight
    into its folder (no renames), several tables at a time.
    """
    path, sizes = records_path(root, opts), sizes_of(staged)
    rows = [(name, dt, int(n), int(b), []) for name, dt, n, b in sizes]
    if not sizes:
        return rows
    own = [F.lit(opts.writer).alias("writer"), F.lit(int(batch_id)).alias("batch_id")]
    if opts.layout != "per_table":
        full = _blocks(dealt(staged, opts, sizes)[0], opts, "tableName", "dt", *own)
        with session_settings(staged.sparkSession, _UNSORTED):
            _text_writer(full, opts).partitionBy(*_LEAF).text(path)
        return rows

    def one(name: str) -> None:
        part = dealt(staged.filter(F.col("tableName") == name), opts, [s for s in sizes if s[0] == name])[0]
        _text_writer(_blocks(part, opts, "dt", *own), opts).partitionBy(*_LEAF[1:]).text(f"{path}/{name}")

    with session_settings(staged.sparkSession, _UNSORTED), ThreadPoolExecutor(8) as pool:
        list(pool.map(one, sorted({s[0] for s in sizes})))
    return rows


#: Gzip files are read as runs where the files have at most this many bytes of text: a file's content is one value then.
RUN_FILE_BYTES = 1 << 28
#: File names with and without the suffix of gzip, as path filters.
_GZIP, _OTHER = "*.gz", "*{[!z],[!g]z,[!.]gz}"


def _counted(lines: DataFrame, path: str | list[str], opts: SyncOptions) -> DataFrame:
    """(value, file, n) of ``lines``, the text of ``path``: equal lines that follow each other in a gzip file are one row with
    their number, any other line is a row of its own."""
    spark, files = lines.sparkSession, lines.inputFiles()
    one_by_one = lambda df: df.select("value", F.input_file_name().alias("file"), F.lit(1).cast("long").alias("n"))
    packed = [f for f in files if f.endswith(".gz")]
    if not packed or opts.file_bytes > RUN_FILE_BYTES:
        return one_by_one(lines)
    names = F.broadcast(local_frame(spark, list(enumerate(packed)), _NAMES))
    content = (spark.read.format("binaryFile").option("pathGlobFilter", _GZIP).load(path)
               .select("content", F.input_file_name().alias("file")).join(names, "file").select("_at", "content"))
    found = content.mapInArrow(text_runs.runs, text_runs.RUNS).join(names, "_at").select(
        F.col("_line").cast("string").alias("value"), "file", "n")
    if len(packed) == len(files):
        return found
    return found.unionByName(one_by_one(spark.read.option("pathGlobFilter", _OTHER).text(path)))


def read_records(spark: SparkSession, root: str, opts: SyncOptions, dt: str | None = None, counted: bool = False) -> DataFrame:
    """Records of finished batches as (value, tableName, dt, writer, batch_id, file), one row per line.

    With ``counted`` a row stands for ``n`` equal lines of a file (column ``n`` behind ``value``), so that copies that lie together
    are one row; lines that do not lie together may come in several rows.

    The finished batches are listed before the files, so each of them has all its files in the second list; batches that finish
    in between are not seen.
    """
    done, path = batches(spark, root), records_path(root, opts)
    glob = f"{path}/*/dt={dt or '*'}/writer=*/batch_id=*"
    if not glob_dirs(spark, f"{path}/*/dt={dt or '*'}"):
        columns = [T.StructField("value", T.StringType()), *([T.StructField("n", T.LongType())] if counted else [])]
        return local_frame(spark, [], T.StructType([*columns, *_PLACES.fields]))
    lines = spark.read.text(glob)
    # the place is taken from the path, which reads both layouts alike: once per listed file, not once per line
    found = [(f, _PLACE.search(f)) for f in lines.inputFiles()]
    places = local_frame(spark, [(*m.group(1, 2, 3), int(m[4]), f) for f, m in found if m], _PLACES).join(
        visible_leaves(done).drop("n_bytes"), _LEAF, "left_semi")
    if counted:
        return _counted(lines, glob, opts).join(F.broadcast(places), "file").select("value", "n", *_LEAF, "file")
    return (lines.select("value", F.input_file_name().alias("file")).join(F.broadcast(places), "file")
            .select("value", *_LEAF, "file"))


def bucket_of(file_col, opts: SyncOptions):
    """K2: the bucket directory {db}/{tableName}/dt={dt} a record file lives in."""
    db = opts.warehouse_db.replace(".", r"\.")
    return F.regexp_extract(file_col, rf"({db}/[^/]+/dt=[^/]+)/", 1)


def _table_dir(name: str, opts: SyncOptions) -> str:
    return name if opts.layout == "per_table" else f"tableName={name}"


def compact(spark: SparkSession, root: str, opts: SyncOptions, dt: str, run: int = 0) -> int:
    """K3: rewrite the leaves of one closed date into files of about ``opts.file_bytes`` bytes.

    The output is a batch of the writer ``compact-{date}``, so it can be read next to live batches and compacted again. Its rows
    in ``batches`` name the leaves they replace: with that one file the new leaves appear and the old ones disappear for
    readers; the old files are deleted afterwards, here or, if this run ends early, by the next one. ``run`` numbers repeated
    compactions of a date. Returns the leaves replaced.
    """
    own = opts.with_(dbid="compact", stream_id=dt)
    drop_replaced(spark, root, opts, dt)
    if path_exists(spark, batch_path(root, own, run)):
        return 0                                            # this run is complete
    clear(spark, root, own, run)
    found = visible_leaves(batches(spark, root)).filter(F.col("dt") == dt).collect()       # one row per table and batch
    if not found:
        return 0
    leaves: dict[str, list] = {}
    for r in found:
        leaves.setdefault(r["tableName"], []).append(r)
    top = records_path(root, opts)

    def one(name: str) -> tuple:
        at = f"{top}/{_table_dir(name, opts)}/dt={dt}"
        paths = [f"{at}/writer={r['writer']}/batch_id={r['batch_id']}" for r in leaves[name]]
        rows = _counted(spark.read.text(paths), paths, opts)
        size = sum(r["n_bytes"] for r in leaves[name])
        # equal lines travel as one row with their number, in chunks dealt to the new files
        counted = copy_chunks(rows.groupBy("value").agg(F.sum("n").alias("_n")))
        files = max(1, math.ceil(size / opts.file_bytes))
        dealt_rows = counted.repartitionById(files, F.pmod(F.xxhash64("value", "_c"), F.lit(files)).cast("int"))
        _text_writer(_blocks(dealt_rows, opts), opts).text(f"{at}/{_end(own, run)}")
        return name, dt, None, size, [f"{r['writer']}/{r['batch_id']}" for r in leaves[name]]

    with ThreadPoolExecutor(8) as pool:
        rows = list(pool.map(one, sorted(leaves)))
    finish(spark, root, own, run, rows)
    drop_replaced(spark, root, opts, dt)
    return len(found)


def drop_replaced(spark: SparkSession, root: str, opts: SyncOptions, dt: str) -> None:
    """Delete the files that finished compactions of a date stand for."""
    top = records_path(root, opts)
    rows = (batches(spark, root).filter((F.col("dt") == dt) & (F.size("replaces") > 0))
            .select("tableName", F.explode("replaces").alias("r")).collect())
    for name, old in rows:
        writer, batch_id = old.rsplit("/", 1)
        delete_dir(spark, f"{top}/{_table_dir(name, opts)}/dt={dt}/writer={writer}/batch_id={batch_id}")


def write_table(df: DataFrame, path: str, partition_cols: list[str]) -> None:
    """Table (errors, quarantine) whose partitions include writer and batch, which only that batch overwrites.

    Rebalanced by the partition columns so a batch writes a few advisory-sized files per partition.
    """
    (df.hint("rebalance", *partition_cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(path))


def drop_staging(spark: SparkSession, root: str, opts: SyncOptions, batch_id: int) -> None:
    delete_dir(spark, staging_path(root, opts, batch_id))
