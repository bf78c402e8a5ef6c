"""Record files read as runs of equal lines: the same lines as one by one, in few rows."""

import gzip
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from keyrelay.config import FIXTURE_OPTIONS
from keyrelay.operators.pull import copy_chunks
from keyrelay.plans import registry
from keyrelay.session import scratch_path
from keyrelay.sinks import text_runs, warehouse

DT = "2024-02-01"


def _runs_of(data: bytes) -> list:
    lines = re.split(b"\r\n|\r|\n", data)
    return [(k, len(list(g))) for k, g in itertools.groupby(lines if lines[-1] else lines[:-1])]


@pytest.mark.parametrize("chunk", [1, 2, 7, 64, 1 << 20])
def test_runs_are_the_lines(monkeypatch, chunk):
    monkeypatch.setattr(text_runs, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(text_runs, "STEP_BYTES", 20)
    rnd = random.Random(chunk)
    for _ in range(150):
        data = b"".join(rnd.choice([b"", b"a", b"aa", b"ab", b"b\xff", b"a\xc3"]) * rnd.choice([1, 1, 9])
                        + rnd.choice([b"\n", b"\n", b"\r", b"\r\n"]) for _ in range(rnd.randrange(9)))
        data = data * rnd.choice([1, 1, 2, 67]) + rnd.choice([b"", b"a\n" * 200, b"last", b"a"])
        cut = rnd.randrange(len(data) + 1)
        for packed in (gzip.compress(data), gzip.compress(data[:cut]) + gzip.compress(data[cut:])):
            assert list(text_runs.line_runs(text_runs.inflated(packed))) == _runs_of(data)


def test_a_file_that_ends_early_is_an_error():
    with pytest.raises(EOFError):
        list(text_runs.line_runs(text_runs.inflated(gzip.compress(b"a\n" * 1000)[:-5])))


def _staged(spark):
    """5,000 copies of a record of db_a_t_a, three of one of db_a_t_b and one of another."""
    rows = [("db_a_t_a", DT, 1, "k", "{\"a\":\"é\"}", 5000), ("db_a_t_b", DT, 2, "l", "{}", 3), ("db_a_t_b", DT, 3, "m", "{\"b\":1}", 1)]
    frame = spark.createDataFrame(rows, "tableName string, dt string, seq long, c_stm string, value string, _n long")
    return copy_chunks(frame).withColumn("_bytes", (F.octet_length("value") + 1).cast("long"))


@pytest.mark.parametrize("layout", ["single", "per_table"])
def test_counted_records(spark, layout, monkeypatch):
    """Gzip files give one row per run, plain ones and such as may be too large one per line; all of them the same lines."""
    o = FIXTURE_OPTIONS.with_(layout=layout)
    root, staged = scratch_path(spark, "t", "counted"), _staged(spark)
    assert warehouse.read_records(spark, root, o, counted=True).columns == ["value", "n", *warehouse._LEAF, "file"]
    held, writer = [], warehouse._text_writer

    def seen(df, opts):
        held.append(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"))
        return writer(df, opts)

    monkeypatch.setattr(warehouse, "_text_writer", seen)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    warehouse.finish(spark, root, o, 0, warehouse.write_records(staged, root, 0, o))
    assert set(held) == {"4"} and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before

    def lines(df):
        return {(r.tableName, r.value): r.n for r in df.groupBy("tableName", "value").agg(F.sum("n").alias("n")).collect()}

    once = {("db_a_t_a", "{\"a\":\"é\"}"): 5000, ("db_a_t_b", "{}"): 3, ("db_a_t_b", "{\"b\":1}"): 1}
    one = lambda: warehouse.read_records(spark, root, o).withColumn("n", F.lit(1))
    counted = warehouse.read_records(spark, root, o, counted=True)
    assert lines(counted) == lines(one()) == once and counted.count() <= 7       # five chunks of copies at most, and two records
    plain = o.with_(text_compression=None)
    warehouse.finish(spark, root, plain, 1, warehouse.write_records(staged, root, 1, plain))
    both = warehouse.read_records(spark, root, o, counted=True)
    twice = {k: 2 * n for k, n in once.items()}
    assert lines(both) == lines(one()) == twice and both.count() <= 7 + 5004
    large = warehouse.read_records(spark, root, o.with_(file_bytes=warehouse.RUN_FILE_BYTES + 1), counted=True)
    assert lines(large) == twice and large.count() == 2 * 5004
    assert warehouse.compact(spark, root, o, DT) == 4
    after = warehouse.read_records(spark, root, o, counted=True)
    assert lines(after) == lines(one()) == twice and after.count() <= 13


class _Asked(Exception):
    pass


@pytest.mark.parametrize("name", ["json_lines", "compaction_rows", "two_shard_batches"])
def test_queries_read_runs(spark, name, monkeypatch):
    """The queries that count the lines of all files ask for runs (the reading itself is in the oracle gate)."""
    def asked(*_, counted=False, **__):
        raise _Asked(counted)

    for part in ("_write", "process_batch", "plan_batch", "batch"):
        monkeypatch.setattr(registry, part, lambda *_, **__: None)
    monkeypatch.setattr(warehouse, "compact", lambda *_, **__: 0)
    monkeypatch.setattr(warehouse, "read_records", asked)
    with pytest.raises(_Asked) as e:
        registry.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert e.value.args == (True,)
