"""The command line runs the stream from a properties file (file events, fixture catalogue)."""

import os
import subprocess
import sys
import tempfile

from keyrelay.config import FIXTURE_OPTIONS
from keyrelay.operators import index as idx
from keyrelay.plans.batch import plan_batch
from keyrelay.session import scratch_path
from keyrelay.sinks import index_table, warehouse
from keyrelay.sources import events as evsrc
from keyrelay.sources import fixtures

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_runs_the_stream_once(spark):
    stage = scratch_path(spark, "t", "cli_in")
    evsrc.stage_events(fixtures.raw_events(spark, SF), stage, files=2)
    work = tempfile.mkdtemp(prefix="keyrelay-cli-")
    out = os.path.join(work, "warehouse")
    props = os.path.join(work, "job.properties")
    with open(props, "w") as fh:
        fh.write(f"# test job\ndbid=00\nwarehouse.path={out}\ncheckpoint.dir={work}/chk\n")
    r = subprocess.run([sys.executable, "-m", "keyrelay", "--properties", props, "--once",
                        "--events-dir", stage, "--fixtures", SF, "--master", "local[2]"],
                       cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-2000:]
    recs = warehouse.read_records(spark, out, FIXTURE_OPTIONS).count()
    raw, cat = fixtures.raw_events(spark, SF), fixtures.fixture_catalog(spark, SF)
    assert recs == plan_batch(raw, cat, FIXTURE_OPTIONS).records().count()
    got = index_table.read_index(spark, out).drop("update_time")
    want = idx.fold(plan_batch(raw, cat, FIXTURE_OPTIONS).index_events()).drop("update_time")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def _run(props, *args, conf=()):
    return subprocess.run([sys.executable, "-m", "keyrelay", "--properties", props, *args], cwd=ROOT, capture_output=True,
                          text=True, timeout=600, env={**os.environ, "PYSPARK_SUBMIT_ARGS": " ".join([*conf, "pyspark-shell"])})


def test_cli_needs_a_checkpoint_folder():
    work = tempfile.mkdtemp(prefix="keyrelay-cli-")
    props = os.path.join(work, "job.properties")
    with open(props, "w") as fh:
        fh.write("dbid=00\n")
    r = _run(props, "--once", "--events-dir", work, "--fixtures", SF)
    assert r.returncode == 2 and "checkpoint.dir" in r.stderr


def test_options_from_properties():
    from keyrelay.__main__ import options_of
    o = options_of({"dbid": "06", "time.zone": "Asia/Shanghai", "layout": "per_table", "file.bytes": "1000",
                    "index.partitions": "7", "postgres.index.url": "jdbc:x"})
    assert (o.dbid, o.time_zone, o.layout, o.file_bytes, o.index_partitions) == ("06", "Asia/Shanghai", "per_table", 1000, 7)
    assert o.index_jdbc["staging_schema"] == "index_06"


def test_cli_full_pull_and_compaction(spark):
    work = tempfile.mkdtemp(prefix="keyrelay-cli-")
    out, props = os.path.join(work, "warehouse"), os.path.join(work, "job.properties")
    with open(props, "w") as fh:
        fh.write(f"dbid=06\nwarehouse.path={out}\ncheckpoint.dir={work}/chk\ntime.zone=Asia/Shanghai\n")
    r = _run(props, "--full-pull", "db_customer.t_customer", "--fixtures", SF, "--master", "local[2]")
    assert r.returncode == 0, r.stderr[-2000:]
    opts = FIXTURE_OPTIONS.with_(dbid="06")
    recs = warehouse.read_records(spark, out, opts)
    want = fixtures.source_frames(spark, SF)[("db_customer", "t_customer")].count()
    assert recs.count() == want
    row = recs.first()
    assert row.writer == "06-full-db_customer-t_customer"
    r = _run(props, "--compact", row.dt, "--master", "local[2]")
    assert r.returncode == 0, r.stderr[-2000:]
    recs = warehouse.read_records(spark, out, opts)
    assert recs.count() == want and recs.first().writer == f"compact-{row.dt}"


def test_session_keeps_the_deployment_settings():
    code = ("from keyrelay.session import get_session; s = get_session(); "
            "print('GOT', s.conf.get('spark.sql.shuffle.partitions'), s.sparkContext.master, "
            "s.conf.get('spark.sql.adaptive.advisoryPartitionSizeInBytes'), s.conf.get('spark.sql.adaptive.enabled'))")
    args = ("--master local[3] --conf spark.sql.shuffle.partitions=4000 "
            "--conf spark.sql.adaptive.advisoryPartitionSizeInBytes=200m pyspark-shell")
    r = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=300,
                       env={**os.environ, "PYSPARK_SUBMIT_ARGS": args})
    assert "GOT 4000 local[3] 200m true" in r.stdout, r.stdout + r.stderr[-1500:]


def test_checkpoint_folder_is_required_on_a_cluster():
    import pytest

    from keyrelay.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
