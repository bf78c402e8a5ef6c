"""Benchmark: headline sync queries over $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries": {name: sec}, "sf"}.
Each query is run to completion with the ``noop`` sink (full plan, nothing collected);
``sync_batch`` runs the whole written batch: JSON-lines records, errors, quarantine and
the index version.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from keyrelay.config import FIXTURE_OPTIONS  # noqa: E402
from keyrelay.plans import registry  # noqa: E402
from keyrelay.plans.batch import process_batch  # noqa: E402
from keyrelay.session import delete_dir, get_session, scratch_path  # noqa: E402
from keyrelay.sources import fixtures  # noqa: E402

HEADLINE = ["end_to_end", "index_fold", "index_merge", "error_rows", "pull_child", "tombstones", "decode_events"]


WARM_DIR = "/root/testdata/sf0.001"


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus),
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    # warm-up: JVM and codegen, on another scale; the cache is cleared after each query, so each pays for its own decoding
    run_noop(registry.q_route_counts(spark, WARM_DIR))
    run_noop(registry.q_end_to_end(spark, WARM_DIR))
    spark.catalog.clearCache()
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        run_noop(registry.QUERIES[name](spark, sf_dir))
        times[name] = round(time.time() - t0, 3)
        spark.catalog.clearCache()
    t0 = time.time()
    root = scratch_path(spark, "bench")
    process_batch(spark, fixtures.raw_events(spark, sf_dir), fixtures.fixture_catalog(spark, sf_dir),
                  FIXTURE_OPTIONS, root, 0)
    times["sync_batch"] = round(time.time() - t0, 3)
    delete_dir(spark, root)        # the bench's own output (GBs of JSON lines at sf0.1); nothing else
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({"metric": "sync_wall_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
