"""Print the physical plans of the key operators at a scale factor (only the staged records of the write are run).

usage: python tools/show_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from keyrelay.operators import index as idx  # noqa: E402
from keyrelay.plans import registry  # noqa: E402
from keyrelay.plans.batch import plan_batch  # noqa: E402
from keyrelay.session import delete_dir, get_session, scratch_path, session_settings  # noqa: E402
from keyrelay.sinks import warehouse  # noqa: E402
from keyrelay.sources import fixtures  # noqa: E402


def plan_text(df) -> str:
    p = df._jdf.queryExecution().executedPlan().toString()
    p = re.sub(r"#\d+L?", "", p)                       # expression ids
    p = re.sub(r"\[plan_id=\d+\]", "", p)
    p = re.sub(r"Location: [^,]+,", "Location: …,", p)
    lines = [ln[:150] for ln in p.splitlines()]
    return "\n".join(lines)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(shuffle_partitions=8)
    bf = registry.batch(spark, sf)
    li = next(p for p in bf.record_plans() if p.table == "t_lineitem")
    root = scratch_path(spark, "plans")
    staged = warehouse.stage_records(bf.record_groups(), root, bf.opts, 0)
    write = (warehouse.dealt(staged, bf.opts)[0]
             .withColumn("_rep", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_cnt"))))
             .select("value", "tableName", "dt"))
    catalog, databases, tables = registry._registered(spark, sf, "plans")
    with session_settings(spark, registry.WIDE_SETTINGS):
        wide_batch = registry.batch(spark, sf, registry.WIDE)
        wide = wide_batch.table_records(li, expand=False)
        registered = plan_batch(fixtures.raw_events(spark, sf), catalog, registry.WIDE)
        bucketed = registered.table_records(li, expand=False)
        texts = {id(df): plan_text(df) for df in (wide, bucketed)}      # planned under these settings
    sections = [
        ("Keyed pull of one table (t_lineitem): pruned scan, broadcast of per-key event counts, no shuffle of the source",
         bf.table_records(li, expand=False)),
        ("The same pull with more keys than any limit: Bloom filter on the source, join by the key's own type", wide),
        ("The same pull from a table bucketed by its key: no exchange on the source side", bucketed),
        ("Record write: staged distinct records dealt to slots sized by their copies' bytes, copies made after it", write),
        ("Index fold: partial + final aggregation over (index_table, c_stm)", idx.fold(bf.index_events())),
        ("Error rows", bf.errors()),
    ]
    print(f"# Physical plans at {os.path.basename(sf)}\n")
    print("Generated by `python tools/show_plans.py`; expression ids removed, long lines cut.\n")
    for title, df in sections:
        print(f"## {title}\n\n```\n{texts.get(id(df)) or plan_text(df)}\n```\n")
    delete_dir(spark, root)
    registry._unregister(spark, databases, tables)


if __name__ == "__main__":
    main()
