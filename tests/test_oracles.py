"""Every registered query against its DuckDB oracle at sf0.001 (the driver runs sf0.01)."""

import pytest

import __spark_entry__ as entry
from tools.check_oracle import check

SF = "/root/testdata/sf0.001"
FAST = ["decode_events", "route_counts", "quarantine", "catalog_tables", "catalog_key_shape", "fanout",
        "target_names", "pull_main", "pull_child", "pull_irregular", "pull_docview", "tombstones",
        "record_cols", "alias_rule", "index_gate", "index_fold", "index_merge", "error_rows", "full_pull",
        "end_to_end", "json_lines", "bucket_counts", "compaction_rows", "stream_index_replay", "target_names_zone",
        "clashing_columns", "shared_record_table", "two_shard_batches", "pull_wide", "pull_bucketed", "index_partitioned",
        "record_text", "catalog_session", "batch_metrics", "intake_bound"]


def test_registry_covers_every_query():
    from keyrelay.plans import oracles, registry
    assert set(registry.QUERIES) == set(oracles.oracle_sql()) == set(FAST)
    assert set(entry.queries()) >= set(FAST) and set(entry.oracle_sql()) >= set(FAST)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, name):
    res = check(spark, SF, [name])[name]
    assert res["ok"], res


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["tableName", "dt", "n_records"]
    assert df.count() > 0
