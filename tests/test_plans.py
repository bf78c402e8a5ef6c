"""Plan checks: no Python on the data path, one scan per source table, pruning and broadcast choices."""

import re

from keyrelay.config import FIXTURE_OPTIONS
from keyrelay.plans import registry

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs_in_any_query_plan(spark):
    for name in ("end_to_end", "index_fold", "error_rows", "tombstones", "pull_child", "decode_events"):
        p = _plan(registry.QUERIES[name](spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_each_source_table_scanned_once_in_records(spark):
    bf = registry.batch(spark, SF)
    scans = re.findall(r"sf0\.001/(\w+)\.parquet", _plan(bf.pulled_records()))
    for t in ("customer", "orders", "labels", "documents", "supplier", "lineitem"):
        assert scans.count(t) == 1, (t, scans)


def test_pull_prunes_columns_and_broadcasts_checked_keys(spark):
    bf = registry.batch(spark, SF)
    plan = next(p for p in bf.record_plans() if p.table == "t_lineitem")
    df = bf.pulled(plan, columns=bf.source_columns(plan))
    p = _plan(df)
    assert "BroadcastHashJoin" in p                       # event side measured under the limit
    assert "PushedFilters: [In(l_suppkey" in p            # the keys reach the scan in the column's own type
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_linenumber:int,l_returnflag:string," \
           "l_linestatus:string>" in p.replace("\n", "")
    # with Spark's own size-based broadcast off, only the measured-count check decides
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in _plan(registry.batch(spark, SF).pulled(plan))
        big = registry.batch(spark, SF, FIXTURE_OPTIONS.with_(broadcast_key_limit=0))
        p2 = _plan(big.pulled(plan))
        assert "BroadcastHashJoin" not in p2 and "SortMergeJoin" in p2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_fold_is_partial_aggregation(spark):
    p = _plan(registry.QUERIES["index_fold"](spark, SF))
    assert "partial_min" in p and "partial_max" in p


def test_integer_keys_match_their_plain_text_only(spark):
    from keyrelay.sources.catalog import key_filter
    df = spark.createDataFrame([(1,), (-7,), (0,), (12,)], "k int")
    got = {r.k for r in df.filter(key_filter(df, "k", ["1", "-7", "0", "012", " 12", "1.0", "x", "99999999999", "-0"])).collect()}
    assert got == {1, -7, 0}
    assert df.filter(key_filter(df, "k", ["x"])).count() == 0


def test_fanout_counts_before_the_join(spark):
    from pyspark.sql import functions as F
    p = registry.QUERIES["fanout"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert p.index("Join") < p.index("Aggregate")         # the join stands above the count


def _nodes(plan):
    """All nodes of an executed plan, through adaptive stages."""
    yield plan
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        yield from _nodes(plan.executedPlan())
    elif name.endswith("QueryStageExec"):
        yield from _nodes(plan.plan())
    children = plan.children()
    for k in range(children.size()):
        yield from _nodes(children.apply(k))


def test_wide_pull_filters_the_source_before_its_shuffle(spark):
    """More keys than any limit: a Bloom filter on the source side, and few rows beyond the matches are shuffled."""
    from keyrelay.session import session_settings
    with session_settings(spark, registry.WIDE_SETTINGS):
        bf = registry.batch(spark, SF, registry.WIDE)
        for table, column in (("t_lineitem", "l_suppkey"), ("t_customer_order", "o_custkey")):
            plan = next(p for p in bf.record_plans() if p.table == table)
            df = bf.table_records(plan, expand=False)
            text = _plan(df)
            assert "might_contain" in text and "bloom_filter_agg" in text and "SortMergeJoin" in text
            assert f"cast({column}" not in text                     # the source joins by its own type
            matches = df.count()
            rows = df._jdf.queryExecution().executedPlan()
            df.collect()
            shuffled = [n.metrics().apply("shuffleRecordsWritten").value() for n in _nodes(rows)
                        if n.getClass().getSimpleName() == "ShuffleExchangeExec"]
            keys = bf.wide_keys(plan.event_schema).count()
            assert matches <= max(shuffled) <= 1.1 * matches + keys
            assert sum(shuffled) <= 1.1 * matches + 2 * keys


def test_bucketed_source_is_not_shuffled_and_few_keys_read_few_buckets(spark):
    from keyrelay.plans.batch import plan_batch
    from keyrelay.session import session_settings
    from keyrelay.sources import fixtures
    catalog, databases, root = registry._registered(spark, SF, "plan")
    try:
        with session_settings(spark, registry.WIDE_SETTINGS):
            bf = plan_batch(fixtures.raw_events(spark, SF), catalog, registry.WIDE)
            plan = next(p for p in bf.record_plans() if p.table == "t_lineitem")
            text = _plan(bf.table_records(plan, expand=False))
            assert "Bucketed: true" in text and text.count("Exchange hashpartitioning") == 1      # the keys' side
            assert "Exchange hashpartitioning(_own_key" in text
        few = plan_batch(fixtures.raw_events(spark, SF).filter("seq in (7, 9, 15)"), catalog, FIXTURE_OPTIONS)
        for p in few.record_plans():
            if p.table in ("t_lineitem", "t_customer_order"):
                df = few.table_records(p, expand=False)
                rows, total = df._jdf.queryExecution().executedPlan(), catalog.frame(p.source_schema, p.table).count()
                df.collect()
                read = [n.metrics().apply("numOutputRows").value() for n in _nodes(rows)
                        if n.getClass().getSimpleName() == "FileSourceScanExec" and p.table in n.toString()]
                assert len(read) == 1 and read[0] <= total / 4        # three keys, 16 buckets
        # a table that comes later is seen by the next batch
        spark.sql(f"CREATE VIEW `{databases[0]}`.t_late AS SELECT c_custkey AS c_stm FROM parquet.`{SF}/customer.parquet`")
        later = plan_batch(fixtures.raw_events(spark, SF), catalog, FIXTURE_OPTIONS)
        assert "t_late" in {p.table for p in later.plans}
        assert ("db_fyygx", "v_customer") in catalog.views and catalog.known() == (["db_customer", "db_fyygx", "db_supplier"], ["customer"])
    finally:
        registry._unregister(spark, databases, root)


def test_broadcasts_are_bounded_in_bytes(spark):
    from keyrelay.plans.batch import small_delta
    bf = registry.batch(spark, SF)
    plan = next(p for p in bf.record_plans() if p.table == "t_lineitem")
    assert small_delta(bf) and bf.side(plan.event_schema).small(100, bf.opts)
    tight = registry.batch(spark, SF, FIXTURE_OPTIONS.with_(broadcast_byte_limit=100))
    assert not small_delta(tight) and not tight.side(plan.event_schema).small(100, tight.opts)


def test_float_texts_compile(spark):
    """The text of many float columns stays small enough to be compiled."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    from keyrelay.functions.sqltext import text_of
    df = spark.range(3).select(*[(F.col("id") / (k + 3)).alias(f"d{k}") for k in range(12)])
    out = df.select(*[text_of(F.col(c), T.DoubleType()).alias(c) for c in df.columns])
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 60_000 and out.collect()[1].d1 == "0.25"


def test_wide_and_bucketed_pulls_are_stored_nowhere(spark):
    """The rows of a wide pull are not written before they are asked for, whatever the caller's settings are then."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    databases = len(spark.catalog.listDatabases("kr_*"))
    wide, bucketed = (registry.QUERIES[n](spark, SF) for n in ("pull_wide", "pull_bucketed"))
    assert len(spark.catalog.listDatabases("kr_*")) == databases
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == before
    for df in (wide, bucketed):
        text = _plan(df)
        assert "ExistingRDD" not in text and "SortMergeJoin" in text and "might_contain" in text
    want = registry.batch(spark, SF)
    rows = registry._main_and_child(want)
    assert wide.count() == bucketed.count() == rows.count() > 0
    got = [sorted(map(tuple, df.collect())) for df in (rows, wide, bucketed)]
    assert got[0] == got[1] == got[2]


def test_a_record_is_parsed_once(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([('{"b":"2","a":"1"}',), ("oops",), ('{"a":null,"c":""}',)], "v string").select(
        registry._body(F.col("v")).alias("body"))
    assert _plan(df.groupBy("body").count()).count("from_json") == 1
    assert [r.body for r in df.collect()] == ["a=1|b=2", None, "c="]
