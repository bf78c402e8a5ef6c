"""Helpers of the corpus operators: joins with hot keys, scratch that is dropped."""

from pyspark.sql import functions as F

from keyrelay.llm import common


def test_spread_join_deals_hot_keys(spark):
    """A third of all rows on one key: the join loses and doubles nothing, and the key's rows lie in many partitions."""
    many = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("u"), F.lit(1).alias("v"))
    many = common.settle(many.repartition(6), "t-many")
    one = many.groupBy("u").agg(F.count("v").alias("n")).withColumn("m", F.col("u") * 2)
    out = common.spread_join(many, one, "u", 30_000, "n")
    assert out.columns == ["u", "v", "m"] and out.count() == 30_000 and out.filter("m <> 2 * u").count() == 0
    old = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        per_task = [r.n for r in common.spread_join(many, one, "u", 30_000, "n").groupBy(F.spark_partition_id()).agg(
            F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old[0])
        spark.conf.set("spark.sql.shuffle.partitions", old[1])
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(per_task) == 30_000 and max(per_task) < 3 * 30_000 / 20


def test_settled_folders_are_dropped(spark):
    before = common.settled()
    df = common.settle(spark.range(3).toDF("a"), "t-drop")
    assert df.count() == 3
    mine = [p for p in common.settled() if p not in before]
    assert len(mine) == 1
    common.drop_settled(spark, mine)
    assert common.settled() == before and not common.path_exists(spark, mine[0])
