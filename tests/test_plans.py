"""Plans of joins that are left to Spark."""

from pyspark.sql import functions as F

from noticemill.operators.codes import code_subtree
from noticemill.session import stage
from tests.conftest import plan_of


def test_adaptive_execution_splits_a_code_that_most_items_have(spark, plain_joins):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        code = F.when(F.col("id") % 3 == 0, "10.1").otherwise(F.concat(F.lit("2"), F.col("id") % 997))
        items = stage(spark.range(30000).repartition(6).select(F.col("id").alias("item_id"), code.alias("code")), "items")
        codes = spark.createDataFrame([("hot", "10.1"), ("cold", "25")], "list_id string, code string")
        found = code_subtree(items, stage(codes, "codes"))
        assert found.filter("list_id = 'hot'").count() == 10000
        found.collect()
        assert "skew=true" in plan_of(found)
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_small_code_lists_are_broadcast(spark):
    items = stage(spark.range(100).select(F.col("id").alias("item_id"), F.col("id").cast("string").alias("code")), "items")
    codes = stage(spark.createDataFrame([("l", "1")], "list_id string, code string"), "codes")
    found = code_subtree(items, codes)
    assert "BroadcastHashJoin" in plan_of(found) and "SortMergeJoin" not in plan_of(found)
    assert found.count() == 11
