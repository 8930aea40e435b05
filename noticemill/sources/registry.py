"""The registry of known notices: (id_notification, notificationnumber, law)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticemill.functions.validity import check_law

REGISTRY_SCHEMA = "id_notification bigint, notificationnumber string, law string"
# The registry keeps one table per law.
TABLE_OF_LAW = {"44": "notifications44", "223": "notifications223"}


def write_registry(registry: DataFrame, path: str) -> None:
    """One folder per law, so that a run for one law reads only its own."""
    registry.hint("rebalance", "law").write.partitionBy("law").parquet(path)


def write_registry_table(registry: DataFrame, table: str, buckets: int) -> None:
    """The same as a table bucketed by number: a run then joins it without shuffling it."""
    (
        registry.repartition(buckets, "notificationnumber")
        .write.partitionBy("law")
        .bucketBy(buckets, "notificationnumber")
        .sortBy("notificationnumber")
        .saveAsTable(table)
    )


def load_registry(spark: SparkSession, path: str, law: str | None = None) -> DataFrame:
    registry = spark.read.schema(REGISTRY_SCHEMA).parquet(path)
    return registry if check_law(law) is None else registry.filter(F.col("law") == law)


def load_registry_jdbc(
    spark: SparkSession,
    url: str,
    law: str,
    schema: str,
    id_range: tuple[int, int],
    partitions: int,
    **options: str,
) -> DataFrame:
    """The registry straight from its database, read in `partitions` id ranges at once."""
    table = TABLE_OF_LAW[check_law(law)]
    low, high = id_range
    rows = (
        spark.read.format("jdbc")
        .options(url=url, dbtable=f"{schema}.{table}", **options)
        .option("partitionColumn", "id_Notification")
        .option("lowerBound", low)
        .option("upperBound", high)
        .option("numPartitions", partitions)
        .load()
    )
    return rows.select(
        F.col("id_Notification").cast("bigint").alias("id_notification"),
        F.col("notificationnumber").cast("string").alias("notificationnumber"),
        F.lit(law).alias("law"),
    )
