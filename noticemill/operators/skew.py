"""Helpers that keep one hot key from becoming one slow task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noticemill.session import stage

# Keys that are spread, the most frequent ones.
HOT_KEYS = 64


def key_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys…, _rows): the rows of each key, combined in the map tasks and written once."""
    return stage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")), "key-counts")


def hot_key_hashes(counts: DataFrame, keys: list[str]) -> list[int]:
    """Hashes of the `HOT_KEYS` most frequent keys that have more than one row.

    Runs a job, which sends that many numbers to the driver, whatever the size of `counts`.
    """
    hashes = counts.filter(F.col("_rows") > 1).select(F.xxhash64(*keys).alias("_hash"), "_rows")
    return [row["_hash"] for row in hashes.orderBy(F.desc("_rows"), "_hash").limit(HOT_KEYS).collect()]


def skew_join(
    rows: DataFrame,
    table: DataFrame,
    keys: list[str],
    how: str,
    spread_by: list[str] | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Equi-join of `rows`, which may pile up on a few keys, with a table of one row per key.

    Rows of a hot key are spread over all shuffle partitions and its table row is copied to
    each of them: at most `HOT_KEYS` rows are copied. Every other key is joined once. The
    hot keys are taken from exact `counts` (see `key_counts`; made here unless given) and
    stand in the plan as numbers, so both sides agree on them. `spread_by` names the
    columns that tell the rows of one key apart, all columns unless given. `how` is inner,
    left, left_semi or left_anti.
    """
    splits = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_key_hashes(key_counts(rows, keys) if counts is None else counts, keys)
    if not hot:
        return rows.join(table, keys, how)
    is_hot = F.xxhash64(*keys).isin(hot)
    part = F.pmod(F.xxhash64(*(spread_by or rows.columns)), F.lit(splits)).cast("int")
    salted = rows.withColumn("_salt", F.when(is_hot, part).otherwise(0))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(splits - 1))).otherwise(F.array(F.lit(0)))
    spread = table.select("*", F.explode(copies).alias("_salt"))
    return salted.join(spread, [*keys, "_salt"], how).drop("_salt")


def number_rows(df: DataFrame, group: list[str], order: str) -> DataFrame:
    """Add `row_pos` (0-based by `order` inside the group) and `group_rows`.

    `order` has no repeats inside a group. The rows are sorted over all tasks and written;
    each task numbers its part of a group, and a running count over the parts of a group,
    at most one per task, gives each its start. No task sorts a whole group, however its
    order values lie.
    """
    splits = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(splits, *group, order).withColumn("_part", F.spark_partition_id())
    ranged = stage(ranged, "numbered")
    sizes = ranged.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    running = Window.partitionBy(*group).orderBy("_part")
    starts = sizes.select(
        *group,
        "_part",
        (F.sum("_rows").over(running) - F.col("_rows")).alias("_start"),
        F.sum("_rows").over(Window.partitionBy(*group)).alias("group_rows"),
    )
    inside = Window.partitionBy(*group, "_part").orderBy(order)
    return (
        ranged.withColumn("_rank", F.row_number().over(inside))
        .join(starts, [*group, "_part"])
        .withColumn("row_pos", F.col("_start") + F.col("_rank") - 1)
        .drop("_part", "_start", "_rank")
    )
