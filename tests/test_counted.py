"""Counts that a run takes of itself, against counts of what it read and wrote."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from noticemill.operators.registry import run_report
from noticemill.plans.counted import MAX_WORKERS, WorkerCounts, counted_run
from noticemill.session import new_path
from noticemill.sources.runs import read_runs
from tests.conftest import rows

RUN_AT = datetime(2001, 8, 1, 12, 30, 5)
COLLECTED = "list_id string, law string, notice_num string"
REGISTRY = "id_notification bigint, notificationnumber string, law string"


def worker():
    return F.pmod(F.col("list_id").cast("bigint"), F.lit(3))


def test_report_is_that_of_counting(spark):
    collected = spark.range(3000).select(
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise((F.col("id") % 5 * (F.col("id") % 2)).cast("string")).alias("list_id"),
        F.when(F.col("id") % 3 == 0, "44").otherwise("223").alias("law"),
        (F.col("id") % 400).cast("string").alias("notice_num"),
    )
    registry = spark.range(0, 400, 3).select(
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("id_notification"), F.col("id").cast("string").alias("notificationnumber"), F.lit("44").alias("law")
    )
    path = new_path(spark, "counted")
    got = counted_run(collected, registry, path, RUN_AT, worker(), 3)
    counted = run_report(collected, registry).filter("list_id is not null").groupBy(worker().cast("int").alias("worker"))
    counted = counted.agg(*(F.sum(name).alias(name) for name in ("found_rows", "found_distinct", "new_distinct")))
    assert rows(got) == rows(counted) and got.count() == 3
    # what nobody had is written all the same, and a repeated run counts the same once more
    written = read_runs(spark, path).count()
    assert written == run_report(collected, registry).agg(F.sum("new_distinct")).first()[0]
    assert rows(counted_run(collected, registry, path, RUN_AT, worker(), 3)) == rows(got)
    assert read_runs(spark, path).count() == written


def test_nothing_collected_and_idle_workers(spark):
    none, registry = spark.createDataFrame([], COLLECTED), spark.createDataFrame([], REGISTRY)
    path = new_path(spark, "counted")
    assert rows(counted_run(none, registry, path, RUN_AT, worker(), 2)) == [(0, 0, 0, 0), (1, 0, 0, 0)]
    one = spark.createDataFrame([("2", "44", "1")] * 3, COLLECTED)
    assert rows(counted_run(one, registry, path, RUN_AT, worker(), 4)) == [(0, 0, 0, 0), (1, 0, 0, 0), (2, 3, 1, 1), (3, 0, 0, 0)]


def test_number_of_workers_is_bounded(spark):
    for workers in (0, MAX_WORKERS + 1):
        with pytest.raises(ValueError):
            WorkerCounts(worker(), workers)
