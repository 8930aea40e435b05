from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from noticemill.operators.facets import facet_resolve
from noticemill.operators.filters import facet_filter, invalid_numbers, law_filter, published_window, valid_numbers
from noticemill.plans.search import wanted_notices
from tests.conftest import plan_of, rows

AS_OF = date(2001, 8, 1)


@pytest.mark.parametrize("days", [0, 1, 30])
def test_window_includes_both_ends(spark, days):
    published = [(i, AS_OF - timedelta(days=i)) for i in range(-2, 40)]
    kept = published_window(spark.createDataFrame(published, "i int, published_on date"), AS_OF, days)
    assert sorted(r.i for r in kept.collect()) == list(range(days + 1))


def test_law(spark):
    notices = spark.createDataFrame([("44",), ("223",), ("94",), (None,)], "law string")
    assert rows(law_filter(notices, "44")) == [("44",)]
    assert rows(law_filter(notices, None)) == [("223",), ("44",)]
    with pytest.raises(ValueError):
        law_filter(notices, "94")


def test_valid_and_invalid_split_the_rows(spark):
    numbers = ["0" * 19, "0" * 18, "3" * 11, "4" * 11, "3" * 10, "", None]
    notices = spark.createDataFrame([(law, n) for law in ("44", "223") for n in numbers], "law string, notice_num string")
    valid, invalid = valid_numbers(notices), invalid_numbers(notices)
    assert rows(valid) == [("223", "3" * 11), ("44", "0" * 19)]
    assert valid.count() + invalid.count() == notices.count()
    assert invalid.filter("notice_num is null and reason = 'no_number'").count() == 2


def test_facet_options(spark):
    labels = spark.createDataFrame([("44-ФЗ",), ("223-фз и другие",), ("иное",), (None,)], "label string")
    assert rows(facet_filter(labels, "label", ["44-фз"])) == [("44-ФЗ",)]
    assert rows(facet_filter(labels, "label", ["44-фз", "223-ФЗ"])) == [("223-фз и другие",), ("44-ФЗ",)]
    assert facet_filter(labels, "label", []).count() == 4


def test_wanted_facets_and_what_was_not_found(spark):
    offered = spark.createDataFrame(
        [("Правило проведения", "44-ФЗ"), ("Правило проведения", "223-ФЗ"), ("Быстрые настройки", "Искать в файлах")],
        "facet string, option string",
    )
    wanted = [("правило проведения", "44-фз"), ("правило", "-фз"), ("быстрые настройки", "точное"), ("нет", "44")]
    assert rows(facet_resolve(offered, wanted)) == sorted(
        [("правило проведения", "44-фз", 1), ("правило", "-фз", 2), ("быстрые настройки", "точное", 0), ("нет", "44", 0)], key=repr
    )


def test_filters_reach_the_scan(spark, tmp_path):
    notices = spark.range(100).select(
        F.col("id").alias("notice_id"),
        F.when(F.col("id") % 2 == 0, "44").otherwise("223").alias("law"),
        F.lpad(F.col("id").cast("string"), 19, "0").alias("notice_num"),
        F.date_sub(F.lit(AS_OF), F.col("id").cast("int")).alias("published_on"),
        F.lit("x").alias("unused"),
    )
    notices.write.partitionBy("law").parquet(str(tmp_path / "n"))
    landed = spark.read.schema(notices.schema).parquet(str(tmp_path / "n"))
    registry = spark.createDataFrame([(1, "1", "44")], "id_notification bigint, notificationnumber string, law string")
    wanted = wanted_notices(landed, registry, "44", AS_OF, 30).select("notice_num")
    plan = plan_of(wanted)
    assert "PartitionFilters: [isnotnull(law" in plan
    assert "GreaterThanOrEqual(published_on,2001-07-02)" in plan and "LessThanOrEqual(published_on,2001-08-01)" in plan
    assert "unused" not in plan
    assert wanted.count() == 16
