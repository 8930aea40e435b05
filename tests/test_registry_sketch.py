"""The registry behind a sketch: same rows, and few files opened."""

import os
import random

import pytest

from noticemill.operators.registry import new_numbers
from noticemill.operators.registry_sketch import known_by_sketch, land_registry, new_numbers_by_sketch, possibly_known
from tests.conftest import rows

REGISTRY = "id_notification bigint, notificationnumber string, law string"
NUMBERS = "law string, notice_num string"


def number(i):
    return f"{i:019d}"


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    rng = random.Random(2)
    parts = []
    for portion in range(3):
        part = [(rng.choice([i, i, i, None]), number(i), rng.choice(["44", "223"])) for i in rng.choices(range(6000), k=2500)]
        parts.append(part + [(1, None, "44"), (2, number(9), None)])
    path = str(tmp_path_factory.mktemp("registry"))
    for i, part in enumerate(parts):
        land_registry(spark.createDataFrame(part, REGISTRY), path, str(i))
    return path, spark.createDataFrame([r for part in parts for r in part if r[1] and r[2]], REGISTRY)


def test_same_rows_as_by_reading_all(spark, landed):
    path, registry = landed
    collected = spark.createDataFrame([(law, number(i)) for i in range(7000) for law in ("44", "223")] + [("44", number(5))], NUMBERS)
    assert rows(new_numbers_by_sketch(spark, path, collected)) == rows(new_numbers(collected, registry))


def test_no_number_is_missed_and_few_pass_in_vain(spark, landed):
    path, registry = landed
    there = registry.selectExpr("law", "notificationnumber as notice_num").distinct()
    assert rows(possibly_known(spark, path, there).select("law", "notice_num").distinct()) == rows(there)
    never = spark.createDataFrame([("44", number(i)) for i in range(100_000, 120_000)], NUMBERS)
    assert possibly_known(spark, path, never).count() < 200


def test_buckets_without_a_hit_are_not_opened(spark, tmp_path):
    path = str(tmp_path / "r")
    land_registry(spark.createDataFrame([(i, number(i), "44") for i in range(3000)], REGISTRY), path, "a")
    few = spark.createDataFrame([("44", number(7)), ("44", number(9_999_999)), ("223", number(7))], NUMBERS)
    wanted = {f"bucket={r.bucket}" for r in possibly_known(spark, path, few).collect()}
    assert 1 <= len(wanted) <= 2
    spoilt = 0
    for folder, _, names in os.walk(f"{path}/rows"):
        if os.path.basename(folder).startswith("bucket=") and os.path.basename(folder) not in wanted:
            for name in names:
                with open(os.path.join(folder, name), "wb") as file:
                    file.write(b"opening this fails")
                spoilt += name.endswith(".parquet")
    assert spoilt > 50
    assert rows(known_by_sketch(spark, path, few)) == [("44", number(7))]


def test_landing_again_replaces_one_portion(spark, tmp_path):
    path = str(tmp_path / "r")
    one, two = (spark.createDataFrame([(i, number(i), "44")], REGISTRY) for i in (1, 2))
    for portion, part in (("a", one), ("b", one), ("b", two), ("c", one.limit(0))):
        land_registry(part, path, portion)
    asked = spark.createDataFrame([("44", number(i)) for i in range(4)], NUMBERS)
    assert rows(known_by_sketch(spark, path, asked)) == [("44", number(1)), ("44", number(2))]
    assert rows(new_numbers_by_sketch(spark, path, asked.limit(0))) == []
