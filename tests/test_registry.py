import random
import re

import pytest
from pyspark.sql import functions as F

from noticemill.operators.enrich import detail_ids, enrich_223
from noticemill.operators.registry import known_numbers, new_numbers, new_rows, run_report
from noticemill.session import stage
from noticemill.sources.registry import load_registry, write_registry, write_registry_table
from tests.conftest import plan_of, rows

COLLECTED = "list_id string, law string, notice_num string, href string"


def registry_df(spark, data):
    return spark.createDataFrame(data, "id_notification bigint, notificationnumber string, law string")


def collected_df(spark, data):
    return spark.createDataFrame(data, COLLECTED)


def test_number_is_looked_up_under_its_law(spark):
    collected = collected_df(spark, [("l", "44", "1", "a"), ("l", "223", "1", "b"), ("l", "44", "2", "c")])
    registry = registry_df(spark, [(7, "1", "44"), (8, "2", "223")])
    assert rows(new_numbers(collected, registry)) == [("223", "1"), ("44", "2")]
    assert rows(new_numbers(collected, registry, "44")) == [("44", "2")]
    assert rows(known_numbers(collected, registry)) == [("44", "1")]


def test_row_without_id_makes_a_number_unknown(spark):
    collected = collected_df(spark, [("l", "44", n, "h") for n in "123"])
    registry = registry_df(spark, [(None, "1", "44"), (5, "2", "44"), (None, "2", "44"), (6, "3", "44")])
    assert rows(new_numbers(collected, registry)) == [("44", "1"), ("44", "2")]
    assert rows(new_rows(collected, registry).select("notice_num")) == [("1",), ("2",)]


def test_numbers_are_text(spark):
    collected = collected_df(spark, [("l", "44", "007", "h"), ("l", "44", "7", "h")])
    assert rows(new_numbers(collected, registry_df(spark, [(1, "7", "44")]))) == [("44", "007")]


def test_new_and_known_split_the_distinct_numbers(spark):
    rng = random.Random(1)
    data = [("l", rng.choice(["44", "223"]), str(rng.randint(1, 60)), "h") for _ in range(300)]
    collected = collected_df(spark, data)
    registry = registry_df(spark, [(i, str(rng.randint(1, 60)), rng.choice(["44", "223"])) for i in range(40)])
    new, known = rows(new_numbers(collected, registry)), rows(known_numbers(collected, registry))
    assert not set(new) & set(known)
    assert sorted(new + known) == sorted({(law, num) for _, law, num, _ in data})


def test_empty_sides(spark):
    registry, collected = registry_df(spark, [(1, "1", "44")]), collected_df(spark, [("l", "44", "1", "h")])
    assert rows(new_numbers(collected_df(spark, []), registry)) == []
    assert rows(new_rows(collected_df(spark, []), registry)) == []
    assert rows(new_rows(collected, registry_df(spark, []))) == [("l", "44", "1", "h")]


def test_new_rows_keep_repeats(spark):
    collected = collected_df(spark, [("l", "223", "1", "a"), ("l", "223", "1", "a"), ("l", "223", "1", "b"), ("l", "223", "2", "c")])
    registry = registry_df(spark, [(1, "2", "223"), (2, "2", "223")])
    new = new_rows(collected, registry, "223").select("notice_num", "href")
    assert rows(new) == [("1", "a"), ("1", "a"), ("1", "b")]


def test_report_counts_rows_and_numbers(spark):
    collected = collected_df(
        spark,
        [("a", "44", "1", "x"), ("a", "44", "1", "y"), ("a", "44", "2", "x"), ("b", "44", "2", "x"), ("b", "223", "9", "x")],
    )
    registry = registry_df(spark, [(1, "2", "44"), (2, "2", "44")])
    assert rows(run_report(collected, registry)) == [
        ("a", "44", 3, 2, 2, 1),
        ("b", "223", 1, 1, 1, 1),
        ("b", "44", 1, 1, 0, 0),
    ]


def test_partitioned_registry_reads_one_law(spark, tmp_path):
    registry = registry_df(spark, [(1, "1", "44"), (2, "2", "223"), (3, "03", "44")])
    write_registry(registry, str(tmp_path / "r"))
    loaded = load_registry(spark, str(tmp_path / "r"), "44")
    assert rows(loaded) == [(1, "1", "44"), (3, "03", "44")]
    assert "PartitionFilters: [isnotnull(law#" in plan_of(loaded)
    assert load_registry(spark, str(tmp_path / "r")).count() == 3


def test_bucketed_registry_is_not_shuffled(spark, plain_joins):
    registry = registry_df(spark, [(i, str(i), "44" if i % 2 else "223") for i in range(200)])
    write_registry_table(registry, "registry_buckets", 4)
    collected = collected_df(spark, [("l", "44", str(i), "h") for i in range(0, 300, 3)])
    new = new_numbers(collected, spark.table("registry_buckets"), "44").select("notice_num")
    expected = sorted((str(i),) for i in range(0, 300, 3) if not (i < 200 and i % 2))
    assert rows(new) == expected
    assert exchanges_below_joins(plan_of(new), "registry_buckets") == 0
    # both laws are compared by number alone, so the buckets serve them too
    both = collected.unionByName(collected.withColumn("law", F.lit("223")))
    for compared in (new_numbers(both, spark.table("registry_buckets")), known_numbers(both, spark.table("registry_buckets"))):
        compared.collect()
        plan = plan_of(compared)
        assert "Bucketed: true" in plan and exchanges_below_joins(plan, "registry_buckets") == 0


def exchanges_below_joins(plan, table):
    """Exchanges between a scan of the table and the first join above it."""
    lines = plan.split("== Initial Plan ==")[0].splitlines()
    depth = lambda line: re.search(r"[A-Za-z*]", line).start()
    found = 0
    for i, line in enumerate(lines):
        if "FileScan" not in line or table not in line:
            continue
        at = depth(line)
        for above in reversed(lines[:i]):
            if re.search(r"[A-Za-z*]", above) and depth(above) < at:
                at = depth(above)
                if "Join" in above:
                    break
                found += "Exchange" in above
    return found


def test_only_registry_rows_of_the_run_are_shuffled(spark, plain_joins):
    registry = stage(spark.range(50_000).select("id", F.col("id").cast("string").alias("n"), F.lit("44").alias("law")), "registry")
    registry = registry.toDF("id_notification", "notificationnumber", "law")
    collected = stage(collected_df(spark, [("l", "44", str(i), "h") for i in range(49_990, 50_010)]), "collected")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    for compared in (new_numbers(collected, registry), known_numbers(collected, registry, "44")):
        assert compared.count() == 10
        compared.collect()
        plan = plan_of(compared)
        # the run's numbers are broadcast, and the registry is cut down at its scan
        assert "BroadcastHashJoin" in plan
        assert exchanges_below_joins(plan, "id_notification") == 0


def test_only_detail_pages_of_the_run_are_grouped(spark):
    details = details_df(spark, [(f"/{i}", f"zakupki?noticeInfoId={i}", f"?pfid={i}") for i in range(2000)])
    details = stage(details, "details")
    collected = stage(spark.createDataFrame([("1", "/7"), ("2", "/none")], "notice_num string, href string"), "collected")
    got = enrich_223(collected, details)
    assert rows(got) == [("1", "/7", "7", "7"), ("2", "/none", None, None)]
    assert exchanges_below_joins(plan_of(got), "icon_hrefs") == 0


DETAILS = "href string, final_url string, icon_hrefs string"


def details_df(spark, data):
    return spark.createDataFrame(data, DETAILS)


def test_enrichment_outcomes(spark):
    site = "https://zakupki.example"
    details = details_df(
        spark,
        [
            ("/ok", f"{site}/v?noticeInfoId=11", "/print /doc?pfid=21 /doc?pfid=22"),
            ("/stays", "https://elsewhere/v?noticeInfoId=11", "/doc?pfid=21"),
            ("/noid", f"{site}/404", "/doc?pfid=21"),
            ("/nolink", f"{site}/v?noticeInfoId=11", "/print"),
            ("/nodigits", f"{site}/v?noticeInfoId=11", "/doc?pfid="),
            ("/null", None, None),
            ("/twice", f"{site}/404", "/doc?pfid=1"),
            ("/twice", f"{site}/v?noticeInfoId=5", "/doc?pfid=6"),
        ],
    )
    hrefs = ["/ok", "/stays", "/noid", "/nolink", "/nodigits", "/null", "/twice", "/not landed"]
    collected = spark.createDataFrame([(h, h) for h in hrefs + ["/ok"]], "notice_num string, href string")
    got = {r.notice_num: (r.noticeinfoid, r.pfid) for r in enrich_223(collected, details).collect()}
    assert got == {h: (None, None) for h in hrefs} | {"/ok": ("11", "21"), "/twice": ("5", "6")}
    assert enrich_223(collected, details).count() == len(hrefs)


def test_other_host(spark):
    details = details_df(spark, [("/a", "https://elsewhere/v?noticeInfoId=1", "/doc?pfid=2")])
    assert rows(detail_ids(details, host="elsewhere").select("href", "ids.*")) == [("/a", "1", "2")]


@pytest.mark.parametrize("hot", ["num", "href"])
def test_one_key_holds_a_third_of_all_rows(spark, plain_joins, hot):
    n = 6000
    ids = spark.range(n)
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500))
    other = F.col("id").cast("string")
    if hot == "num":
        collected = ids.select(F.lit("l").alias("list_id"), F.lit("223").alias("law"), key.alias("notice_num"), other.alias("href"))
        landed = [(i, f"k{i}", "223") for i in range(0, 500, 2)] + [(1, "k0", "223")] * 500
        registry = registry_df(spark, landed)
        expected = [i for i in range(n) if i % 3 == 0 or (i % 500) % 2]
        assert sorted(int(r.href) for r in new_rows(collected, registry, "223").collect()) == expected
    else:
        collected = ids.select(other.alias("notice_num"), key.alias("href"))
        landed = [("hot", "zakupki?noticeInfoId=1", "?pfid=2")] * 500 + [("k4", "zakupki?noticeInfoId=3", "?pfid=4")]
        details = details_df(spark, landed)
        got = enrich_223(collected, details).collect()
        assert len(got) == n
        assert sum(r.noticeinfoid == "1" for r in got) == n // 3
        assert sum(r.noticeinfoid == "3" for r in got) == sum(i % 3 != 0 and i % 500 == 4 for i in range(n))
