"""Compare collected notices with the registry of known ones.

Collected rows carry (law, notice_num); numbers under different laws never meet, so both
laws are compared one after the other, each by number alone. Rows without a number belong
to the rejects and are to be filtered before. The registry is cut down to the numbers of
the run before anything of it is grouped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticemill.functions.validity import LAWS, check_law
from noticemill.operators.filters import law_filter
from noticemill.operators.skew import key_counts, skew_join
from noticemill.session import stage

NUMBER_KEY = ["law", "notice_num"]


def known_keys(registry: DataFrame, numbers: DataFrame, law: str) -> DataFrame:
    """Those of `numbers` (notice_num, distinct) that the registry knows under a law.

    A number counts as unknown when any of its registry rows lacks the notification id.
    Only registry rows of these numbers are grouped: where Spark finds the numbers small
    they are broadcast and the rest of the registry is dropped at its scan. A registry
    bucketed by number is not shuffled in any case.
    """
    rows = law_filter(registry, law).withColumnRenamed("notificationnumber", "notice_num")
    met = rows.select("notice_num", "id_notification").join(numbers, "notice_num", "left_semi")
    known = F.every(F.col("id_notification").isNotNull()).alias("_known")
    return met.groupBy("notice_num").agg(known).filter("_known").drop("_known")


def _compare(numbers: DataFrame, registry: DataFrame, law: str | None, how: str) -> DataFrame:
    """Distinct (law, notice_num), written, against the registry: both sides are unique, so there is no hot key."""
    parts = []
    for one in LAWS if check_law(law) is None else (law,):
        of_law = numbers.filter(F.col("law") == one).select("notice_num")
        found = of_law.join(known_keys(registry, of_law, one), "notice_num", how)
        parts.append(found.select(F.lit(one).alias("law"), "notice_num"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _numbers(collected: DataFrame, law: str | None) -> DataFrame:
    """The distinct numbers, written once: each law's comparison reads them twice."""
    return stage(law_filter(collected, law).select(*NUMBER_KEY).distinct(), "numbers")


def new_numbers(collected: DataFrame, registry: DataFrame, law: str | None = None) -> DataFrame:
    """Distinct collected (law, notice_num) that the registry does not know."""
    return _compare(_numbers(collected, law), registry, law, "left_anti")


def known_numbers(collected: DataFrame, registry: DataFrame, law: str | None = None) -> DataFrame:
    """Distinct collected (law, notice_num) that the registry knows."""
    return _compare(_numbers(collected, law), registry, law, "left_semi")


def new_rows(
    collected: DataFrame, registry: DataFrame, law: str | None = None, spread_by: list[str] | None = None
) -> DataFrame:
    """Collected rows whose number is new, repeats kept.

    The collected rows are read twice: once to count them per number, which also gives the
    distinct numbers that meet the registry, and once to pick the rows. One number may come
    with very many rows, so picking is a skew-proof join; `spread_by` names the columns
    that tell the rows of a number apart.
    """
    rows = law_filter(collected, law)
    counts = key_counts(rows, NUMBER_KEY)
    new = _compare(counts.select(*NUMBER_KEY), registry, law, "left_anti")
    return skew_join(rows, new, NUMBER_KEY, "left_semi", spread_by, counts).select(*collected.columns)


def numbers_per_list(collected: DataFrame) -> DataFrame:
    """(list_id, law, notice_num, _found): how many rows were collected."""
    return collected.groupBy("list_id", *NUMBER_KEY).agg(F.count(F.lit(1)).alias("_found"))


def flagged_numbers(per_number: DataFrame, registry: DataFrame) -> DataFrame:
    """Numbers per list, as written, with `_is_known`. A number may be on very many lists."""
    counts = key_counts(per_number, NUMBER_KEY)
    known = _compare(counts.select(*NUMBER_KEY), registry, None, "left_semi").withColumn("_is_known", F.lit(True))
    return skew_join(per_number, known, NUMBER_KEY, "left", ["list_id"], counts)


def run_report(collected: DataFrame, registry: DataFrame) -> DataFrame:
    """Per list and law: rows and distinct numbers found, and how many of them are new.

    Rows are counted per (list, law, number) in the map tasks and written; the lists of each
    number are counted from that, which also gives the distinct numbers that meet the
    registry; one join flags the numbers and a second count per list follows.
    """
    is_new = F.col("_is_known").isNull()
    return (
        flagged_numbers(stage(numbers_per_list(collected), "per-number"), registry)
        .groupBy("list_id", "law")
        .agg(
            F.sum("_found").alias("found_rows"),
            F.count(F.lit(1)).alias("found_distinct"),
            F.sum(F.when(is_new, F.col("_found")).otherwise(0)).alias("new_rows"),
            F.count(F.when(is_new, 1)).alias("new_distinct"),
        )
    )
