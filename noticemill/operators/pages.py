"""Result pages and collected pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticemill.functions import text
from noticemill.operators.skew import skew_join
from noticemill.session import stage


def contiguous_pages(cards: DataFrame) -> DataFrame:
    """Cards on pages 1, 2, 3 … of a search up to its first missing page.

    Each page says that it exists and asks for its successor; the smallest page asked for
    that does not exist ends the search. Counting is per (search, page) and combined in
    the map tasks, so a search with very many pages is no single group.
    """
    page = F.col("page_num")
    asked = F.array(
        F.struct(page.alias("page"), F.lit(True).alias("landed")),
        F.struct((page + 1).alias("page"), F.lit(False).alias("landed")),
        F.struct(F.lit(1).alias("page"), F.lit(False).alias("landed")),
    )
    pages = cards.select("search_id", F.inline(asked)).groupBy("search_id", "page").agg(
        F.max("landed").alias("landed"), F.count(F.when(F.col("landed"), 1)).alias("_cards")
    )
    pages = stage(pages, "pages")  # a row for each page, read for the gaps and for the counts
    missing = pages.filter(~F.col("landed")).groupBy("search_id").agg(F.min("page").alias("first_missing"))
    counts = pages.groupBy("search_id").agg(F.sum("_cards").alias("_rows"))
    kept = skew_join(cards, missing, ["search_id"], "inner", spread_by=["page_num"], counts=counts)
    return kept.filter((F.col("page_num") >= 1) & (F.col("page_num") < F.col("first_missing"))).select(*cards.columns)


def with_notice_numbers(cards: DataFrame, label: str = "label") -> DataFrame:
    """Adds `notice_num`, NULL when the label has none.

    The one-element explode has the pattern run once per card: a plain column would be
    copied into every filter that uses the number.
    """
    return cards.select("*", F.explode(F.array(text.notice_number(F.col(label)))).alias("notice_num"))


def hit_counts(cards: DataFrame) -> DataFrame:
    """Cards per search, counted."""
    return cards.groupBy("search_id").agg(F.count(F.lit(1)).alias("hits"))


def dedupe_pairs(collected: DataFrame) -> DataFrame:
    """Each (list, number, href) once; never across lists."""
    return collected.dropDuplicates(["list_id", "notice_num", "href"])


def dedupe_numbers(collected: DataFrame) -> DataFrame:
    """Each (list, number) once."""
    return collected.select("list_id", "notice_num").distinct()


def union_results(**by_source: DataFrame) -> DataFrame:
    """All results one after the other, repeats kept, with the source they came from."""
    parts = [df.withColumn("source", F.lit(name)) for name, df in by_source.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
