"""Search runs: from notices or result pages, lists and registry to output lines.

The order of steps is chosen for scale: law, window and number validity reach the notice
scan; notices the registry knows are dropped before any item is searched or any detail page
looked up. Texts are searched in place, so that none is shuffled.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticemill.functions import text
from noticemill.functions.validity import LAWS
from noticemill.operators.codes import code_search, unmatched_codes
from noticemill.operators.enrich import enrich_223
from noticemill.operators.filters import invalid_numbers, law_filter, published_window, valid_numbers
from noticemill.operators.keywords import clauses_of, clauses_per_chunk, keyword_matches
from noticemill.operators.pages import contiguous_pages, dedupe_numbers, dedupe_pairs, union_results, with_notice_numbers
from noticemill.operators.registry import new_rows
from noticemill.session import stage
from noticemill.sources.html import scan_result_cards


def check_run_law(law: str, details: DataFrame | None) -> None:
    """A run is for one law; lines of law 223 need the detail pages."""
    if law not in LAWS:
        raise ValueError(f"a run is for one law of {LAWS}, not {law!r}")
    if law == "223" and details is None:
        raise ValueError("law 223 needs detail pages")


def wanted_notices(
    notices: DataFrame, registry: DataFrame, law: str, as_of: date | None = None, days: int = 1
) -> DataFrame:
    """Valid notices of a law and window that the registry does not know."""
    rows = law_filter(notices, law)
    if as_of is not None:
        rows = published_window(rows, as_of, days)
    return new_rows(valid_numbers(rows), registry, law, spread_by=["notice_id"])


def of_wanted(rows: DataFrame, wanted: DataFrame, id_col: str) -> DataFrame:
    """The rows (items, say) of the wanted notices.

    Spark broadcasts the ids when it finds them small; else it joins by id, and rows landed
    in a table bucketed by id are not shuffled for it.
    """
    ids = wanted.select(F.col("notice_id").alias(id_col)).distinct()
    return rows.join(ids, id_col, "left_semi")


def write_by_id(rows: DataFrame, table: str, id_col: str, buckets: int) -> None:
    """Land texts or items as a table bucketed by notice id."""
    rows.repartition(buckets, id_col).write.bucketBy(buckets, id_col).sortBy(id_col).saveAsTable(table)


def keyword_hits(
    notices: DataFrame,
    texts: DataFrame,
    lists: DataFrame,
    policy: str = "any",
    chunks: int | None = None,
    id_col: str = "doc_id",
    attachments: DataFrame | None = None,
) -> DataFrame:
    """(list_id, notice columns…) of the given notices whose text, or attachments, match a list.

    The texts are searched where they lie and only what is found meets the notices: cut by
    id before, all texts would be shuffled once the ids are too many to be broadcast.
    """
    clauses = clauses_of(lists, policy) if chunks is None or policy == "any" else clauses_per_chunk(lists, chunks)
    parts = texts.select(id_col, "text")
    if attachments is not None:
        parts = parts.unionByName(attachments.select(id_col, "text"))
    matches = keyword_matches(parts, clauses, id_col)
    return notices.join(matches.withColumnRenamed(id_col, "notice_id"), "notice_id")


def code_hits(notices: DataFrame, items: DataFrame, code_lists: DataFrame, tree: DataFrame) -> DataFrame:
    """(list_id, notice columns…) of the given notices whose item is below a listed code."""
    matches = code_search(of_wanted(items, notices, "item_id"), code_lists, tree)
    return notices.join(matches.withColumnRenamed("item_id", "notice_id"), "notice_id")


def lines_44(hits: DataFrame) -> DataFrame:
    """(list_id, line): the number alone, once per list."""
    return dedupe_numbers(hits).select("list_id", text.output_line(F.col("notice_num")).alias("line"))


def lines_223(hits: DataFrame, details: DataFrame) -> DataFrame:
    """(list_id, line): number and, where the detail page has them, both ids."""
    hits = stage(hits.select("list_id", "notice_num", "href"), "hits")  # the look-up reads its input twice
    enriched = enrich_223(hits, details)
    line = text.output_line(F.col("notice_num"), F.col("noticeinfoid"), F.col("pfid"))
    return enriched.select("list_id", line.alias("line")).distinct()


def lines_of(hits: DataFrame, law: str, details: DataFrame | None) -> DataFrame:
    return lines_44(hits) if law == "44" else lines_223(hits, details)


def run_keywords(
    notices: DataFrame,
    registry: DataFrame,
    texts: DataFrame,
    lists: DataFrame,
    law: str,
    policy: str = "any",
    as_of: date | None = None,
    days: int = 1,
    details: DataFrame | None = None,
    chunks: int | None = None,
    attachments: DataFrame | None = None,
) -> DataFrame:
    """Keyword run: (source, list_id, line) of the new notices.

    With `attachments` (doc_id, text; any number per notice) a term may stand there as well.
    """
    check_run_law(law, details)
    wanted = stage(wanted_notices(notices, registry, law, as_of, days), "wanted")
    hits = keyword_hits(wanted, texts, lists, policy, chunks, attachments=attachments)
    return lines_of(hits, law, details).select(F.lit("kw").alias("source"), "list_id", "line")


def run_codes(
    notices: DataFrame,
    registry: DataFrame,
    items: DataFrame,
    code_lists: DataFrame,
    tree: DataFrame,
    law: str,
    as_of: date | None = None,
    days: int = 1,
    details: DataFrame | None = None,
) -> DataFrame:
    """Code run: (source, list_id, line) of the new notices; the item id is the notice id."""
    check_run_law(law, details)
    wanted = stage(wanted_notices(notices, registry, law, as_of, days), "wanted")
    hits = code_hits(wanted, items, code_lists, tree)
    return lines_of(hits, law, details).select(F.lit("okpd").alias("source"), "list_id", "line")


def run_all(keyword_runs: list[DataFrame], code_runs: list[DataFrame]) -> DataFrame:
    """The lines of several runs, (source, list_id, line), for one sink; repeats of a run's lines dropped."""
    parts = {}
    for source, runs in (("kw", keyword_runs), ("okpd", code_runs)):
        if runs:
            parts[source] = reduce(DataFrame.unionByName, [r.select("list_id", "line") for r in runs]).distinct()
    return union_results(**parts).select("source", "list_id", "line")


def unmatched_list_codes(code_lists: DataFrame, tree: DataFrame) -> DataFrame:
    """(list_id, code) of a code run that lead to nothing, for its report."""
    return unmatched_codes(code_lists, tree)


def run_notices_223(notices: DataFrame, registry: DataFrame, details: DataFrame) -> DataFrame:
    """Enrichment run over all law-223 notices, without list or window: (line)."""
    wanted = wanted_notices(notices, registry, "223").select(F.lit("").alias("list_id"), "notice_num", "href")
    return lines_223(wanted, details).select("line")


def run_pages(
    pages: DataFrame, registry: DataFrame, law: str, details: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Run over landed result pages (search_id, page_num, html) of one law: lines and rejects.

    The pages are parsed once and their cards written; then the cards up to the first
    missing page of each search, their numbers, distinct pairs, those with a valid number
    that the registry does not know, and (list_id, line) with the search as list. Rejects:
    (list_id, notice_num, href, reason) of the distinct pairs without a valid number.
    """
    check_run_law(law, details)
    cards = stage(scan_result_cards(pages), "cards")
    numbered = with_notice_numbers(contiguous_pages(cards)).withColumn("law", F.lit(law))
    pairs = numbered.select(F.col("search_id").cast("string").alias("list_id"), "law", "notice_num", "href")
    pairs = stage(dedupe_pairs(pairs), "pairs")
    rejects = invalid_numbers(pairs).select("list_id", "notice_num", "href", "reason")
    new = new_rows(valid_numbers(pairs), registry, law, spread_by=["list_id", "href"])
    return lines_of(new, law, details), rejects
