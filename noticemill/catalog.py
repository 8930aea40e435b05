"""One query per operator, over the given tables and what is derived from them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticemill.fixtures import Fixtures
from noticemill.functions import text
from noticemill.operators import codes, enrich, facets, filters, keywords, pages, registry, registry_sketch, text_index
from noticemill.operators.chunks import chunk_terms
from noticemill.plans import counted, search
from noticemill.session import configure, new_path
from noticemill.sources import html, lines, lists, runs
from noticemill.sources import registry as registry_source
from noticemill.streaming.intake import stream_lists
from noticemill.streaming.matches import stream_keyword_run
from noticemill.streaming.notices import stream_new_notices
from noticemill.streaming.pages import stream_pages
from noticemill.streaming.reruns import report_run

AS_OF = date(2001, 8, 1)
RUN_AT = datetime(2001, 8, 1, 12, 30, 5)
SEGMENT_OPTIONS = ("build", "house")
WANTED_FACETS = (("asia", "build"), ("europe", "machinery"), ("America", "nation_1 "), ("asia", "unheard of"), ("antarctica", "build"))

QUERIES: dict[str, Callable[[Fixtures], DataFrame]] = {}


def query(fn: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
    QUERIES[fn.__name__.removesuffix("_query")] = fn
    return fn


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(fn):
        return lambda spark, folder: fn(Fixtures(configure(spark), folder))

    return {name: bound(fn) for name, fn in QUERIES.items()}


def _terms(lists_table: DataFrame) -> DataFrame:
    return lists.strip_terms(lists_table)


def _codes(lists_table: DataFrame) -> DataFrame:
    return lists.strip_terms(lists_table).select("list_id", F.col("term").alias("code"))


def _by_search(df: DataFrame) -> DataFrame:
    """Takes the search a notice belongs to as its list."""
    return df.withColumn("list_id", F.col("search_id").cast("string"))


# Scans, sources, sinks


@query
def scan_lists(t: Fixtures) -> DataFrame:
    folder = new_path(t.spark, "lists")
    t.write_list_files(folder)
    return lists.scan_lists(t.spark, folder).select("list_id", F.length("content").cast("bigint").alias("n_bytes"))


@query
def read_terms(t: Fixtures) -> DataFrame:
    return lists.read_terms(t.list_files)


@query
def scan_result_cards(t: Fixtures) -> DataFrame:
    return html.scan_result_cards(t.search_pages)


@query
def extract_links(t: Fixtures) -> DataFrame:
    return html.extract_links(t.pages.select("page_id", "html"))


@query
def scan_registry(t: Fixtures) -> DataFrame:
    path = new_path(t.spark, "registry")
    registry_source.write_registry(t.registry, path)
    return registry_source.load_registry(t.spark, path, "44")


def _new_lines(t: Fixtures) -> DataFrame:
    rows = _by_search(registry.new_rows(filters.valid_numbers(filters.law_filter(t.notices, "44")), t.registry, "44"))
    return search.lines_44(rows)


@query
def sink_lines(t: Fixtures) -> DataFrame:
    path = new_path(t.spark, "output")
    lines.write_lines(_new_lines(t), path, RUN_AT)
    return lines.read_lines(t.spark, path).select("list_id", "run_ts", "line")


@query
def compact_output(t: Fixtures) -> DataFrame:
    """Output of two runs, the second padded, rewritten without repeats."""
    path, compacted = new_path(t.spark, "output"), new_path(t.spark, "compacted")
    first = _by_search(filters.valid_numbers(t.notices)).select("list_id", F.col("notice_num").alias("line"))
    again = first.filter(F.length("line") == 19).withColumn("line", F.concat(F.lit("  "), "line", F.lit("\t")))
    lines.write_lines(first.unionByName(again), path, RUN_AT)
    lines.compact_lines(t.spark, path, compacted, RUN_AT)
    return lines.read_lines(t.spark, compacted).select("list_id", "line")


@query
def sink_runs(t: Fixtures) -> DataFrame:
    """A run with a manifest, repeated with the same time."""
    path = new_path(t.spark, "runs")
    for _ in range(2):
        runs.write_run(_new_lines(t), path, RUN_AT)
    return runs.read_runs(t.spark, path).select("list_id", "run_ts", "line")


@query
def compact_runs(t: Fixtures) -> DataFrame:
    """Three runs, merged after the second and after the third, which has new lines for some lists only."""
    path = new_path(t.spark, "runs")
    first = _by_search(filters.valid_numbers(t.notices)).select("list_id", F.col("notice_num").alias("line"))
    again = first.filter(F.length("line") == 19).withColumn("line", F.concat(F.lit("  "), "line", F.lit("\t")))
    for i, some in enumerate((first.filter("list_id < '3'"), again, first.filter("list_id >= '3'"))):
        runs.write_run(some, path, RUN_AT + timedelta(hours=i))
        if i:
            runs.compact_runs(t.spark, path, RUN_AT + timedelta(hours=i, minutes=5))
    return runs.read_runs(t.spark, path).select("list_id", "line")


# Filters and predicates


@query
def published_window(t: Fixtures) -> DataFrame:
    rows = filters.published_window(t.notices, AS_OF, 30)
    return rows.select("notice_id", "law", "notice_num", F.col("published_on").cast("string").alias("published_on"))


@query
def law_filter(t: Fixtures) -> DataFrame:
    return filters.law_filter(t.notices, "223").select("notice_id", "law", "notice_num")


@query
def valid_num_44(t: Fixtures) -> DataFrame:
    return filters.valid_numbers(filters.law_filter(t.notices, "44")).select("notice_id", "notice_num")


@query
def valid_num_223(t: Fixtures) -> DataFrame:
    return filters.valid_numbers(filters.law_filter(t.notices, "223")).select("notice_id", "notice_num")


@query
def invalid_nums(t: Fixtures) -> DataFrame:
    rejects = filters.invalid_numbers(pages.with_notice_numbers(t.search_cards))
    number = F.coalesce("notice_num", F.lit("")).alias("notice_num")
    return rejects.select("search_id", "page_num", "card_pos", "law", number, "reason")


def _facet_labels(t: Fixtures) -> DataFrame:
    """Region as the facet; market segment and nation of a customer as the option."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    label = F.concat("c_mktsegment", F.lit(" "), "n_name", F.lit(" "), "c_name")
    joined = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("c_custkey", F.col("r_name").alias("facet"), label.alias("option"))


@query
def facet_filter(t: Fixtures) -> DataFrame:
    return filters.facet_filter(_facet_labels(t), "option", SEGMENT_OPTIONS)


@query
def redirect_filter(t: Fixtures) -> DataFrame:
    url = F.coalesce(enrich.redirected_url(F.col("final_url")), F.lit(""))
    return t.detail_pages.select("href", url.alias("site_url"))


@query
def first_link_with(t: Fixtures) -> DataFrame:
    return t.detail_pages.select(
        "href", text.first_link_with(F.split("icon_hrefs", " "), enrich.PFID_MARK).alias("pfid_href")
    )


# Keyword search


@query
def kw_any(t: Fixtures) -> DataFrame:
    return keywords.keyword_matches(t.documents, keywords.clauses_of(_terms(t.lists), "any"), "doc_id")


def _document_index(t: Fixtures) -> str:
    """An index to which the documents were added in two batches."""
    path = new_path(t.spark, "text-index")
    for i in range(2):
        text_index.add_to_index(t.documents.filter(F.col("doc_id") % 2 == i), path, str(i))
    return path


@query
def kw_any_indexed(t: Fixtures) -> DataFrame:
    return text_index.indexed_matches(t.spark, _document_index(t), _terms(t.lists), "any")


@query
def kw_all_indexed(t: Fixtures) -> DataFrame:
    return text_index.indexed_matches(t.spark, _document_index(t), _terms(t.lists), "all")


@query
def kw_all(t: Fixtures) -> DataFrame:
    return keywords.keyword_matches(t.documents, keywords.clauses_of(_terms(t.lists), "all"), "doc_id")


@query
def kw_all_per_chunk(t: Fixtures) -> DataFrame:
    by_parts = [
        keywords.keyword_matches(t.documents, keywords.clauses_per_chunk(_terms(t.lists), n), "doc_id").withColumn(
            "n_chunks", F.lit(n)
        )
        for n in (1, 2)
    ]
    return by_parts[0].unionByName(by_parts[1])


@query
def kw_in_attachments(t: Fixtures) -> DataFrame:
    attachments = t.conversations.select(F.col("conv_id").alias("doc_id"), "text")
    by_policy = [
        keywords.attachment_matches(
            t.documents, attachments, keywords.clauses_of(_terms(t.lists), policy), "doc_id"
        ).withColumn("policy", F.lit(policy))
        for policy in keywords.POLICIES
    ]
    return by_policy[0].unionByName(by_policy[1])


def _item_words(t: Fixtures) -> DataFrame:
    """Each benchmark passage is a list of its words of seven letters and more."""
    words = F.filter(F.array_distinct(F.split("text", keywords.TOKEN_BREAK)), lambda w: F.length(w) >= 7)
    return t.benchmark.select(F.concat(F.lit("item_"), "item_id").alias("list_id"), F.explode(words).alias("term"))


@query
def kw_dictionary(t: Fixtures) -> DataFrame:
    """Hundreds of terms: one dictionary."""
    return keywords.keyword_matches(t.documents, keywords.clauses_of(_item_words(t), "any"), "doc_id")


@query
def kw_slices(t: Fixtures) -> DataFrame:
    """The same terms in several dictionaries, all of a list wanted; attachments are further texts of an id."""
    texts = t.documents.select("doc_id", "text").unionByName(t.conversations.select(F.col("conv_id").alias("doc_id"), "text"))
    return keywords.keyword_matches(texts, keywords.clauses_of(_item_words(t), "all"), "doc_id", dictionary_terms=50)


@query
def kw_tokens(t: Fixtures) -> DataFrame:
    """Each benchmark passage is a list of its tokens; a text matches with all of them."""
    words = F.explode(F.array_distinct(F.split("text", keywords.TOKEN_BREAK)))
    passages = t.benchmark.select(F.concat(F.lit("item_"), "item_id").alias("list_id"), words.alias("term"))
    terms = _terms(t.lists).select("list_id", "term").unionByName(passages)
    return keywords.token_matches(t.documents, keywords.clauses_of(terms, "all"), "doc_id")


# Code search


def _many_codes(t: Fixtures) -> DataFrame:
    """The code lists and, for each item, a list entry that may or may not be a tree code."""
    entry = F.when(F.col("item_id") % 3 == 0, F.concat("code", F.lit("7"))).otherwise(F.expr("substring(code, 1, 7 + item_id % 6)"))
    made = t.items.select(F.concat(F.lit("items_"), F.expr("item_id div 50")).alias("list_id"), entry.alias("code"))
    return _codes(t.code_lists).unionByName(made)


@query
def code_resolve(t: Fixtures) -> DataFrame:
    return codes.resolved_codes(_many_codes(t), t.code_tree).select("list_id", "code")


@query
def code_unresolved(t: Fixtures) -> DataFrame:
    return codes.unresolved_codes(_many_codes(t), t.code_tree).select("list_id", "code")


@query
def code_subtree(t: Fixtures) -> DataFrame:
    return codes.code_subtree(t.items, _codes(t.code_lists))


@query
def code_search(t: Fixtures) -> DataFrame:
    return codes.code_search(t.items, _codes(t.code_lists), t.code_tree)


@query
def code_unmatched(t: Fixtures) -> DataFrame:
    return search.unmatched_list_codes(_many_codes(t), t.code_tree)


# Joins


@query
def new_nums_44(t: Fixtures) -> DataFrame:
    return registry.new_numbers(filters.valid_numbers(t.notices), t.registry, "44").select("notice_num")


@query
def new_rows_223(t: Fixtures) -> DataFrame:
    rows = filters.valid_numbers(t.notices).select("notice_id", "law", "notice_num")
    return registry.new_rows(rows, t.registry, "223").select("notice_id", "notice_num")


@query
def registry_null_id(t: Fixtures) -> DataFrame:
    return registry.new_numbers(t.notices, t.registry_gaps)


def _sketched(t: Fixtures, rows: DataFrame) -> str:
    """The registry rows landed in two portions."""
    path = new_path(t.spark, "sketched-registry")
    for i in range(2):
        registry_sketch.land_registry(rows.filter(F.pmod(F.xxhash64("notificationnumber", "id_notification"), F.lit(2)) == i), path, str(i))
    return path


@query
def new_nums_44_sketched(t: Fixtures) -> DataFrame:
    numbers = filters.valid_numbers(filters.law_filter(t.notices, "44"))
    return registry_sketch.new_numbers_by_sketch(t.spark, _sketched(t, t.registry), numbers).select("notice_num")


@query
def registry_null_id_sketched(t: Fixtures) -> DataFrame:
    return registry_sketch.new_numbers_by_sketch(t.spark, _sketched(t, t.registry_gaps), t.notices)


@query
def known_nums(t: Fixtures) -> DataFrame:
    return registry.known_numbers(t.notices, t.registry)


@query
def enrich_223(t: Fixtures) -> DataFrame:
    rows = enrich.enrich_223(filters.law_filter(t.hrefs, "223").select("notice_num", "href"), t.detail_pages)
    empty = F.lit("")
    return rows.select(
        "notice_num",
        "href",
        F.coalesce("noticeinfoid", empty).alias("noticeinfoid"),
        F.coalesce("pfid", empty).alias("pfid"),
    )


@query
def facet_resolve(t: Fixtures) -> DataFrame:
    return facets.facet_resolve(_facet_labels(t), WANTED_FACETS)


@query
def facet_resolve_joined(t: Fixtures) -> DataFrame:
    """Each customer's name within part of its region, and suppliers' names, which no label has."""
    labels = _facet_labels(t)
    customers = labels.select(F.substring("facet", 2, 3).alias("facet"), F.expr("right(option, 6)").alias("option"))
    wanted = customers.unionByName(t.supplier.select(F.lit("asia").alias("facet"), F.col("s_name").alias("option")))
    return facets.facet_resolve_joined(labels, wanted)


# Windows, dedupe, aggregation, set operations


@query
def chunk_terms_query(t: Fixtures) -> DataFrame:
    """The lists, and the parts of each brand as one more list."""
    brands = t.part.select(
        F.col("p_brand").alias("list_id"), F.col("p_partkey").cast("int").alias("pos"), F.col("p_name").alias("term")
    )
    return chunk_terms(_terms(t.lists).unionByName(brands), 4)


@query
def contiguous_pages(t: Fixtures) -> DataFrame:
    return pages.contiguous_pages(t.search_cards)


@query
def notice_numbers(t: Fixtures) -> DataFrame:
    numbered = pages.with_notice_numbers(t.search_cards).filter(F.col("notice_num").isNotNull())
    return numbered.select("search_id", "page_num", "card_pos", "notice_num")


@query
def url_notice_id(t: Fixtures) -> DataFrame:
    found = t.detail_pages.select("href", text.notice_info_id(F.col("final_url")).alias("noticeinfoid"))
    return found.filter(F.col("noticeinfoid").isNotNull())


@query
def url_pfid(t: Fixtures) -> DataFrame:
    link = text.first_link_with(F.split("icon_hrefs", " "), enrich.PFID_MARK)
    return t.detail_pages.select("href", text.pfid(link).alias("pfid"))


@query
def hit_count(t: Fixtures) -> DataFrame:
    """Hits per search as the site words them (`1 234`), and read back from the label."""
    count = F.col("hits")
    label = F.when(count < 1000, count.cast("string")).otherwise(
        F.concat(F.expr("hits div 1000").cast("string"), F.lit(" "), F.lpad((count % 1000).cast("string"), 3, "0"))
    )
    labelled = pages.hit_counts(t.search_cards).select("search_id", F.concat(F.lit("Найдено: "), label).alias("label"))
    hits = text.hit_count(F.col("label"))
    return labelled.select("search_id", hits.alias("hits"), text.full_pages(hits).alias("pages"))


def _collected(t: Fixtures) -> DataFrame:
    """Cards of four lists, the even pages landed twice."""
    cards = pages.with_notice_numbers(t.search_cards).filter(F.col("notice_num").isNotNull())
    cards = cards.withColumn("list_id", (F.col("search_id") % 4).cast("string"))
    return cards.unionByName(cards.filter(F.col("page_num") % 2 == 0))


@query
def dedupe_pairs(t: Fixtures) -> DataFrame:
    return pages.dedupe_pairs(_collected(t).select("list_id", "notice_num", "href"))


@query
def dedupe_nums(t: Fixtures) -> DataFrame:
    return pages.dedupe_numbers(_collected(t))


@query
def run_report(t: Fixtures) -> DataFrame:
    return registry.run_report(_by_search(filters.valid_numbers(t.notices)), t.registry)


@query
def counted_run(t: Fixtures) -> DataFrame:
    """Lists by number among four workers."""
    worker = F.pmod(F.col("list_id").cast("bigint"), F.lit(4))
    return counted.counted_run(_by_search(filters.valid_numbers(t.notices)), t.registry, new_path(t.spark, "runs"), RUN_AT, worker, 4)


@query
def union_results(t: Fixtures) -> DataFrame:
    by_words = filters.published_window(t.notices, AS_OF, 365)
    by_codes = filters.valid_numbers(filters.law_filter(t.notices, "44"))
    return pages.union_results(kw=by_words.select("notice_id", "notice_num"), okpd=by_codes.select("notice_id", "notice_num"))


# Scalar functions and end-to-end runs


@query
def output_line(t: Fixtures) -> DataFrame:
    line = text.output_line(F.col("notice_num"), F.col("noticeinfoid"), F.col("pfid"))
    rows = enrich.enrich_223(filters.law_filter(t.hrefs, "223").select("notice_num", "href"), t.detail_pages)
    return rows.select("notice_num", line.alias("line"))


@query
def date_labels(t: Fixtures) -> DataFrame:
    day = F.col("published_on")
    return t.notices.select(
        "notice_id", text.date_label(F.date_sub(day, 30)).alias("date_from"), text.date_label(day).alias("date_to")
    )


@query
def run_kw_44(t: Fixtures) -> DataFrame:
    return search.run_keywords(t.notices, t.registry, t.documents, _terms(t.lists), "44", "any", AS_OF, 2000)


def _attachments(t: Fixtures) -> DataFrame:
    return t.conversations.select(F.col("conv_id").alias("doc_id"), "text")


@query
def run_kw_44_attachments(t: Fixtures) -> DataFrame:
    """Both policies, with attachments."""
    runs = [
        search.run_keywords(
            t.notices, t.registry, t.documents, _terms(t.lists), "44", policy, AS_OF, 2000, attachments=_attachments(t)
        ).withColumn("policy", F.lit(policy))
        for policy in keywords.POLICIES
    ]
    return runs[0].unionByName(runs[1])


@query
def run_kw_223(t: Fixtures) -> DataFrame:
    return search.run_keywords(
        t.hrefs, t.registry, t.documents, _terms(t.lists), "223", "any", AS_OF, 2000, details=t.detail_pages
    )


@query
def run_223(t: Fixtures) -> DataFrame:
    return search.run_notices_223(t.hrefs, t.registry, t.detail_pages)


@query
def run_okpd_44(t: Fixtures) -> DataFrame:
    return search.run_codes(t.notices, t.registry, t.items, _codes(t.code_lists), t.code_tree, "44")


@query
def run_okpd_223(t: Fixtures) -> DataFrame:
    return search.run_codes(
        t.hrefs, t.registry, t.items, _codes(t.code_lists), t.code_tree, "223", details=t.detail_pages
    )


@query
def run_all(t: Fixtures) -> DataFrame:
    """Keyword and code runs under both laws, written by one sink and read back."""
    path = new_path(t.spark, "output")
    lines.write_lines(search.run_all([run_kw_44(t), run_kw_223(t)], [run_okpd_44(t), run_okpd_223(t)]), path, RUN_AT)
    return lines.read_lines(t.spark, path, with_source=True).select("source", "list_id", "line")


def _run_pages(t: Fixtures, law: str) -> DataFrame:
    """Lines, and the rejects with their reason."""
    found, rejects = search.run_pages(t.search_pages, t.registry, law, t.detail_pages)
    rejected = F.concat_ws(" ", "reason", "notice_num", "href")
    return found.withColumn("kind", F.lit("line")).unionByName(
        rejects.select("list_id", rejected.alias("line"), F.lit("reject").alias("kind"))
    )


@query
def run_pages_44(t: Fixtures) -> DataFrame:
    return _run_pages(t, "44")


@query
def run_pages_223(t: Fixtures) -> DataFrame:
    return _run_pages(t, "223")


# Streams


@query
def stream_lists_query(t: Fixtures) -> DataFrame:
    drop, archive, out, checkpoint = (new_path(t.spark, f"intake-{n}") for n in ("drop", "archive", "out", "state"))
    t.write_list_files(drop)
    stream_lists(t.spark, drop, archive, out, checkpoint).awaitTermination()
    return t.spark.read.parquet(out)


@query
def stream_new_notices_query(t: Fixtures) -> DataFrame:
    """All notices landed twice, newest first in six files, streamed with one file per batch."""
    landed, out, checkpoint = (new_path(t.spark, f"notices-{n}") for n in ("landed", "out", "state"))
    notices = t.notices.select("law", "notice_num", F.col("published_on").cast("timestamp").alias("published_ts"))
    first, last = notices.agg(F.min("published_ts"), F.max("published_ts")).first()
    step = (last - first) / 3
    for i in (2, 1, 0):
        newer = F.col("published_ts") >= F.lit(first + i * step)
        part = notices.filter(newer & (F.col("published_ts") < F.lit(first + (i + 1) * step)) if i < 2 else newer)
        for _ in range(2):
            part.coalesce(1).write.mode("append").parquet(landed)
    stream_new_notices(
        t.spark, landed, notices.schema, lambda: t.registry, out, checkpoint, window_days=30, files_per_batch=1
    ).awaitTermination()
    return t.spark.read.parquet(out).select("law", "notice_num")


@query
def stream_open_notices(t: Fixtures) -> DataFrame:
    """Three weekly runs over what has landed until then; the registry learns a third of its rows before each."""
    landed, out, runs, state = (new_path(t.spark, f"open-{n}") for n in ("landed", "out", "runs", "state"))
    notices = t.notices.select("law", "notice_num", "published_on")
    landed_until = None
    for i, as_of in enumerate(AS_OF - timedelta(days=7 * k) for k in (2, 1, 0)):
        later = F.lit(True) if landed_until is None else F.col("published_on") > F.lit(landed_until)
        until = F.lit(True) if as_of == AS_OF else F.col("published_on") <= F.lit(as_of)
        notices.filter(later & until).write.mode("append").parquet(landed)
        landed_until = as_of
        known = t.registry.filter(F.col("id_notification") % 3 <= i)
        report_run(t.spark, landed, notices.schema, lambda: known, out, runs, state, as_of, 30).awaitTermination()
    return t.spark.read.parquet(out).select(F.col("run_on").cast("string").alias("run_on"), "law", "notice_num")


@query
def stream_contiguous_pages(t: Fixtures) -> DataFrame:
    """All result pages landed in three portions, later pages first; the stream goes on after each."""
    landed, out, state = (new_path(t.spark, f"pages-{n}") for n in ("landed", "out", "state"))
    found = t.search_pages
    for i in (2, 0, 1):
        found.filter(F.col("page_num") % 3 == i).write.mode("append").parquet(landed)
        stream_pages(t.spark, landed, out, state, found.schema).awaitTermination()
    return t.spark.read.parquet(out).filter("not coalesce(given_up, false)").select("search_id", "page_num", "card_pos", "label", "href")


@query
def stream_kw_44(t: Fixtures) -> DataFrame:
    """Both policies over notices, texts and attachments that land in three portions, each in another order.

    The streams go on after each portion: the number of files it has, which grows with the
    tables, then makes no more batches.
    """
    out, state = ({p: new_path(t.spark, n) for p in keywords.POLICIES} for n in ("matches", "matches-state"))
    notices, texts = new_path(t.spark, "landed-notices"), new_path(t.spark, "landed-texts")
    own = t.notices.select("notice_id", "law", "notice_num", "published_on")
    for i in range(3):
        at = F.lit(datetime(2001, 8, 1, 6 * i)).alias("landed_at")
        own.filter(F.col("notice_id") % 3 == i).select("*", at).write.mode("append").parquet(notices)
        parts = t.documents.filter(F.col("doc_id") % 3 == (i + 1) % 3).select("doc_id", "text")
        parts = parts.unionByName(_attachments(t).filter(F.col("doc_id") % 3 == (i + 2) % 3))
        parts.select("*", at).write.mode("append").parquet(texts)
        schema = t.spark.read.parquet(notices).schema
        for policy in keywords.POLICIES:
            stream_keyword_run(
                t.spark, notices, schema, texts, _terms(t.lists), lambda: t.registry, out[policy], state[policy], "44", policy, (AS_OF, 2000)
            ).awaitTermination()
    runs = []
    for policy in keywords.POLICIES:
        lines_of = t.spark.read.schema("list_id string, notice_num string").parquet(f"{out[policy]}/lines")
        runs.append(lines_of.select(F.lit(policy).alias("policy"), "list_id", F.col("notice_num").alias("line")))
    return runs[0].unionByName(runs[1])
