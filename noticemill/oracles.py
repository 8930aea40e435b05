"""The same results as DuckDB SQL, written from the definitions, not from the Spark plans."""

from __future__ import annotations

from noticemill.fixtures import with_fixtures

# White space as Python sees it, for RE2.
SPACE = r"[\t-\r\x1c-\x1f \x85\p{Z}]"
STRIPPED = f"regexp_replace(raw_term, '^{SPACE}+|{SPACE}+$', '', 'g')"
CARD_NUMBER = f"nullif(regexp_extract(label, '№{SPACE}?([0-9]+)', 1), '')"
VALID = (
    "((law = '44' and length(notice_num) = 19) or "
    "(law = '223' and length(notice_num) = 11 and notice_num[1] = '3'))"
)
FACETS = """
select c_custkey, r_name as facet, c_mktsegment || ' ' || n_name || ' ' || c_name as option
 from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""
KW = f"select list_id, lower({STRIPPED}) as term from lists where {STRIPPED} <> ''"
CODES = f"select list_id, {STRIPPED} as code from code_lists"
MANY_CODES = f"""
{CODES} union all select 'items_' || cast(item_id // 50 as varchar),
 case when item_id % 3 = 0 then code || '7' else substring(code, 1, 7 + item_id % 6) end from items"""
# the rule as it is worded: a selected code leads to an item
LEADS_TO = """(starts_with(i.code, c.code) or (length(i.code) = length(c.code) and c.code like '%0'
 and starts_with(i.code, substring(c.code, 1, length(c.code) - 1))))"""
SEARCH_CODES = f"""
select list_id, code from ({CODES}) w where code in (select code from code_tree)
 union select w.list_id, min(t.code) from ({CODES}) w join code_tree t on contains(t.code, w.code)
 where w.code not in (select code from code_tree) group by w.list_id, w.code"""
PAIRS = f"""
select cast(search_id % 4 as varchar) as list_id, {CARD_NUMBER} as notice_num, href from search_cards
 where {CARD_NUMBER} is not null"""
DETAIL = r"""
select href, case when final_url like '%zakupki%' and regexp_matches(final_url, 'noticeInfoId=\d')
 then regexp_extract(final_url, 'noticeInfoId=([0-9]+)', 1) else '' end as infoid,
 regexp_extract(icon_hrefs, 'pfid=([0-9]+)', 1) as pf from detail_pages"""
ENRICHED = f"""
select distinct n.notice_num, 'https://t.example/n/' || n.notice_num as href, coalesce(d.infoid, '') as noticeinfoid,
 case when coalesce(d.infoid, '') = '' then '' else d.pf end as pfid
 from notices n left join ({DETAIL}) d on d.href = 'https://t.example/n/' || n.notice_num where n.law = '223'"""
LINE_223 = "case when noticeinfoid = '' then notice_num else notice_num || ';' || noticeinfoid || ';' || pfid end"
UNKNOWN = "not exists (select 1 from registry r where r.notificationnumber = n.notice_num and r.law = n.law)"
ITEM_WORDS = r"""
select distinct 'item_' || cast(item_id as varchar) as list_id, lower(w) as term from (
 select item_id, unnest(regexp_split_to_array(text, '[^\p{L}\p{N}]+')) as w from benchmark) where length(w) >= 7"""
ATTACHED = f"""
select p.doc_id, k.list_id, k.term from (select doc_id, text from documents union all select conv_id, text from conversations) p
 join ({KW}) k on contains(lower(p.text), k.term)"""
IN_WINDOW = "n.published_on between date '2001-08-01' - 2000 and date '2001-08-01'"
# the keyword and code runs: list, notice
KW_HITS = f"""
select k.list_id, n.notice_id, n.law, n.notice_num from notices n
 join documents d on d.doc_id = n.notice_id join ({KW}) k on contains(lower(d.text), k.term)
 where {VALID} and {UNKNOWN} and {IN_WINDOW}"""
CODE_HITS = f"""
select c.list_id, n.notice_id, n.law, n.notice_num from notices n
 join items i on i.item_id = n.notice_id join ({SEARCH_CODES}) c on {LEADS_TO} where {VALID} and {UNKNOWN}"""


ATTACHED_HITS = f"""
select distinct n.notice_id, n.notice_num, a.list_id, a.term from notices n join ({ATTACHED}) a on a.doc_id = n.notice_id
 where n.law = '44' and {VALID} and {UNKNOWN} and {IN_WINDOW}"""


def lines_of(hits: str, law: str) -> str:
    if law == "44":
        return f"select list_id, notice_num as line from ({hits}) h where h.law = '44'"
    return f"""select list_id, {LINE_223} as line from ({hits}) h join ({ENRICHED}) e using (notice_num) where h.law = '223'"""


# cards up to the first missing page, distinct (list, number, link)
PAGE_PAIRS = f"""
select distinct cast(search_id as varchar) as list_id, {CARD_NUMBER} as notice_num, href from search_cards s
 where page_num = (select count(distinct p.page_num) from search_cards p
  where p.search_id = s.search_id and p.page_num <= s.page_num)"""


def page_run(law: str) -> str:
    shape = "length({0}) = 19" if law == "44" else "length({0}) = 11 and {0}[1] = '3'"
    found = "coalesce(d.infoid, '') <> ''" if law == "223" else "false"
    return f"""
    select distinct p.list_id, 'line' as kind,
     case when {found} then p.notice_num || ';' || d.infoid || ';' || d.pf else p.notice_num end as line
     from ({PAGE_PAIRS}) p left join ({DETAIL}) d on d.href = p.href
     where {shape.format("p.notice_num")} and not exists (
      select 1 from registry r where r.notificationnumber = p.notice_num and r.law = '{law}')
    union all select list_id, 'reject', concat_ws(' ', case when notice_num is null then 'no_number'
     when '{law}' = '223' and length(notice_num) = 11 then 'bad_prefix' else 'bad_length' end, notice_num, href)
     from ({PAGE_PAIRS}) where notice_num is null or not ({shape.format("notice_num")})"""


TERM_LINES = f"select list_id, pos, {STRIPPED} as term from raw_lines where {STRIPPED} <> ''"

# key: (SELECT, fixtures it reads)
ORACLES: dict[str, tuple[str, tuple[str, ...]]] = {
    "scan_lists": (
        "select list_id, cast(sum(octet_length(encode(raw_term)) + 1) as bigint) as n_bytes from raw_lines group by list_id",
        ("raw_lines",),
    ),
    "read_terms": (TERM_LINES, ("raw_lines",)),
    "scan_result_cards": ("select search_id, page_num, card_pos, label, href from search_cards", ("search_cards",)),
    "extract_links": (
        # cut at the anchors; the pages have no other quotes, no entities in links and no anchors in comments
        """select page_id, cast(generate_subscripts(l, 1) - 1 as int) as link_pos, unnest(l) as href
        from (select page_id, [split_part(split_part(split_part(a, '>', 1), 'href="', 2), '"', 1)
          for a in string_split(html, '<a ')[2:] if contains(split_part(a, '>', 1), 'href="')] as l from pages)""",
        (),
    ),
    "scan_registry": ("select id_notification, notificationnumber, law from registry where law = '44'", ("registry",)),
    "sink_lines": (
        f"""select distinct cast(search_id as varchar) as list_id, '01_08_2001_12_30_05' as run_ts, notice_num as line
        from notices n where law = '44' and {VALID} and {UNKNOWN}""",
        ("notices", "registry"),
    ),
    "compact_output": (
        f"select distinct cast(search_id as varchar) as list_id, notice_num as line from notices where {VALID}",
        ("notices",),
    ),
    "published_window": (
        """select notice_id, law, notice_num, cast(published_on as varchar) as published_on from notices
        where published_on >= date '2001-08-01' - 30 and published_on <= date '2001-08-01'""",
        ("notices",),
    ),
    "law_filter": ("select notice_id, law, notice_num from notices where law = '223'", ("notices",)),
    "valid_num_44": (
        "select notice_id, notice_num from notices where law = '44' and length(notice_num) = 19",
        ("notices",),
    ),
    "valid_num_223": (
        "select notice_id, notice_num from notices where law = '223' and length(notice_num) = 11 and notice_num like '3%'",
        ("notices",),
    ),
    "invalid_nums": (
        f"""select search_id, page_num, card_pos, law, coalesce(notice_num, '') as notice_num,
        case when notice_num is null then 'no_number' when law = '223' and length(notice_num) = 11 then 'bad_prefix'
        else 'bad_length' end as reason
        from (select *, {CARD_NUMBER} as notice_num from search_cards) where notice_num is null or not {VALID}""",
        ("search_cards",),
    ),
    "facet_filter": (
        f"""select c_custkey, facet, option from ({FACETS})
        where lower(option) like '%build%' or lower(option) like '%house%'""",
        (),
    ),
    "redirect_filter": (
        "select href, case when final_url like '%zakupki%' then final_url else '' end as site_url from detail_pages",
        ("detail_pages",),
    ),
    "first_link_with": (
        "select href, list_filter(string_split(icon_hrefs, ' '), lambda h: contains(h, 'pfid'))[1] as pfid_href from detail_pages",
        ("detail_pages",),
    ),
    "kw_any": (
        f"select distinct k.list_id, d.doc_id from documents d join ({KW}) k on contains(lower(d.text), k.term)",
        ("lists",),
    ),
    "kw_all": (
        f"""select k.list_id, d.doc_id from documents d join ({KW}) k on true group by 1, 2
        having bool_and(contains(lower(d.text), k.term))""",
        ("lists",),
    ),
    "kw_all_per_chunk": (
        f"""select distinct list_id, doc_id, n_chunks from (
        select k.list_id, d.doc_id, k.n_chunks, k.chunk from documents d join (
          select list_id, lower({STRIPPED}) as term, 1 as n_chunks, 1 as chunk from lists where {STRIPPED} <> ''
          union all select list_id, lower({STRIPPED}), 2, ntile(2) over (partition by list_id order by pos)
          from lists where {STRIPPED} <> '') k on true
        group by 1, 2, 3, 4 having bool_and(contains(lower(d.text), k.term)))""",
        ("lists",),
    ),
    "kw_in_attachments": (
        f"""select distinct 'any' as policy, list_id, doc_id from ({ATTACHED})
        union all select 'all', a.list_id, a.doc_id from ({ATTACHED}) a
        group by a.list_id, a.doc_id
        having count(distinct a.term) = (select count(distinct k.term) from ({KW}) k where k.list_id = a.list_id)""",
        ("lists",),
    ),
    "kw_dictionary": (
        f"select distinct k.list_id, d.doc_id from documents d join ({ITEM_WORDS}) k on contains(lower(d.text), k.term)",
        (),
    ),
    "kw_slices": (
        f"""select f.list_id, f.doc_id from (
          select distinct p.doc_id, k.list_id, k.term
          from (select doc_id, text from documents union all select conv_id, text from conversations) p
          join ({ITEM_WORDS}) k on contains(lower(p.text), k.term)) f
        join (select list_id, count(*) as n from ({ITEM_WORDS}) group by list_id) s on s.list_id = f.list_id
        group by f.list_id, f.doc_id, s.n having count(*) = s.n""",
        (),
    ),
    "kw_tokens": (
        rf"""select w.list_id, d.doc_id
        from (select distinct doc_id, unnest(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+')) as token from documents) d
        join (select distinct list_id, term, count(*) over (partition by list_id) as size from (
          {KW} union select 'item_' || cast(item_id as varchar), lower(unnest(regexp_split_to_array(text, '[^\p{{L}}\p{{N}}]+'))) from benchmark)
          where term <> '') w on w.term = d.token
        group by w.list_id, d.doc_id, w.size having count(*) = w.size""",
        ("lists",),
    ),
    "code_resolve": (
        f"select list_id, code from ({MANY_CODES}) w where exists (select 1 from code_tree t where t.code = w.code)",
        ("code_lists", "code_tree"),
    ),
    "code_unresolved": (
        f"select list_id, code from ({MANY_CODES}) w where not exists (select 1 from code_tree t where t.code = w.code)",
        ("code_lists", "code_tree"),
    ),
    "code_unmatched": (
        f"""select list_id, code from ({MANY_CODES}) w where not exists (select 1 from code_tree t where contains(t.code, w.code))""",
        ("code_lists", "code_tree"),
    ),
    "code_subtree": (
        f"select distinct c.list_id, i.item_id from items i join ({CODES}) c on {LEADS_TO}",
        ("code_lists", "items"),
    ),
    "code_search": (
        f"select distinct c.list_id, i.item_id from items i join ({SEARCH_CODES}) c on {LEADS_TO}",
        ("code_lists", "items", "code_tree"),
    ),
    "new_nums_44": (
        f"select distinct notice_num from notices n where law = '44' and length(notice_num) = 19 and {UNKNOWN}",
        ("notices", "registry"),
    ),
    "new_rows_223": (
        f"select notice_id, notice_num from notices n where law = '223' and {VALID} and {UNKNOWN}",
        ("notices", "registry"),
    ),
    "registry_null_id": (
        """select distinct n.law, n.notice_num from notices n left join registry_gaps r
        on r.law = n.law and r.notificationnumber = n.notice_num where r.id_notification is null""",
        ("notices", "registry_gaps"),
    ),
    "known_nums": (
        f"select distinct law, notice_num from notices n where not {UNKNOWN}",
        ("notices", "registry"),
    ),
    "enrich_223": (ENRICHED, ("notices", "detail_pages")),
    "facet_resolve": (
        f"""select w.facet, w.option, count(f.facet) as n_matched from (values ('asia', 'build'), ('europe', 'machinery'),
        ('America', 'nation_1 '), ('asia', 'unheard of'), ('antarctica', 'build')) w(facet, option)
        left join ({FACETS}) f on contains(lower(f.facet), lower(w.facet)) and contains(lower(f.option), lower(w.option))
        group by w.facet, w.option""",
        (),
    ),
    "facet_resolve_joined": (
        f"""select w.facet, w.option, count(f.facet) as n_matched from (select substring(facet, 2, 3) as facet, right(option, 6) as option
        from ({FACETS}) union select 'asia', s_name from supplier) w
        left join ({FACETS}) f on contains(lower(f.facet), lower(w.facet)) and contains(lower(f.option), lower(w.option))
        group by w.facet, w.option""",
        (),
    ),
    "chunk_terms": (
        f"""select list_id, pos, term, cast(ntile(4) over (partition by list_id order by pos) as int) as chunk
        from (select list_id, pos, {STRIPPED} as term from lists where {STRIPPED} <> ''
        union all select p_brand, cast(p_partkey as int), p_name from part)""",
        ("lists",),
    ),
    "contiguous_pages": (
        """select s.* from search_cards s where page_num = (select count(distinct p.page_num) from search_cards p
        where p.search_id = s.search_id and p.page_num <= s.page_num)""",
        ("search_cards",),
    ),
    "notice_numbers": (
        f"""select search_id, page_num, card_pos, {CARD_NUMBER} as notice_num from search_cards
        where {CARD_NUMBER} is not null""",
        ("search_cards",),
    ),
    "url_notice_id": (
        r"""select href, regexp_extract(final_url, 'noticeInfoId=(\d+)', 1) as noticeinfoid from detail_pages
        where regexp_matches(final_url, 'noticeInfoId=\d')""",
        ("detail_pages",),
    ),
    "url_pfid": (
        r"select href, regexp_extract(icon_hrefs, 'pfid=(\d+)', 1) as pfid from detail_pages",
        ("detail_pages",),
    ),
    "hit_count": (
        """select search_id, count(*) as hits, cast(floor(count(*) / 10) as bigint) as pages
        from search_cards group by search_id""",
        ("search_cards",),
    ),
    "dedupe_pairs": (f"select distinct list_id, notice_num, href from ({PAIRS})", ("search_cards",)),
    "dedupe_nums": (f"select distinct list_id, notice_num from ({PAIRS})", ("search_cards",)),
    "run_report": (
        f"""select cast(search_id as varchar) as list_id, law, count(*) as found_rows,
        count(distinct notice_num) as found_distinct, count(*) filter ({UNKNOWN}) as new_rows,
        count(distinct notice_num) filter ({UNKNOWN}) as new_distinct
        from notices n where {VALID} group by search_id, law""",
        ("notices", "registry"),
    ),
    "counted_run": (
        f"""select cast(w as int) as worker, count(n.notice_num) as found_rows, count(distinct (search_id, law, notice_num))
         filter (n.notice_num is not null) as found_distinct, count(distinct (search_id, law, notice_num)) filter (n.notice_num is not null and {UNKNOWN}) as new_distinct
        from range(4) r(w) left join (select * from notices n where {VALID}) n on n.search_id % 4 = w group by w""",
        ("notices", "registry"),
    ),
    "union_results": (
        """select 'kw' as source, notice_id, notice_num from notices
        where published_on between date '2001-08-01' - 365 and date '2001-08-01'
        union all select 'okpd', notice_id, notice_num from notices where law = '44' and length(notice_num) = 19""",
        ("notices",),
    ),
    "output_line": (f"select notice_num, {LINE_223} as line from ({ENRICHED})", ("notices", "detail_pages")),
    "date_labels": (
        """select notice_id, strftime(published_on - 30, '%d-%m-%Y') as date_from,
        strftime(published_on, '%d-%m-%Y') as date_to from notices""",
        ("notices",),
    ),
    "run_kw_44": (
        f"""select distinct 'kw' as source, k.list_id, n.notice_num as line from notices n
        join documents d on d.doc_id = n.notice_id join ({KW}) k on contains(lower(d.text), k.term)
        where n.law = '44' and length(n.notice_num) = 19 and {UNKNOWN}
        and n.published_on between date '2001-08-01' - 2000 and date '2001-08-01'""",
        ("lists", "notices", "registry"),
    ),
    "run_kw_44_attachments": (
        f"""select distinct 'any' as policy, 'kw' as source, list_id, notice_num as line from ({ATTACHED_HITS})
        union all select distinct 'all', 'kw', m.list_id, m.notice_num from ({ATTACHED_HITS}) m group by m.list_id, m.notice_num, m.notice_id
         having count(*) = (select count(distinct k.term) from ({KW}) k where k.list_id = m.list_id)""",
        ("lists", "notices", "registry"),
    ),
    "run_kw_223": (
        f"select distinct 'kw' as source, list_id, line from ({lines_of(KW_HITS, '223')})",
        ("lists", "notices", "registry", "detail_pages"),
    ),
    "run_okpd_223": (
        f"select distinct 'okpd' as source, list_id, line from ({lines_of(CODE_HITS, '223')})",
        ("code_lists", "items", "code_tree", "notices", "registry", "detail_pages"),
    ),
    "run_all": (
        f"""select distinct 'kw' as source, list_id, line from ({lines_of(KW_HITS, '44')} union all {lines_of(KW_HITS, '223')})
        union all select distinct 'okpd', list_id, line from ({lines_of(CODE_HITS, '44')} union all {lines_of(CODE_HITS, '223')})""",
        ("lists", "code_lists", "items", "code_tree", "notices", "registry", "detail_pages"),
    ),
    "run_pages_44": (page_run("44"), ("search_cards", "registry", "detail_pages")),
    "run_pages_223": (page_run("223"), ("search_cards", "registry", "detail_pages")),
    "run_223": (
        f"""select distinct {LINE_223} as line from ({ENRICHED}) n
        where length(notice_num) = 11 and notice_num like '3%'
        and notice_num not in (select notificationnumber from registry where law = '223')""",
        ("notices", "registry", "detail_pages"),
    ),
    "run_okpd_44": (
        f"""select distinct 'okpd' as source, c.list_id, n.notice_num as line from notices n
        join items i on i.item_id = n.notice_id join ({SEARCH_CODES}) c on {LEADS_TO}
        where n.law = '44' and length(n.notice_num) = 19 and {UNKNOWN}""",
        ("code_lists", "items", "code_tree", "notices", "registry"),
    ),
    "stream_lists": (TERM_LINES, ("raw_lines",)),
    "stream_new_notices": (
        f"select distinct law, notice_num from notices n where {VALID} and {UNKNOWN}",
        ("notices", "registry"),
    ),
    "stream_open_notices": (
        f"""select distinct run_on, law, notice_num from notices n,
         (values ('2001-07-18', 0), ('2001-07-25', 1), ('2001-08-01', 2)) as r(run_on, i)
        where {VALID} and published_on between run_on::date - 30 and run_on::date
         and not exists (select 1 from registry k where k.notificationnumber = n.notice_num and k.law = n.law and k.id_notification % 3 <= i)""",
        ("notices", "registry"),
    ),
    "stream_kw_44": (
        f"""select distinct 'any' as policy, list_id, notice_num as line from ({ATTACHED_HITS})
        union all select distinct 'all', m.list_id, m.notice_num from ({ATTACHED_HITS}) m group by m.list_id, m.notice_num, m.notice_id
         having count(*) = (select count(distinct k.term) from ({KW}) k where k.list_id = m.list_id)""",
        ("lists", "notices", "registry"),
    ),
    "stream_contiguous_pages": (
        """select search_id, page_num, card_pos, label, href from search_cards s where page_num = (select count(distinct p.page_num)
        from search_cards p where p.search_id = s.search_id and p.page_num <= s.page_num)""",
        ("search_cards",),
    ),
}

ORACLES["sink_runs"], ORACLES["compact_runs"] = ORACLES["sink_lines"], ORACLES["compact_output"]
ORACLES["new_nums_44_sketched"], ORACLES["registry_null_id_sketched"] = ORACLES["new_nums_44"], ORACLES["registry_null_id"]
# the index gives the rows of the scan
ORACLES["kw_any_indexed"], ORACLES["kw_all_indexed"] = ORACLES["kw_any"], ORACLES["kw_all"]


def oracle_sql() -> dict[str, str]:
    return {key: with_fixtures(sql, names) for key, (sql, names) in ORACLES.items()}
