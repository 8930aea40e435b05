"""SQL (DuckDB) for the queries that SQL can express."""

from __future__ import annotations

RULE_LEDGER = r"""
with base as (
  select doc_id, coalesce(text, '') as text,
    [x for x in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''] as words,
    [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] as lines
  from documents),
windows as (
  select doc_id, i, words[i] || chr(10) || words[i + 1] || chr(10) || words[i + 2] as w
  from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from base)),
again as (
  select doc_id, i from (select *, count(*) over (partition by doc_id, w) as n from windows) where n > 1),
covered as (
  select doc_id, count(distinct p)::bigint as n_repeat_words
  from (select doc_id, unnest([i, i + 1, i + 2]) as p from again) group by doc_id),
counted as (
  select b.doc_id, len(words)::bigint as n_words,
    coalesce(list_sum([length(x) for x in words]), 0)::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    len(lines)::bigint as n_lines,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(c.n_repeat_words, 0)::bigint as n_repeat_words
  from base b left join covered c on b.doc_id = c.doc_id),
judged as (
  select *, (n_words < 50 or 100 * n_repeat_words > 50 * n_words) as base_failed from counted)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (not base_failed and not (5 * n_symbols > word_chars) and not (2 * n_dup_lines > n_lines)
    and not (word_chars < 2 * n_words) and not (word_chars > 20 * n_words)) as kept
from judged
"""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

DECONTAMINATION = f"""
with docs as (select doc_id, {_WORDS} as w from documents),
items as (select item_id, {_WORDS} as w from benchmark),
sizes as (select *, least(13, len(w)) as m from items where len(w) > 0),
sought as (
  select distinct item_id, m, array_to_string(w[s:s + m - 1], ' ') as g
  from (select item_id, m, w, unnest(range(1, len(w) - m + 2)) as s from sizes)),
places as (
  select doc_id, m, s, array_to_string(w[s:s + m - 1], ' ') as g
  from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as s
        from docs, (select distinct m from sizes) where len(w) >= m)),
hits as (select doc_id, item_id, s, p.m as m from places p join sought q on p.m = q.m and p.g = q.g),
counted as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(range(s, s + m)) as p from hits) group by doc_id),
named as (
  select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct doc_id, item_id::varchar as id from hits) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256,
  (coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w)) as contaminated
from docs d left join counted c on d.doc_id = c.doc_id left join named n on d.doc_id = n.doc_id
"""

SUBSTRING_DEDUP = r"""
with docs as (
  select doc_id, [x for x in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''] as w from documents),
places as (
  select doc_id, s, array_to_string(w[s:s + 12], ' ') as g
  from (select doc_id, w, unnest(range(1, len(w) - 11)) as s from docs)),
repeated as (select doc_id, s from (select *, min(doc_id) over (partition by g) as first_doc from places) where first_doc < doc_id),
gone as (select distinct doc_id, unnest(range(s, s + 13)) as p from repeated),
kept as (
  select d.doc_id, string_agg(word, ' ' order by d.p) as words
  from (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from docs) d
  anti join gone g on d.doc_id = g.doc_id and d.p = g.p group by d.doc_id),
counted as (select doc_id, count(*) as n from gone group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, sha256(coalesce(words, '')) as kept_sha256
from docs d left join kept k on d.doc_id = k.doc_id left join counted c on d.doc_id = c.doc_id
"""

REPEATED_PASSAGES = r"""
with docs as (
  select doc_id, [x for x in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''] as w from documents),
places as (
  select doc_id, s, md5(array_to_string(w[s:s + 49], ' ')) as g
  from (select doc_id, w, unnest(range(1, len(w) - 48)) as s from docs)),
firsts as (
  select doc_id, s, first_value(doc_id) over earliest as of_doc_id, first_value(s) over earliest as of_s
  from places window earliest as (partition by g order by doc_id, s)),
repeated as (select * from firsts where of_doc_id < doc_id or of_s < s),
marked as (
  select *, case when s <= lag(s) over (partition by doc_id order by s) + 50 then 0 else 1 end as new from repeated),
numbered as (select *, sum(new) over (partition by doc_id order by s) as run from marked)
select doc_id, (min(s) - 1)::bigint as first_word, (max(s) + 50 - min(s))::bigint as n_words,
  arg_min(of_doc_id, s) as of_doc_id, (arg_min(of_s, s) - 1)::bigint as of_first_word
from numbered group by doc_id, run
"""

# crc32 of a short text: bit by bit over its bytes.
_CRC32 = """xor(list_reduce([unicode(x)::ubigint for x in string_split({text}, '')],
    lambda c, b: list_reduce(range(8)::ubigint[], lambda d, i: xor(d >> 1, 3988292384::ubigint * (d & 1)), xor(c, b)),
    4294967295::ubigint), 4294967295::ubigint)"""


def _length_and_value(column: str) -> str:
    return f"coalesce(strlen({column}::varchar)::varchar || ':' || {column}::varchar, '-')"


MERKLE_MANIFEST = f"""
with recursive base as (
  select doc_id, coalesce('x' || lang, '') as tree, {" || ".join(map(_length_and_value, ("doc_id", "source", "lang", "n_chars")))} as head, text,
    case when {_CRC32.format(text="doc_id::varchar")} % 3 = 0
      then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end as claimed
  from documents),
hashed as (
  select doc_id, tree, sha256(head || {_length_and_value("text")}) as leaf, sha256(head || {_length_and_value("claimed")}) as claimed from base),
leaves as (
  select *, row_number() over (order by tree, doc_id nulls first, leaf) as row,
    row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as idx, count(*) over (partition by tree) as n
  from hashed),
levels as (
  select tree, 0 as level, idx, n, leaf as h from leaves
  union all
  select tree, level + 1, idx // 8, (max(n) + 7) // 8, sha256(string_agg(h, '' order by idx))
  from levels where n > 1 group by tree, level, idx // 8),
subroots as (
  select tree, level, h, row_number() over (order by tree) - 1 as idx, count(*) over () as n from levels where n = 1),
tops as (
  select 0 as level, idx, n, h from subroots
  union all
  select level + 1, idx // 8, (max(n) + 7) // 8, sha256(string_agg(h, '' order by idx)) from tops where n > 1 group by level, idx // 8),
places as (
  select tree, level, idx, h, tree as up, level + 1 as up_level, idx // 8 as run, idx as rank from levels where n > 1
  union all select s.tree, s.level, 0, s.h, 'root', 1, s.idx // 8, s.idx from subroots s where n > 1
  union all select 'root', level, idx, h, 'root', level + 1, idx // 8, idx from tops where n > 1 and level > 0),
links as (
  select *, coalesce(string_agg(h, '') over (partition by up, up_level, run order by rank rows between unbounded preceding and 1 preceding), '') as before,
    coalesce(string_agg(h, '') over (partition by up, up_level, run order by rank rows between 1 following and unbounded following), '') as after
  from places),
climb as (
  select row, tree, 0::bigint as level, idx::bigint as idx, '' as proof, claimed as folded from leaves
  union all
  select c.row, l.up, l.up_level::bigint, l.run::bigint, c.proof || l.before || l.after, sha256(l.before || c.folded || l.after)
  from climb c join links l on c.tree = l.tree and c.level = l.level and c.idx = l.idx),
ended as (select row, arg_max(proof, strlen(proof) * 100 + (tree = 'root')::int * 50 + level) as proof,
    arg_max(folded, strlen(proof) * 100 + (tree = 'root')::int * 50 + level) as folded from climb group by row),
root as (select h from tops where n = 1)
select doc_id, leaf, s.h as subroot, r.h as root, sha256(e.proof) as proof_sha256, e.folded as folded_root, e.folded = r.h as verified
from leaves l join ended e on l.row = e.row join subroots s on l.tree = s.tree, root r
"""


CONVERSATION_REPAIR = rf"""
with recursive keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    {_CRC32.format(text="(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))")} % 20 as code
  from conversations),
damaged as (
  select conv_id, turn, case when code = 4 then 'user' else role end as role,
    case when code = 1 then '' when code = 2 then translate(text, '.!?', '') else text end as text,
    unnest(case when code = 3 then [1, 2] else [1] end) as copy
  from keyed where code <> 0),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body
  from damaged),
faults as (
  select conv_id, turn, role, text, i, left(role, 1) as initial, lag(left(role, 1)) over (partition by conv_id order by i) as before,
    case when body = '' then 'blank' when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
      when right(body, 1) not in ('.', '!', '?') then 'truncated' else 'fine' end as fault
  from placed),
counted as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
    count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal
  from faults group by conv_id),
edits(q, edit, initial, to_q, price, role) as (values
  (0, 'D', null, 0, 2, null), (1, 'D', null, 1, 2, null), (2, 'D', null, 2, 2, null), (3, 'D', null, 3, 2, null),
  (0, 'K', 's', 1, 0, null), (0, 'K', 'u', 2, 0, null), (1, 'K', 'u', 2, 0, null), (3, 'K', 'u', 2, 0, null), (2, 'K', 'a', 3, 0, null),
  (0, 'R', null, 2, 1, 'user'), (1, 'R', null, 2, 1, 'user'), (3, 'R', null, 2, 1, 'user'), (2, 'R', null, 3, 1, 'assistant')),
added(q, letters, to_q, price, rows) as (values
  (0, '', 0, 0, []::varchar[]), (1, '', 1, 0, []), (2, '', 2, 0, []), (3, '', 3, 0, []),
  (0, 'I', 2, 5, ['user:']), (1, 'I', 2, 5, ['user:']), (2, 'I', 3, 5, ['assistant:']), (3, 'I', 2, 5, ['user:']),
  (0, 'II', 3, 10, ['user:', 'assistant:']), (1, 'II', 3, 10, ['user:', 'assistant:']),
  (2, 'II', 2, 10, ['assistant:', 'user:']), (3, 'II', 3, 10, ['user:', 'assistant:'])),
walk(conv_id, i, q, cost, audit, rows) as (
  select conv_id, 0::bigint, to_q, price, letters, rows from (select distinct conv_id from conversations), added where q = 0
  union all
  select conv_id, i, q, min(cost), arg_min(audit, lpad(cost::varchar, 9, '0') || audit), arg_min(rows, lpad(cost::varchar, 9, '0') || audit)
  from (
    select w.conv_id, f.i, a.to_q as q, w.cost + e.price + a.price + case when f.fault = 'truncated' and edit <> 'D' then 5 else 0 end as cost,
      w.audit || edit || letters as audit,
      w.rows || case edit when 'D' then []::varchar[] else [coalesce(e.role, f.role) || ':' || f.text] end || a.rows as rows
    from walk w join faults f on f.conv_id = w.conv_id and f.i = w.i + 1
    join edits e on e.q = w.q and (e.initial is null or e.initial = f.initial) and (edit = 'D' or f.fault in ('fine', 'truncated'))
    join added a on a.q = e.to_q)
  group by conv_id, i, q),
ended as (
  select w.conv_id, min(cost) as cost, arg_min(audit, lpad(cost::varchar, 9, '0') || audit) as audit, arg_min(rows, lpad(cost::varchar, 9, '0') || audit) as rows
  from walk w left join counted c on c.conv_id = w.conv_id where w.i = coalesce(n, 0) and q in (0, 3) group by w.conv_id)
select e.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
  coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, cost::bigint as cost, audit,
  sha256(array_to_string(rows, chr(10))) as repaired_sha256
from ended e left join counted c on c.conv_id = e.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_decontamination": DECONTAMINATION,
        "op6_suffix_automata": SUBSTRING_DEDUP,
        "op9_rule_ledger": RULE_LEDGER,
        "op10_sparse_suffix_array": REPEATED_PASSAGES,
        "op11_merkle_manifest": MERKLE_MANIFEST,
        "op12_conversation_repair": CONVERSATION_REPAIR,
    }
