"""Keyword search: which lists does a text match.

A term matches by case-insensitive literal containment in the whole text. Under policy
`any` a list matches when one of its terms does, under `all` when every one does. All texts
of an id count together: under `all` the terms may be in different ones.

A list is kept as clauses (list_id, clause, term): it matches when all terms of one of its
clauses are found. `any` makes each term a clause, `all` makes the list one clause, and
the chunked mode makes each chunk one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_, or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticemill.operators.chunks import chunk_terms
from noticemill.operators.skew import key_counts, skew_join
from noticemill.session import file_system, new_path, stage

POLICIES = ("any", "all")
# Up to this many terms are searched one by one inside the JVM; beyond it one dictionary
# pass over the text is faster (measured: from about ten terms on).
LITERAL_TERMS = 16
# Terms of one dictionary. More terms mean more dictionaries, which a task loads one after
# the other for every `HELD_CHARACTERS` of text that it has read.
DICTIONARY_TERMS = 200_000
HELD_CHARACTERS = 32_000_000
# What separates tokens.
TOKEN_BREAK = r"[^\p{L}\p{N}]+"


def check_policy(policy: str) -> str:
    if policy not in POLICIES:
        raise ValueError(f"keyword policy must be one of {POLICIES}, not {policy!r}")
    return policy


def clauses_of(lists: DataFrame, policy: str) -> DataFrame:
    """(list_id, term) to distinct (list_id, clause, term) with lower-case terms."""
    term = F.lower("term")
    clause = term if check_policy(policy) == "any" else F.lit("")
    return lists.filter(F.col("term") != "").select("list_id", clause.alias("clause"), term.alias("term")).distinct()


def clauses_per_chunk(lists: DataFrame, parts: int) -> DataFrame:
    """Clauses of the mode that cuts a list into parts and wants all terms of a part."""
    chunked = chunk_terms(lists.filter(F.col("term") != ""), parts)
    return chunked.select("list_id", F.col("chunk").cast("string").alias("clause"), F.lower("term").alias("term")).distinct()


def keyword_matches(
    texts: DataFrame, clauses: DataFrame, id_col: str, text_col: str = "text", dictionary_terms: int = DICTIONARY_TERMS
) -> DataFrame:
    """Distinct (list_id, id) of the lists that the texts of an id match.

    The texts are scanned once and not shuffled, however many terms there are; what moves
    is the terms found per id.
    """
    found = found_terms(texts, clauses.select("term"), [id_col], text_col, dictionary_terms)
    inline = _rows_up_to(clauses, LITERAL_TERMS)
    if inline is None:
        return lists_satisfied(found, clauses, id_col)
    # at most LITERAL_TERMS different terms, combined in the map tasks: any number of texts is fine
    per_id = found.groupBy(id_col).agg(F.collect_set("term").alias("_found"))
    matched = _matched_lists(inline, lambda term: F.array_contains("_found", F.lit(term)))
    return per_id.select(F.explode(matched).alias("list_id"), id_col)


def _rows_up_to(table: DataFrame, limit: int) -> list | None:
    """The rows of a small table in order; None when there are more than `limit`."""
    rows = table.limit(limit + 1).collect()
    return sorted(rows) if len(rows) <= limit else None


def _matched_lists(clauses: list, has: Callable[[str], Column]) -> Column:
    """Array of the lists of which some clause has all its terms, as plain predicates."""
    by_list: dict[str, dict[str, list[Column]]] = {}
    for list_id, clause, term in clauses:
        by_list.setdefault(list_id, {}).setdefault(clause, []).append(has(term))
    return _present(
        [
            F.when(reduce(or_, [reduce(and_, terms) for terms in of_list.values()]), F.lit(list_id))
            for list_id, of_list in by_list.items()
        ]
    )


def found_terms(
    texts: DataFrame, terms: DataFrame, id_cols: list[str], text_col: str = "text", dictionary_terms: int = DICTIONARY_TERMS
) -> DataFrame:
    """(ids…, term) for every term a text contains, each once per text. No text is shuffled."""
    terms = terms.select("term").distinct()
    lowered = texts.select(*id_cols, F.lower(text_col).alias("_text"))
    inline = _rows_up_to(terms, LITERAL_TERMS)
    if inline is not None:
        found = [F.when(F.contains(F.col("_text"), F.lit(term)), F.lit(term)) for (term,) in inline]
        return lowered.select(*id_cols, F.explode(_present(found)).alias("term"))
    return _dictionary_pass(lowered, terms, id_cols, dictionary_terms)


def _present(values: list[Column]) -> Column:
    """The non-NULL values as an array."""
    return F.array_compact(F.array(*values).cast("array<string>"))


def _finder(words: list[str]) -> Callable[[str], set[str]]:
    """A function that gives the words a text contains, in one pass over the text."""
    import ahocorasick

    if not words:
        return lambda text: set()
    automaton = ahocorasick.Automaton()
    for word in words:
        automaton.add_word(word, word)
    automaton.make_automaton()
    return lambda text: {word for _, word in automaton.iter(text)}


# The dictionary a worker has loaded last: (folder, number) and its finder.
_loaded: dict[tuple[str, int], Callable[[str], set[str]]] = {}


def _dictionary(path: str, number: int) -> Callable[[str], set[str]]:
    import pyarrow.dataset as ds

    if (path, number) not in _loaded:
        _loaded.clear()
        folder, root = file_system(path)
        stored = ds.dataset(f"{root}/number={number}", filesystem=folder, format="parquet")
        _loaded[path, number] = _finder(stored.to_table(columns=["term"]).column("term").to_pylist())
    return _loaded[path, number]


def _dictionary_pass(lowered: DataFrame, terms: DataFrame, id_cols: list[str], dictionary_terms: int) -> DataFrame:
    """The terms of all dictionaries that each text contains, in one scan of the texts.

    The dictionaries are written to the shared folder and never pass through the driver. A
    task holds texts up to `HELD_CHARACTERS`, goes through the dictionaries one by one and
    hands the found terms on before it reads more.
    """
    path = new_path(lowered.sparkSession, "dictionaries")
    number = F.pmod(F.xxhash64("term"), F.lit(max(1, -(-terms.count() // dictionary_terms)))).alias("number")
    numbered = stage(terms.select(number, "term"), "terms")
    numbers = sorted(row.number for row in numbered.select("number").distinct().toLocalIterator())
    numbered.repartition("number").write.partitionBy("number").parquet(path)
    schema = T.StructType([*lowered.select(*id_cols).schema.fields, T.StructField("term", T.StringType())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def found() -> Iterator[pa.RecordBatch]:
            texts = [text or "" for batch in held for text in batch.column("_text").to_pylist()]
            ids = pa.Table.from_batches(held).select(id_cols)
            for k in numbers:
                find = _dictionary(path, k)
                hits = [(i, term) for i, text in enumerate(texts) for term in find(text)]
                rows = ids.take(pa.array([i for i, _ in hits], pa.int64()))
                yield from rows.append_column("term", pa.array([term for _, term in hits], pa.string())).to_batches()

        for batch in batches:
            held.append(batch)
            size += sum(len(text or "") for text in batch.column("_text").to_pylist())
            if size >= HELD_CHARACTERS:
                yield from found()
                held, size = [], 0
        if held:
            yield from found()

    return lowered.mapInArrow(search, schema)


def lists_satisfied(found: DataFrame, clauses: DataFrame, id_col: str) -> DataFrame:
    """Distinct (list_id, id) from the terms found per id: some clause has all its terms.

    Only ids and terms move, once: the terms of an id are gathered, combined in the map
    tasks, and written. An id is tried for a clause only when it has the clause's
    rarest term, so terms found almost everywhere do not multiply ids by lists; for what is
    tried the id's terms are compared with the clause's.
    """
    wanted = found.join(clauses.select("term").distinct(), "term", "left_semi")
    per_id = stage(wanted.groupBy(id_col).agg(F.collect_set("term").alias("_found")), "found")
    found = per_id.select(id_col, F.explode("_found").alias("term"))
    counts = key_counts(found, ["term"])
    per_clause = _with_rarest(clauses, counts)
    tried = stage(_tried(found, per_clause, id_col, counts), "tried")
    single = tried.filter(F.col("_size") == 1).select("list_id", id_col)
    several = _with_terms(tried, clauses, id_col).join(per_id, id_col)
    complete = several.filter(F.size(F.array_except("_terms", "_found")) == 0).select("list_id", id_col)
    return single.unionByName(complete).distinct()


def _with_rarest(clauses: DataFrame, counts: DataFrame) -> DataFrame:
    """(list_id, clause, term, _size): the term that fewest ids have, and how many terms there are."""
    rarity = F.struct(F.coalesce("_rows", F.lit(0)), F.col("term").alias("term"))
    per_clause = clauses.join(counts, "term", "left").groupBy("list_id", "clause")
    return per_clause.agg(F.min(rarity).getField("term").alias("term"), F.count(F.lit(1)).alias("_size"))


def _tried(found: DataFrame, per_clause: DataFrame, id_col: str, counts: DataFrame) -> DataFrame:
    """(list_id, clause, _size, id) of the ids that have a clause's rarest term.

    A rarest term may still be that of very many ids: such terms are spread. Their clauses
    are gathered in one row per term, as the spreading join needs.
    """
    per_term = per_clause.groupBy("term").agg(F.collect_list(F.struct("list_id", "clause", "_size")).alias("_clauses"))
    joined = skew_join(found, per_term, ["term"], "inner", [id_col], counts)
    return joined.select(id_col, F.inline("_clauses"))


def _with_terms(tried: DataFrame, clauses: DataFrame, id_col: str) -> DataFrame:
    """The tried ids of clauses with more than one term, each with the clause's terms as `_terms`.

    A list may be tried for very many ids, so these are spread.
    """
    terms = clauses.groupBy("list_id", "clause").agg(F.collect_set("term").alias("_terms"))
    wanted = tried.filter(F.col("_size") > 1).select("list_id", "clause", "_size", id_col).distinct()
    return skew_join(wanted, terms, ["list_id", "clause"], "inner", [id_col])


def attachment_matches(
    notice_texts: DataFrame, attachments: DataFrame, clauses: DataFrame, id_col: str, text_col: str = "text"
) -> DataFrame:
    """Distinct (list_id, id) matching in the notice text or its attachments.

    Both sides bring `id_col` and `text_col`, one row per part. Under `all` the terms may
    be in different parts.
    """
    parts = notice_texts.select(id_col, text_col).unionByName(attachments.select(id_col, text_col))
    return keyword_matches(parts, clauses, id_col, text_col)


def token_matches(texts: DataFrame, clauses: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """Distinct (list_id, id) by whole tokens in place of containment: for very many terms.

    A term that is no single token matches nothing. The texts are read once; of their
    tokens only those that are terms move, each once per text, whole texts never. Where
    Spark can't broadcast the terms, the distinct tokens of each text move to meet them.
    """
    tokens = F.array_distinct(F.split(F.lower(text_col), TOKEN_BREAK))
    return lists_satisfied(texts.select(id_col, F.explode(tokens).alias("term")), clauses, id_col)
