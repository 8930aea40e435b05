import random

import pytest
from pyspark.sql import functions as F

from noticemill.operators import keywords
from noticemill.operators.keywords import (
    attachment_matches,
    clauses_of,
    clauses_per_chunk,
    found_terms,
    keyword_matches,
    lists_satisfied,
    token_matches,
)
from noticemill.session import stage
from tests.conftest import plan_of, rows

LISTS = {"any_a": ["Сосна", "ёлки"], "b": ["лекарство"], "c": ["a b", "c"], "d": ["zzz", "сосна"]}
TEXTS = ["СОСНА и ель", "Ёлки, сосна", "нет", "a B c", "xa bx", "", None, "лекарствоС", "c"]


def lists_df(spark, lists):
    data = [(name, i + 1, term) for name, terms in lists.items() for i, term in enumerate(terms)]
    return spark.createDataFrame(data, "list_id string, pos int, term string")


def texts_df(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def brute_force(texts, lists, policy):
    test = any if policy == "any" else all
    return sorted(
        (
            (name, i)
            for i, text in enumerate(texts)
            for name, terms in lists.items()
            if terms and text is not None and test(t.lower() in text.lower() for t in terms)
        ),
        key=repr,
    )


@pytest.fixture(params=["predicates", "dictionary", "slices"])
def tier(request, monkeypatch):
    """Each way to search, forced by its limit."""
    if request.param != "predicates":
        monkeypatch.setattr(keywords, "LITERAL_TERMS", 0)
    if request.param == "slices":
        for search in (keywords.keyword_matches, keywords.found_terms):
            monkeypatch.setattr(search, "__defaults__", tuple(2 if d == keywords.DICTIONARY_TERMS else d for d in search.__defaults__))
    return request.param


@pytest.mark.parametrize("policy", ["any", "all"])
def test_matches_are_those_of_brute_force(spark, tier, policy):
    got = keyword_matches(texts_df(spark, TEXTS), clauses_of(lists_df(spark, LISTS), policy), "doc_id")
    assert rows(got) == brute_force(TEXTS, LISTS, policy)


@pytest.mark.parametrize("policy", ["any", "all"])
def test_many_random_lists(spark, tier, policy):
    rng = random.Random(5)
    words = ["".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(30)]
    lists = {f"l{i}": rng.sample(words, rng.randint(1, 4)) for i in range(12)}
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 6))) for _ in range(60)]
    got = keyword_matches(texts_df(spark, texts), clauses_of(lists_df(spark, lists), policy), "doc_id")
    assert rows(got) == brute_force(texts, lists, policy)


def test_policy_is_checked(spark):
    for wrong in ("any  # (all/any)", "ALL", "", None):
        with pytest.raises(ValueError):
            clauses_of(lists_df(spark, LISTS), wrong)


@pytest.mark.parametrize("policy", ["any", "all"])
def test_empty_list_matches_nothing(spark, tier, policy):
    lists = lists_df(spark, {"blank": ["", ""]})
    assert rows(keyword_matches(texts_df(spark, TEXTS), clauses_of(lists, policy), "doc_id")) == []


def test_blank_and_repeated_terms_change_nothing(spark, tier):
    lists = lists_df(spark, {"a": ["сосна", "", "СОСНА", "ель"]})
    assert rows(keyword_matches(texts_df(spark, TEXTS), clauses_of(lists, "all"), "doc_id")) == [("a", 0)]


def test_chunks_are_between_all_and_any(spark, tier):
    texts, lists = texts_df(spark, TEXTS), lists_df(spark, LISTS)
    found = {n: set(rows(keyword_matches(texts, clauses_per_chunk(lists, n), "doc_id"))) for n in (1, 2, 5)}
    every = {p: set(rows(keyword_matches(texts, clauses_of(lists, p), "doc_id"))) for p in ("any", "all")}
    assert found[1] == every["all"]
    assert found[5] == found[2] == every["any"]
    assert found[1] <= found[2]


def test_terms_may_be_in_different_parts(spark, tier):
    notices = texts_df(spark, ["сосна", "сосна", "нет"])
    parts = spark.createDataFrame(
        [(0, "ёлки"), (0, "ёлки"), (2, "Ёлки"), (3, "СОСНА ёлки"), (1, "")], "doc_id bigint, text string"
    )
    lists = lists_df(spark, {"l": ["сосна", "ёлки"]})
    both = attachment_matches(notices, parts, clauses_of(lists, "all"), "doc_id")
    either = attachment_matches(notices, parts, clauses_of(lists, "any"), "doc_id")
    assert rows(both) == [("l", 0), ("l", 3)]
    assert rows(either) == [("l", 0), ("l", 1), ("l", 2), ("l", 3)]


def test_notice_with_most_of_the_attachments(spark, tier):
    parts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"),
        F.concat(F.lit("part "), F.when(F.col("id") % 2 == 0, "сосна").otherwise("ёлки")).alias("text"),
    )
    lists = lists_df(spark, {"l": ["сосна", "ёлки"]})
    assert rows(attachment_matches(texts_df(spark, ["сосна"]), parts, clauses_of(lists, "all"), "doc_id")) == [("l", 7)]


def test_whole_tokens(spark):
    lists = lists_df(spark, {"l": ["Сосна", "ель"], "part": ["сос"], "two words": ["сосна и"]})
    texts = texts_df(spark, ["сосна и ель", "сосны, ель.", "ЕЛЬ-СОСНА", "", None])
    assert rows(token_matches(texts, clauses_of(lists, "all"), "doc_id")) == [("l", 0), ("l", 2)]
    assert rows(token_matches(texts, clauses_of(lists, "any"), "doc_id")) == [("l", 0), ("l", 1), ("l", 2)]


def test_frequent_term_is_not_multiplied_by_lists(spark):
    """A term in all texts and all lists costs no more than the rare ones beside it."""
    found = spark.range(2000).select(
        F.col("id").alias("doc_id"), F.explode(F.array(F.lit("the"), F.concat(F.lit("t"), F.col("id")))).alias("term")
    )
    lists = {f"l{i}": ["the", f"t{i}"] for i in range(50)} | {"none": ["the", "unseen"]}
    got = lists_satisfied(found, clauses_of(lists_df(spark, lists), "all"), "doc_id")
    assert rows(got) == sorted(((f"l{i}", i) for i in range(50)), key=repr)


@pytest.mark.parametrize("policy, expected", [("any", [("l", 1), ("l", 2)]), ("all", [("l", 1), ("l", 2)])])
def test_texts_of_an_id_count_together(spark, tier, policy, expected):
    texts = spark.createDataFrame([(1, "aaa"), (1, "bbb"), (2, "aaa bbb"), (2, "aaa bbb"), (3, None)], "doc_id bigint, text string")
    lists = lists_df(spark, {"l": ["aaa", "bbb"]})
    assert rows(keyword_matches(texts, clauses_of(lists, policy), "doc_id")) == expected
    assert rows(token_matches(texts, clauses_of(lists, policy), "doc_id")) == expected


def test_texts_are_scanned_once_and_not_shuffled(spark, tier):
    texts = stage(texts_df(spark, TEXTS), "texts")
    terms = found_terms(texts, lists_df(spark, LISTS), ["doc_id"])
    plan = plan_of(terms)
    assert "Exchange" not in plan and plan.count("FileScan") == 1


def test_held_texts_are_searched_in_portions(spark, tier, monkeypatch):
    monkeypatch.setattr(keywords, "HELD_CHARACTERS", 5)
    got = keyword_matches(texts_df(spark, TEXTS), clauses_of(lists_df(spark, LISTS), "any"), "doc_id")
    assert rows(got) == brute_force(TEXTS, LISTS, "any")
