import random

import pytest

from noticemill.operators.codes import (
    code_search,
    code_subtree,
    code_suggestions,
    resolved_codes,
    selected_codes,
    unmatched_codes,
    unresolved_codes,
)
from tests.conftest import plan_of, rows


def leads_to(label, code):
    return code.startswith(label) or label == code[:-1] + "0"


def codes_df(spark, pairs):
    return spark.createDataFrame(pairs, "list_id string, code string")


def items_df(spark, codes):
    return spark.createDataFrame(list(enumerate(codes)), "item_id int, code string")


def tree_df(spark, codes):
    return spark.createDataFrame([(c,) for c in codes], "code string")


TREE = ["10", "10.8", "10.86", "10.86.1", "10.86.10", "10.86.10.190", "10.86.10.191", "12.12.22.102", "13.22.102"]


def test_resolved_and_unresolved_split_the_list(spark):
    codes = codes_df(spark, [("a", "10.86.10.191"), ("a", "99"), ("b", "10.8"), ("b", "10.9")])
    tree = tree_df(spark, TREE)
    assert rows(resolved_codes(codes, tree).select("list_id", "code")) == [("a", "10.86.10.191"), ("b", "10.8")]
    assert rows(unresolved_codes(codes, tree).select("list_id", "code")) == [("a", "99"), ("b", "10.9")]


@pytest.mark.parametrize(
    "label, found",
    [
        ("10.86.10.190", [0, 1, 2]),  # the group of 190…199
        ("10.86.10.191", [1]),
        ("10.8", [0, 1, 2, 3, 4]),  # a plain prefix: no dot needed
        ("10.86.10", [0, 1, 2, 3]),
        ("10.86.10.100", [3]),
        ("10.7", []),
    ],
)
def test_subtree_of_a_code(spark, label, found):
    items = items_df(spark, ["10.86.10.190", "10.86.10.191", "10.86.10.199", "10.86.10.100", "10.80.1"])
    assert rows(code_subtree(items, codes_df(spark, [("l", label)]))) == [("l", i) for i in found]


def test_subtree_is_the_rule_on_random_codes(spark, plain_joins):
    rng = random.Random(3)
    code = lambda: "".join(rng.choices("01", k=rng.randint(1, 6)))
    items = [code() for _ in range(200)]
    selected = [(f"l{i % 5}", code()) for i in range(25)]
    expected = sorted({(name, i) for i, c in enumerate(items) for name, s in selected if leads_to(s, c)}, key=repr)
    got = code_subtree(items_df(spark, items), codes_df(spark, selected))
    assert rows(got) == expected
    assert "NestedLoop" not in plan_of(got) and "Cartesian" not in plan_of(got)


def test_suggestion_is_the_smallest_code_that_contains(spark):
    unresolved = codes_df(spark, [("a", "22.102"), ("a", "99"), ("b", "86.1"), ("b", "")])
    assert rows(code_suggestions(unresolved, tree_df(spark, TREE))) == [
        ("a", "22.102", "12.12.22.102"),
        ("b", "86.1", "10.86.1"),
    ]


def test_search_takes_tree_then_text(spark):
    codes = codes_df(spark, [("a", "10.86.10"), ("a", "22.102"), ("b", "22.102"), ("c", "99.99")])
    tree = tree_df(spark, TREE)
    assert rows(selected_codes(codes, tree)) == [("a", "10.86.10"), ("a", "12.12.22.102"), ("b", "12.12.22.102")]
    assert rows(unmatched_codes(codes, tree)) == [("c", "99.99")]
    items = items_df(spark, ["10.86.10.5", "12.12.22.102", "13.22.102"])
    assert rows(code_search(items, codes, tree)) == [("a", 0), ("a", 1), ("b", 1)]


def test_list_without_any_match_finds_nothing(spark):
    tree, items = tree_df(spark, TREE), items_df(spark, TREE)
    assert rows(code_search(items, codes_df(spark, [("c", "99.99")]), tree)) == []
    assert rows(code_search(items, codes_df(spark, []), tree)) == []


def test_repeated_code_and_overlapping_codes_count_once(spark):
    codes = codes_df(spark, [("a", "10"), ("a", "10"), ("a", "10.8")])
    assert rows(code_subtree(items_df(spark, ["10.86"]), codes)) == [("a", 0)]
