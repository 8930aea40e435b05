"""Search by hierarchical product codes.

A tree node labelled L leads to the wanted code C when C starts with L, or when both have
the same length, L ends in `0` and C starts with L less that `0` (L is the group of C).
Prefixes are plain text: 10.8 leads to 10.86. The code leads to itself. The items below a
selected code are the items it leads to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticemill.session import stage


def resolved_codes(codes: DataFrame, tree: DataFrame) -> DataFrame:
    """The (list_id, code) rows whose code is a node of the tree."""
    return codes.join(tree, "code", "left_semi")


def unresolved_codes(codes: DataFrame, tree: DataFrame) -> DataFrame:
    """The (list_id, code) rows whose code is not in the tree."""
    return codes.join(tree, "code", "left_anti")


def _lengths(codes: DataFrame) -> Column:
    """The lengths that occur among the codes; as many as the longest code has characters."""
    lengths = codes.agg(F.array_sort(F.collect_set(F.length("code"))).alias("_lengths")).scalar()
    return F.coalesce(lengths, F.array().cast("array<int>"))


def _selectors(code: Column, lengths: Column) -> Column:
    """The labels that lead to a code, only those as long as some selected code."""
    size = F.length(code)
    fitting = F.filter(lengths, lambda n: (n >= 1) & (n <= size))
    prefixes = F.transform(fitting, lambda n: code.substr(F.lit(1), n))
    group = F.concat(code.substr(F.lit(1), size - 1), F.lit("0"))
    groups = F.when(F.array_contains(lengths, size), F.array(group)).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(prefixes, groups))


def code_subtree(items: DataFrame, codes: DataFrame) -> DataFrame:
    """Distinct (list_id, item_id) of the items below the selected (list_id, code) rows.

    Each item names the few labels that lead to it, so the containment rule becomes an
    equality join on the label; no pair of item and code is tried in vain.
    """
    sized = items.select("item_id", "code", _lengths(codes).alias("_lengths"))
    labelled = sized.select("item_id", F.explode(_selectors(F.col("code"), F.col("_lengths"))).alias("code"))
    return labelled.join(codes, "code").select("list_id", "item_id").distinct()


def code_suggestions(unresolved: DataFrame, tree: DataFrame) -> DataFrame:
    """(list_id, code, suggestion): the smallest tree code that contains an unresolved code.

    Each tree code names its parts of the lengths asked for, so `contains` becomes an
    equality join too. The smallest one is found per code, however many lists ask for it.
    Codes that no tree code contains are left out.
    """
    node = F.col("code")
    with_lengths = tree.select("code", _lengths(unresolved).alias("_lengths"))
    parts = F.flatten(
        F.transform(
            F.filter("_lengths", lambda n: (n >= 1) & (n <= F.length(node))),
            lambda n: F.transform(F.sequence(F.lit(1), F.length(node) - n + 1), lambda at: node.substr(at, n)),
        )
    )
    candidates = with_lengths.select(node.alias("suggestion"), F.explode(F.array_distinct(parts)).alias("code"))
    asked = candidates.join(unresolved.select("code").distinct(), "code", "left_semi")
    smallest = asked.groupBy("code").agg(F.min("suggestion").alias("suggestion"))
    return unresolved.select("list_id", "code").distinct().join(smallest, "code").select("list_id", "code", "suggestion")


def selected_codes(codes: DataFrame, tree: DataFrame) -> DataFrame:
    """Resolved codes, and for each other code its suggestion in place of it."""
    suggested = code_suggestions(unresolved_codes(codes, tree), tree)
    suggested = suggested.select("list_id", F.col("suggestion").alias("code"))
    return resolved_codes(codes, tree).select("list_id", "code").unionByName(suggested).distinct()


def unmatched_codes(codes: DataFrame, tree: DataFrame) -> DataFrame:
    """Codes that are neither in the tree nor part of a tree code, for the report."""
    unresolved = unresolved_codes(codes, tree)
    return unresolved.join(code_suggestions(unresolved, tree), ["list_id", "code"], "left_anti").select("list_id", "code")


def code_search(items: DataFrame, codes: DataFrame, tree: DataFrame) -> DataFrame:
    """Distinct (list_id, item_id) for whole code lists; an unmatched list finds nothing.

    The selected codes are written first: they are few, and the items are then searched in
    one pass with a join that Spark picks by their true size.
    """
    return code_subtree(items, stage(selected_codes(codes, tree), "codes"))
