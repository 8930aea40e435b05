import random
from collections import Counter

import numpy as np
import pytest

from noticemill.llm import jaccard, queries
from noticemill.llm.graph import components
from noticemill.llm.jaccard import PrefixTree, Similarity, linked_documents, one_of_each
from tests.conftest import SMALL, rows
from tests.llm.helpers import edge_documents, empty, prose, rows_of


def ngrams(text, n):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def brute_force(docs, n, percent):
    """(doc_id, set size, smallest id of the group, links) for each row."""
    sets = [ngrams(text, n) for _, text in docs]
    root, links = list(range(len(docs))), Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(((d, len(sets[i]), least.get(find(i)), links[i]) for i, (d, _) in enumerate(docs)), key=repr)


def found(df, rule):
    return rows(linked_documents(df, rule).select("doc_id", "n_ngrams", "first_doc", "n_links"))


@pytest.mark.parametrize("words, percent", [(4, 85), (5, 80), (2, 50)])
def test_edge_texts(spark, words, percent):
    docs = edge_documents(spark)
    assert found(docs, Similarity(words, percent)) == brute_force(rows_of(docs), words, percent)


def near_copies(seed, groups=6, copies=14):
    rng = random.Random(seed)
    out = []
    for _ in range(groups):
        base = prose(rng, rng.choice((5, 12, 60, 150))).split()
        for _ in range(rng.randint(1, copies)):
            changed = list(base)
            for _ in range(rng.randint(0, 5)):
                changed[rng.randrange(len(base))] = prose(rng, 1)
            out.append(" ".join(changed))
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("limit", [10**9, 300])
def test_groups_of_near_copies(spark, monkeypatch, limit):
    monkeypatch.setattr(jaccard, "GROUP_NGRAMS", limit)
    docs = near_copies(limit % 97)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    assert found(df, Similarity(4, 85)) == brute_force(docs, 4, 85)


def test_empty_table(spark):
    assert found(empty(spark), Similarity()) == []
    assert one_of_each(empty(spark)).collect() == []


def test_first_of_each_group_stays(spark):
    docs = edge_documents(spark)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    groups = brute_force(rows_of(docs), 5, 80)
    # the third row without words, the copies of text 6 and of texts 8 and 9 go as the groups say
    alone = sum(1 for _, size, _, _ in groups if not size)
    others = {least for _, size, least, _ in groups if size}
    assert kept.count() == alone + len(others - {None}) + (1 if (None, 1, None, 0) in groups else 0)


def test_query_against_brute_force(spark):
    docs = rows_of(spark.read.parquet(f"{SMALL}/documents.parquet"))
    got = queries.queries()["op1_prefix_tree_join"](spark, SMALL)
    assert rows(got.select("doc_id", "n_shingles", "component_id", "n_links")) == brute_force(docs, 4, 85)


def test_tree_finds_all_pairs():
    rng = random.Random(9)
    rule = Similarity(4, 85)
    for _ in range(20):
        base = rng.sample(range(1000), 40)
        sets = [np.array(sorted(set(base) ^ set(rng.sample(range(1000), rng.randint(0, 6)))), np.uint64) for _ in range(25)]
        sets.append(sets[0].copy())
        want = {
            (i, j)
            for i, a in enumerate(sets)
            for j, b in enumerate(sets)
            if i != j and 100 * len(set(a) & set(b)) >= 85 * len(set(a) | set(b))
        }
        assert {(i, int(j)) for i, js in PrefixTree(sets, rule).links() for j in js} == want


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 140)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(7, 7)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    want = {x: find(x) for x in root if find(x) != x}
    got = components(spark.createDataFrame(edges, "u bigint, v bigint"))
    assert {r.node: r.root for r in got.collect()} == want
    assert components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []
