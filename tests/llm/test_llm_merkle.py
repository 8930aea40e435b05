"""The Merkle manifest against a plain tree of nested lists."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from noticemill.llm import merkle
from tests.llm.helpers import edge_documents, empty

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"
SMALL_LETTERS = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    values = (row.doc_id, row.source, row.lang, row.n_chars, text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + 8])) for i in range(0, len(below), 8)])
    return levels


def siblings(levels, i):
    for level in levels[:-1]:
        first = i // 8 * 8
        yield "".join(level[first:i]), "".join(level[i + 1 : first + 8])
        i //= 8


def expected(rows):
    langs = {}
    for row in rows:
        langs.setdefault(row.lang, []).append(row)
    order = sorted(langs, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {}
    for lang in order:
        mine = sorted(langs[lang], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text)))
        trees[lang] = mine, levels_of([leaf_of(r, r.text) for r in mine])
    top = levels_of([trees[lang][1][-1][0] for lang in order])
    out = []
    for k, lang in enumerate(order):
        mine, levels = trees[lang]
        for i, row in enumerate(mine):
            path = [*siblings(levels, i), *siblings(top, k)]
            tampered = row.doc_id is not None and row.text is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 0
            folded = leaf_of(row, row.text.translate(SMALL_LETTERS) if tampered else row.text)
            for before, after in path:
                folded = sha(before + folded + after)
            root = top[-1][0]
            proof = "".join(before + after for before, after in path)
            out.append((row.doc_id, levels[0][i], levels[-1][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def found(docs):
    rows = merkle.manifest(docs).collect()
    return sorted(((r.doc_id, *(bytes(r[n]).hex() for n in ("leaf", "subroot", "root", "proof", "folded_root")), r.verified) for r in rows), key=repr)


def test_nulls_ties_and_odd_languages(spark):
    docs = edge_documents(spark).withColumn("source", F.when(F.col("n_words") > 0, F.lit("s:1")))
    langs = F.element_at(F.array(*[F.lit(x) for x in ("", "é", "root", None, "z", "Z")]), F.pmod(F.coalesce("doc_id", F.lit(3)), F.lit(6)).cast("int") + 1)
    docs = docs.withColumn("lang", langs).withColumn("n_chars", F.length("text"))
    for name in ("tree", "idx", "leaf", "level", "digest"):
        docs = docs.withColumn(name, F.col("n_words"))
    docs = docs.repartition(5)
    assert found(docs) == expected(docs.collect())


@pytest.mark.parametrize("sizes", [[1], [8], [9], [1, 1], [65, 1, 8], [70] * 10])
def test_trees_of_any_size(spark, sizes):
    rng = random.Random(len(sizes))
    rows = [(i, "s", f"l{k}", 1, rng.choice(["Text", "text", "T"])) for k, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(docs) == expected(docs.collect())


def test_one_row_over_and_over(spark):
    docs = spark.createDataFrame([(3, "s", "en", 4, "Same")] * 300, SCHEMA).repartition(6)
    assert found(docs) == expected(docs.collect())


def test_no_documents(spark):
    docs = empty(spark).selectExpr("*", "'s' as source", "'en' as lang", "1 as n_chars")
    assert merkle.manifest(docs).collect() == []
