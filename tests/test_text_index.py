"""The trigram index against a scan of the texts."""

import os
import random
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from noticemill.operators import text_index
from noticemill.operators.keywords import clauses_of, keyword_matches
from tests.conftest import plan_of

SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(5)
    words = ["Pine", "fir", "OAK", "no tice", "日本語", "ab", "a", "😀x", "ünï", "a.b%c"]
    rows = [(i % 70, " ".join(rng.choices(words, k=rng.randint(0, 12)))) for i in range(160)]
    rows += [(500, None), (501, ""), (None, "pine fir"), (502, "aaaaaaaa"), (503, "xyz" * 5000), (504, "pin"), (505, "pi")]
    return spark.createDataFrame(rows, SCHEMA)


def files_of(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names}


@pytest.fixture(scope="module")
def index(spark, table, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    text_index.add_to_index(table.filter("doc_id % 2 = 0").repartition(3), path, "a", characters=300)
    before = files_of(path)
    text_index.add_to_index(table.filter("doc_id % 2 = 1 or doc_id is null").repartition(2), path, "b", characters=300)
    after = files_of(path)
    assert before.items() <= after.items() and len(after) > len(before)
    return path


TERMS = ["pine", "Pine fir", "a", "AB", "oak no", "日本", "本語", "😀", "x", "a.b%c a", "aaaa", "zxyzx", "xyz" * 30, "zzz", "n", "ï", "pin", " ", "%", "e oak ab fir pine"]


@pytest.mark.parametrize("policy", ["any", "all"])
def test_same_matches_as_by_scan(spark, table, index, policy):
    rng = random.Random(6)
    lists = [(f"l{i}", term) for i, term in enumerate(TERMS)]
    lists += [(f"m{i}", term) for i in range(12) for term in rng.sample(TERMS, rng.randint(2, 4))]
    lists = spark.createDataFrame([*lists, ("none", "")], "list_id string, term string")
    scanned = keyword_matches(table, clauses_of(lists, policy), "doc_id").collect()
    found = text_index.indexed_matches(spark, index, lists, policy).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, scanned)) and found


def test_terms_are_those_of_each_text(spark, table, index):
    terms = spark.createDataFrame([(t.lower(),) for t in TERMS], "term string")
    got = {(r.doc_id, r.term) for r in text_index.indexed_terms(spark, index, terms).collect()}
    rows = [(r.doc_id, (r.text or "").lower()) for r in table.collect()]
    assert got == {(i, t.lower()) for i, text in rows for t in TERMS if t.lower() in text}


def test_no_term_and_no_text(spark, index, tmp_path):
    nothing = spark.createDataFrame([], "term string")
    assert text_index.indexed_terms(spark, index, nothing).collect() == []
    text_index.add_to_index(spark.createDataFrame([(1, None), (2, "")], SCHEMA), str(tmp_path / "i"), "a")
    one = spark.createDataFrame([("pine",)], "term string")
    assert text_index.indexed_terms(spark, str(tmp_path / "i"), one).collect() == []


def test_a_batch_added_again_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "i")
    one = spark.createDataFrame([("pine",)], "term string")
    for rows in ([(1, "pine")], [(2, "Pines")]):
        text_index.add_to_index(spark.createDataFrame(rows, SCHEMA), path, "a")
    assert [r.doc_id for r in text_index.indexed_terms(spark, path, one).collect()] == [2]


def test_plan_opens_postings_by_gram_and_texts_by_portion(spark, index):
    plan = plan_of(text_index.indexed_terms(spark, index, spark.createDataFrame([("pine fir",)], "term string")))
    assert "dynamicpruning" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_frequent_grams_of_a_term_are_met_in_time_in_proportion(spark, tmp_path):
    """lists of places were compared pair by pair."""
    path, rows = str(tmp_path / "i"), [(1, "a" * 150_000 + "b"), (2, "ba"), (3, "ab" * 40_000), (4, "aaaab")]
    text_index.add_to_index(spark.createDataFrame(rows, SCHEMA).coalesce(1), path, "a")
    terms = spark.createDataFrame([("aaaaaaaaab",), ("babababa",), ("aaaaa",), ("aaaab",)], "term string")
    start = time.monotonic()
    got = sorted((r.doc_id, r.term) for r in text_index.indexed_terms(spark, path, terms).collect())
    assert got == [(1, "aaaaa"), (1, "aaaaaaaaab"), (1, "aaaab"), (3, "babababa"), (4, "aaaab")]
    assert time.monotonic() - start < 30


def size_of(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names)


def test_postings_take_little_disk(spark, tmp_path):
    """F1: a text number and a place were kept for each character, here 2.1 bytes of disk; now 1.7."""
    rng, path = random.Random(8), str(tmp_path / "i")
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(400)]
    rows = [(i, " ".join(rng.choices(words, k=1_000))) for i in range(1_000)]
    text_index.add_to_index(spark.createDataFrame(rows, SCHEMA).coalesce(1), path, "a")
    assert size_of(f"{path}/postings") < 1.9 * sum(len(text) for _, text in rows)


def test_texts_are_compared_where_they_lie(plain_joins, index, table):
    """where the candidates could not be broadcast, all texts were shuffled to meet them."""
    terms = plain_joins.createDataFrame([("pine",), ("a",), ("oak no",)], "term string")
    found = text_index.indexed_terms(plain_joins, index, terms)
    plan = plan_of(found)
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1  # that of distinct
    rows = [(r.doc_id, (r.text or "").lower()) for r in table.collect()]
    assert {(r.doc_id, r.term) for r in found.collect()} == {(i, t) for i, text in rows for t in ("pine", "a", "oak no") if t in text}


def test_postings_of_a_portion_take_little_memory():
    """arrays of all grams, text numbers and places were copied, 49 bytes a character; now 24."""
    rng = np.random.default_rng(9)
    texts = ["".join(map(chr, rng.integers(97, 117, 10_000))) for _ in range(200)]
    starts = [i * 10_002 for i in range(200)]
    batch = pa.record_batch([pa.array([7] * 200), pa.array(starts), pa.array(texts)], names=["portion", "start", "text"])
    tracemalloc.start()
    n = sum(sum(rows.column("n").to_pylist()) for rows in text_index._postings(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 2_000_000 and peak < 35 * n


def test_rows_of_postings_are_short(spark, tmp_path):
    """all places of a gram in a portion were one row, and the lists of a term one more."""
    path = str(tmp_path / "i")
    text_index.add_to_index(spark.createDataFrame([(1, "a" * 200_000)], SCHEMA), path, "a")
    rows = spark.read.parquet(f"{path}/postings").filter("n > 1").collect()
    assert sum(r.n for r in rows) == 199_998 and max(r.n for r in rows) <= 16_384


@pytest.mark.parametrize("letters", [3, 70, 0x10FFFF])
def test_places_by_gram(letters):
    """Also where a gram and a place are too large for one number."""
    rng = np.random.default_rng(letters)
    codes = rng.integers(0, letters, 60_000).astype(np.uint32)
    real = rng.random(59_998) < 0.99
    order, begins = text_index._by_gram(codes, real)
    gram = [tuple(codes[i : i + 3].tolist()) for i in range(len(real))]
    assert order.tolist() == sorted(np.flatnonzero(real).tolist(), key=lambda i: (gram[i], i))
    assert begins.tolist() == [k for k, i in enumerate(order) if not k or gram[i] != gram[order[k - 1]]]


def test_packed_lists_are_the_same_unpacked():
    rng = np.random.default_rng(10)
    lists = [np.cumsum(rng.integers(1, top, n)) for top, n in ((2, 500), (200, 50), (20_000, 9), (1 << 40, 5), (9, 1))] + [np.zeros(1, np.int64)]
    begins = np.cumsum([0, *map(len, lists[:-1])])
    packed = text_index._packed(np.concatenate(lists), begins).to_pylist()
    assert [text_index._unpacked(x).tolist() for x in packed] == [x.tolist() for x in lists]


def test_a_portion_in_several_files_and_zero_characters(spark, tmp_path):
    path, conf = str(tmp_path / "i"), "spark.sql.files.maxRecordsPerFile"
    rows = [(i, ["pine fir", "fir\0oak", "a\0", "", "oak"][i % 5] + "x" * (i % 4)) for i in range(60)]
    spark.conf.set(conf, 7)
    try:
        text_index.add_to_index(spark.createDataFrame(rows, SCHEMA).repartition(2), path, "a", characters=150)
    finally:
        spark.conf.unset(conf)
    terms = ["pine", "r\0o", "\0", "a\0", "k\0", "kxx\0\0", "fir", "rpin", "xxx", "oakxx"]
    got = sorted((r.doc_id, r.term) for r in text_index.indexed_terms(spark, path, spark.createDataFrame([(t,) for t in terms], "term string")).collect())
    assert got == sorted((i, t) for i, text in rows for t in terms if t in text)
