"""The pipeline's stages, each against brute force on its own input."""

import pytest

import corpus_pipeline
from noticemill.llm.common import written
from tests.conftest import SMALL, rows
from tests.llm.helpers import edge_documents, rows_of, white_words
from tests.llm.test_llm_jaccard import brute_force as groups
from tests.llm.test_llm_repeats import brute_force as without_repeats
from tests.llm.test_llm_text_rules import brute_contamination, measured
from tests.llm.test_llm_tokens import check_pieces, library  # noqa: F401

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def outputs(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").coalesce(1)
    out = {"": written(docs, "documents")}
    before = out[""]
    for name, stage in corpus_pipeline.STAGES:
        before = out[name] = written(stage(spark, before, SMALL), name)
    return out


def test_stages_are_the_ones_asked_for():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "repeated_passages", "benchmark_texts", "packed_sequences"
    ]


def test_columns_stay(outputs):
    columns = outputs[""].columns
    for name in list(STAGES)[:-1]:
        assert outputs[name].columns == columns


def test_quality_stage(outputs):
    def good(text):
        n, chars, symbols, lines, repeated_lines, repeated = measured(text)
        return n >= 50 and 2 * repeated <= n and 5 * symbols <= chars and 2 * repeated_lines <= lines and 2 * n <= chars <= 20 * n

    want = sorted(((d, t) for d, t in rows_of(outputs[""]) if good(t)), key=repr)
    assert sorted(rows_of(outputs["quality_rules"]), key=repr) == want


def test_near_duplicate_stage(outputs):
    docs = rows_of(outputs["quality_rules"])
    first = {least for _, _, least, _ in groups(docs, 5, 80)}
    assert sorted(rows_of(outputs["near_duplicates"])) == sorted((d, t) for d, t in docs if d in first)


def test_repeated_passage_stage(outputs):
    docs = rows_of(outputs["near_duplicates"])
    want = {d: (n, gone) for d, n, gone, _ in without_repeats(docs, 13, within=False)}
    texts, got = dict(docs), dict(rows_of(outputs["repeated_passages"]))
    assert set(got) == {d for d, (n, gone) in want.items() if not gone or gone < n}
    for d, text in got.items():
        n, gone = want[d]
        assert text == texts[d] if not gone else len(white_words(text)) == n - gone
    for r in outputs["repeated_passages"].collect():
        assert r.n_chars == len(r.text)


def test_benchmark_stage(spark, outputs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    docs = rows_of(outputs["repeated_passages"])
    bad = {w[0] for w in brute_contamination(docs, items) if w[-1]}
    assert sorted(rows_of(outputs["benchmark_texts"])) == sorted((d, t) for d, t in docs if d not in bad)


def test_packing_stage(outputs, library):  # noqa: F811
    docs = rows_of(outputs["benchmark_texts"])
    assert check_pieces(outputs["packed_sequences"].collect(), docs, library) == 0


def test_whole_run_packs_the_same_ids(spark, outputs):
    ran = corpus_pipeline.run(spark, SMALL)
    assert rows(ran.groupBy("doc_id").sum("length")) == rows(outputs["packed_sequences"].groupBy("doc_id").sum("length"))


def test_stages_bear_edge_documents(spark):
    docs = edge_documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SMALL), name)
        assert docs.columns == edge_documents(spark).columns
    assert STAGES["packed_sequences"](spark, docs, SMALL).count() > 0
    nothing = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SMALL).collect() == []
