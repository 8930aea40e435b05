"""Recursive BPE against the library, and decoding as a round trip."""

import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from noticemill.llm import bpe
from noticemill.llm.queries import RANKS_FILE, queries, tokenizer_path
from tests.conftest import SMALL
from tests.llm.helpers import edge_documents, edge_texts, empty, rows_of


@pytest.fixture(scope="module")
def path():
    return tokenizer_path(RANKS_FILE)


@pytest.fixture(scope="module")
def library(path):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks_of(path), special_tokens={})


@pytest.fixture(scope="module")
def codec(path):
    return bpe.Codec(path, public_tokenizers.PATTERN)


def same(codec, library, texts):
    for text, (ids, raw) in zip(texts, codec.encode(texts)):
        assert ids == " ".join(map(str, library.encode_ordinary(text or "")))
        assert raw == (text or "").encode()


def test_edge_texts(codec, library):
    same(codec, library, edge_texts())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab' sdé1٣.,\n\t\r\x0b\x1c\x85  ᠎​日Ġ<|>")), max_size=40), max_size=5))
def test_odd_white_space(codec, library, texts):
    same(codec, library, texts)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_any_text(codec, library, text):
    same(codec, library, [text.encode("utf-8", "ignore").decode()])


def test_long_words(codec, library):
    rng = random.Random(8)
    words = ["x" * 100_000, "".join(rng.choices("abcdefgh", k=20_000)), "=" * 3000 + " " * 2000 + "!" * 300]
    words += ["".join(rng.choices("etaoin", k=n)) for n in range(250, 262)]
    same(codec, library, words)


def test_heap_and_query_contract_alike(codec):
    rng = random.Random(9)
    words = ["".join(rng.choices("etaoinshr '-é", k=rng.randint(2, 40))).encode() for _ in range(300)]
    assert [ids for ids, _ in codec.contract(words)] == [" ".join(map(str, codec.contract_long(w))) for w in words]


def test_forgetting_changes_nothing(path, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 3)
    monkeypatch.setattr(bpe, "QUERY_BYTES", 20)
    small = bpe.Codec(path, public_tokenizers.PATTERN)
    for texts in (["unremembered pieces of forgotten words"], ["forgotten words of unremembered pieces", "pieces"]):
        same(small, library, texts)


def test_documents_and_decoding(spark, path, library):
    docs = edge_documents(spark).repartition(3)
    encoded = bpe.encode(docs, path, public_tokenizers.PATTERN)
    want = sorted(((i, " ".join(map(str, library.encode_ordinary(t or ""))), (t or "").encode()) for i, t in rows_of(docs)), key=repr)
    got = encoded.collect()
    assert sorted(((r.doc_id, r.ids, bytes(r.decoded)) for r in got), key=repr) == want
    assert all(r.n_tokens == len(r.ids.split()) for r in got)
    decoded = bpe.decode(encoded.withColumn("decoded", encoded["n_tokens"]), path, public_tokenizers.PATTERN).collect()
    assert sorted(((r.doc_id, bytes(r.decoded)) for r in decoded), key=repr) == sorted(((i, raw) for i, _, raw in want), key=repr)


def test_unknown_ids_fail(codec):
    with pytest.raises(KeyError):
        codec.decode([[1, 50_256]])
    assert codec.decode([[], [1]]) == [b"", codec.bytes_of[1]]


def test_query_and_no_documents(spark, path, library):
    import hashlib

    got = {r.doc_id: r for r in queries()["op13_recursive_bpe"](spark, SMALL).collect()}
    docs = rows_of(spark.read.parquet(f"{SMALL}/documents.parquet"))
    assert len(got) == len(docs)
    for doc_id, text in docs:
        ids = library.encode_ordinary(text or "")
        row = got[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.encode(empty(spark), path, public_tokenizers.PATTERN).collect() == []
