import copy
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import TaskContext
from pyspark.sql import Row

from noticemill.llm import packing, records, tokens
from noticemill.llm.queries import queries, tokenizer_path
from tests.conftest import SMALL, rows
from tests.llm.helpers import edge_documents, edge_texts, empty, rows_of


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(tokenizer_path())


def ids(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 0]


def crc(values):
    return zlib.crc32(np.array(values, "<u4").tobytes())


def same(library, encoder, text):
    assert np.frombuffer(encoder.encode(text), encoder.type).tolist() == ids(library, text)


def test_edge_texts(library, encoder):
    for text in edge_texts():
        same(library, encoder, text)


def test_added_tokens_are_their_ids(library, encoder):
    for text in ("a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>\ny z", "<|endoftext| >"):
        same(library, encoder, text)
    assert np.frombuffer(encoder.encode("a <|endoftext|> b"), encoder.type).tolist() == [64, 220, 50256, 275, 0]


def test_many_texts_at_once(library, encoder):
    texts = [None, "one two", "", "two\none two", "two\n\none", " two", "one \ntwo", *edge_texts(), "end\n"]
    for text, got in zip(texts, encoder.encode_all(texts)):
        assert np.frombuffer(got, encoder.type).tolist() == ids(library, text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab' sdé1٣.,\n\t\r\x0b\x1c\x85  ᠎​日Ġ<|>")), max_size=40))
def test_odd_white_space(library, encoder, text):
    same(library, encoder, text)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_any_text(library, encoder, text):
    same(library, encoder, text.encode("utf-8", "ignore").decode())


def test_forgetting_pieces_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED_BYTES", 3)
    small = tokens.Encoder(tokenizer_path())
    for text in ("a b c d e f g", "g f e d", "a a a b"):
        same(library, small, text)


def test_pieces_are_remembered_without_the_marks_around_them(library):
    own = tokens.Encoder(tokenizer_path())
    texts = ["one two, two. two; (two)\ntwo!", None, "two, one. \"two\" it's two's", "one\n\ntwo, one"]
    for text, got in zip(texts, own.encode_all(texts)):
        assert np.frombuffer(got, own.type).tolist() == ids(library, text)
    words = {piece for piece in own.seen if b"two" in piece or b"one" in piece}
    assert words == {b"one", b" two", b" (two", b"\ntwo", b"two", b" one", b' "two', b" two's", b"one\n\ntwo"}
    # known words with other marks behind them are not encoded again, nor are pieces of the same column twice
    calls = []
    learn = own._learn
    own._learn = lambda pieces: (calls.append(sorted(pieces)), learn(pieces))
    own.encode_all(["one two: two: two:"] * 3)
    assert calls == [[b":"]]


def test_columns_and_batches(library, encoder, monkeypatch):
    texts = [None, "a, b", "", "c\n\nd e", "f\ng", "x <|endoftext|>", None, " h", "", "i j\n", "é, ü.", None]
    for column in (pa.array(texts), pa.array(texts, pa.large_string()), pa.array(texts).slice(3, 6), pa.array([None, ""]), pa.array(["q"]).slice(1)):
        got = [np.frombuffer(raw, encoder.type).tolist() for raw in encoder.encode_column(column)]
        assert got == [ids(library, text) for text in column.to_pylist()]
    numbers = [None, *range(len(texts) - 1)]
    batch = pa.record_batch([pa.array(numbers), pa.array(texts)], names=["doc_id", "text"])
    want = [(n, ids(library, text)) for n, text in zip(numbers, texts)]
    for size in (1, 1 << 20):
        monkeypatch.setattr(tokens, "COLUMN_BYTES", size)
        got = [(n, np.frombuffer(raw, encoder.type).tolist()) for n, raw in encoder.encode_batches(iter([batch.slice(0, 5), batch.slice(5)]))]
        assert got == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab'sZ09.,-_\"(é“ \n\u3000")), max_size=30), max_size=4))
def test_marks_beside_words(library, encoder, texts):
    own = copy.copy(encoder)
    own.seen, own.held = {}, 0
    for text, got in zip(texts, own.encode_all(texts)):
        assert np.frombuffer(got, own.type).tolist() == ids(library, text)


def expected_records(library, docs):
    start, out = 0, []
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0])):
        found = ids(library, text)
        out.append((doc_id, start, len(found), crc(found)))
        start += len(found)
    return out


def test_query_of_records(spark, library):
    docs = rows_of(spark.read.parquet(f"{SMALL}/documents.parquet"))
    got = queries()["op3_token_records"](spark, SMALL)
    assert rows(got.select("doc_id", "start", "n_tokens", "ids_crc32")) == sorted(expected_records(library, docs), key=repr)


def test_records_of_edge_documents(spark, library, tmp_path):
    docs = edge_documents(spark).repartition(3)
    path = f"file://{tmp_path}/out"
    manifest = records.write_records(docs, path, tokenizer_path(), file_bytes=2000)
    got = records.read_records(spark, path).collect()
    want = sorted(((d, len(ids(library, t)), crc(ids(library, t))) for d, t in rows_of(docs)), key=repr)
    assert sorted(((r.doc_id, r.n_tokens, zlib.crc32(r.ids)) for r in got), key=repr) == want
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted((d for d, _ in rows_of(docs)), key=lambda d: (d is not None, d))
    assert [r.start for r in ordered] == [sum(x.n_tokens for x in ordered[:i]) for i in range(len(ordered))]
    assert manifest.agg({"n_records": "sum"}).first()[0] == len(want)
    shuffled = records.read_records(spark, path, shuffle_seed=5).collect()
    assert sorted(map(repr, shuffled)) == sorted(map(repr, got))


def test_no_documents(spark, tmp_path):
    records.write_records(empty(spark), f"{tmp_path}/out", tokenizer_path())
    assert records.read_records(spark, f"{tmp_path}/out").collect() == []
    assert packing.pack(empty(spark), tokenizer_path()).collect() == []


def test_broken_records_are_refused():
    import io

    good = records.framed(7, struct.pack("<3H", 1, 2, 0), 2) + records.framed(None, b"\0\0", 2)
    stream = io.BytesIO(good)
    assert records.unframed(stream) == (7, 2, struct.pack("<3H", 1, 2, 0))
    assert records.unframed(stream) == (None, 2, b"\0\0")
    assert records.unframed(stream) is None
    for i in range(len(records.framed(7, b"ab", 2))):
        broken = bytearray(good)
        broken[i] ^= 4
        with pytest.raises(records.BrokenRecord):
            records.unframed(io.BytesIO(bytes(broken)))
    with pytest.raises(records.BrokenRecord):
        records.unframed(io.BytesIO(good[:20]))


def check_pieces(pieces, docs, library):
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
    for doc_id, text in docs:
        found = ids(library, text)
        at = 0
        for p in sorted(by_doc[doc_id], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(found))
            assert p.ids_crc32 == crc(found[at : at + p.length])
            at += p.length
        assert at == len(found)
    padding = 0
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= packing.WINDOW
        padding += 0 if packing.whole_fill(at, packing.WINDOW) else packing.WINDOW - at
    return padding


def test_query_of_packing(spark, library):
    docs = rows_of(spark.read.parquet(f"{SMALL}/documents.parquet"))
    pieces = queries()["op8_minimum_bin_slack"](spark, SMALL).collect()
    assert check_pieces(pieces, docs, library) == 0


def test_packing_edge_documents(spark, library):
    docs = edge_documents(spark).filter("doc_id is not null").dropDuplicates(["doc_id"])
    pieces = packing.pack(docs, tokenizer_path(), held=4).collect()
    assert check_pieces(pieces, rows_of(docs), library) == 0
    both = packing.pack(edge_documents(spark), tokenizer_path())
    assert both.agg({"length": "sum"}).first()[0] == sum(len(ids(library, t)) for _, t in rows_of(edge_documents(spark)))


def test_packing_encodes_batches_together(library, monkeypatch):
    class Docs:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    class Task:
        def partitionId(self):
            return 3

    columns = []
    of_column = tokens.Encoder.encode_column
    monkeypatch.setattr(tokens.Encoder, "encode_column", lambda self, texts: columns.append(len(texts)) or of_column(self, texts))
    monkeypatch.setattr(TaskContext, "get", Task)
    docs = [(n, f"word {n}, and word {n + 1}.") for n in range(40)]
    batches = [pa.record_batch([pa.array([n]), pa.array([text])], names=["doc_id", "text"]) for n, text in docs]
    pieces = pa.Table.from_batches(packing.pack(Docs(), tokenizer_path())(iter(batches))).to_pylist()
    assert columns == [40]
    assert check_pieces([Row(**piece) for piece in pieces], docs, library) == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 63), max_size=40))
def test_every_rest_is_packed(lengths):
    rests = list(enumerate(lengths))
    seen = {k: [] for k, _ in rests}
    for sequence in packing.packed(rests, 64):
        total = sum(n for _, _, n in sequence)
        assert packing.whole_fill(total, 64) and total <= 64
        for key, start, n in sequence:
            seen[key].append((start, n))
    for key, length in rests:
        at = 0
        for start, n in sorted(seen[key]):
            assert start == at
            at += n
        assert at == length


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 3), max_size=6), st.integers(0, 60))
def test_fullest_is_the_best_sum(counts, capacity):
    sums = {0}
    for n, k in counts.items():
        sums = {s + n * i for s in sums for i in range(k + 1)}
    chosen = packing.fullest(counts, capacity)
    assert sum(chosen) == max(s for s in sums if s <= capacity)
    assert all(chosen.count(n) <= counts[n] for n in chosen)
