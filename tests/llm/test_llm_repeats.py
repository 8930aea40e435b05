import hashlib
import random

import numpy as np
import pytest

from noticemill.llm import automaton, blocks, repeats, suffixes
from noticemill.llm.automaton import SuffixAutomaton, dedup
from noticemill.llm.suffixes import repeated_passages
from tests.llm.helpers import edge_documents, empty, prose, rows_of, white_words


def brute_force(docs, length, within):
    """Per row: doc_id, words, removed words, kept words, removed runs; docs are in input order."""
    first = {}
    order = [(2**63 if d is None else d) for d, _ in docs]
    for k, (_, text) in enumerate(docs):
        words = white_words(text)
        for s in range(len(words) - length + 1):
            window, place = tuple(words[s : s + length]), (order[k], k, s)
            if window not in first or place < first[window]:
                first[window] = place
    out = []
    for k, (doc_id, text) in enumerate(docs):
        words = white_words(text)
        gone = [False] * len(words)
        for s in range(len(words) - length + 1):
            doc, row, start = first[tuple(words[s : s + length])]
            if doc < order[k] or within and (doc, row, start) < (order[k], k, s):
                gone[s : s + length] = [True] * length
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc_id, len(words), sum(gone), hashlib.md5(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted(
        ((r.row.doc_id, r.n_words, r.n_removed, hashlib.md5(r.kept.encode()).hexdigest()) for r in df.collect()), key=repr
    )


def shared_passages(seed):
    rng = random.Random(seed)
    passages = [prose(rng, n) for n in (3, 9, 13, 14, 30, 52, 80)]
    docs = []
    for i in range(60):
        parts = [prose(rng, rng.randint(0, 25))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages), prose(rng, rng.randint(0, 12))]
        docs.append((i, " ".join(parts)))
    return docs + [(60, docs[5][1]), (61, docs[5][1]), (62, " ".join(["a b c"] * 50)), (63, "a b c " * 40)]


@pytest.mark.parametrize("hot", [512, 3])
def test_substring_dedup(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "SHARD_BYTES", 3000)
    docs = shared_passages(hot)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)
    assert found(dedup(df)) == brute_force(docs, 13, within=False)


@pytest.mark.parametrize("hot", [512, 3])
def test_sparse_suffix_array(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "SHARD_BYTES", 3000)
    docs = shared_passages(hot + 1)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)
    assert found(repeated_passages(df)) == brute_force(docs, 50, within=True)


def test_small_blocks_find_the_same(spark, monkeypatch):
    docs = shared_passages(8)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)
    stored = blocks.store(df)
    assert stored.count() == 1
    rows = [r for b in stored.select("payload").collect() for r in blocks.unpacked(b.payload).column("_text").to_pylist()]
    assert rows == [t for _, t in docs]


def test_edge_texts(spark):
    docs = edge_documents(spark).coalesce(1)
    assert found(dedup(docs)) == brute_force(rows_of(docs), 13, within=False)
    got = repeated_passages(docs)
    assert found(got) == brute_force(rows_of(docs), 50, within=True)
    assert set(got.select("row.*").columns) == set(docs.columns) - {"text"}


def test_empty_table(spark):
    assert dedup(empty(spark)).collect() == []
    assert repeated_passages(empty(spark)).collect() == []


def test_passages_name_their_first_place(spark):
    rng = random.Random(1)
    passage = prose(rng, 70)
    docs = [(5, prose(rng, 20) + " " + passage), (9, passage + " " + prose(rng, 30)), (7, prose(rng, 3) + " " + passage)]
    got = repeated_passages(spark.createDataFrame(docs, "doc_id bigint, text string"))
    spans = {r.row.doc_id: [tuple(s) for s in r.spans] for r in got.collect()}
    assert spans == {5: [], 9: [(0, 70, 5, 20)], 7: [(3, 70, 5, 20)]}


def test_automaton_knows_all_substrings_and_their_least_label():
    rng = random.Random(2)
    texts = [[rng.choice("ab") for _ in range(rng.randint(0, 12))] for _ in range(15)]
    found = SuffixAutomaton()
    for label, text in enumerate(texts):
        found.add(text, label)
    found.finish()
    least = {}
    for label, text in enumerate(texts):
        for i in range(len(text)):
            for j in range(i + 1, len(text) + 1):
                least.setdefault("".join(text[i:j]), label)
    for _ in range(50):
        stream = [rng.choice("abc") for _ in range(30)]
        for end, (size, state) in enumerate(found.matches(stream, 4), 1):
            longest = next((n for n in range(4, 0, -1) if n <= end and "".join(stream[end - n : end]) in least), 0)
            assert size == longest
            if size:
                assert found.label[state] == least["".join(stream[end - size : end])]


def test_runs_of_places():
    places = [(1, 2, 5), (1, 2, 6), (1, 2, 8), (1, 3, 9), (1, 3, 10), (0, 3, 11)]
    assert repeats.runs_of(places) == [(2, 1, 2, 5), (1, 1, 2, 8), (2, 1, 3, 9), (1, 0, 3, 11)]
    assert repeats.runs_of([]) == []


def test_engines_agree_on_windows():
    rng = random.Random(5)
    texts = [[rng.choice([b"a", b"b", b"c"]) for _ in range(20)] for _ in range(12)]
    places = [(i, 0, 0) for i in range(12)]
    one = automaton.smallest_documents(texts, [0] * 12, places, 4, 0)
    two = suffixes.first_equal_windows(0)(texts, [0] * 12, places, 4)
    spread = lambda runs: [doc for n, doc, _, _ in runs for _ in range(n)]
    assert [spread(runs) for runs in one] == [spread(runs) for runs in two]


def test_segments_without_a_common_anchor_are_apart():
    texts = [b"a b c d e".split(), b"x b c d e".split(), b"q r s t".split()]
    found = automaton.smallest_documents(texts, [1, 1, 2], [(5, 0, 0), (3, 0, 0), (9, 0, 0)], 3, 2)
    assert found == [[(1, 5, 0, 0), (2, 3, 0, 0)], [(3, 3, 0, 0)], [(2, 9, 0, 0)]]


def test_sorted_suffixes_know_their_common_prefix():
    rng = random.Random(9)
    parts = [[rng.randrange(2) for _ in range(rng.randint(0, 9))] for _ in range(60)]
    order, common = suffixes.sorted_with_common([np.array(p, ">u4") for p in parts])
    assert [parts[i] for i in order] == sorted(parts)
    for i, (a, b) in enumerate(zip(sorted(parts), sorted(parts)[1:]), 1):
        assert common[i] == next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_matches_extend_to_both_sides_of_the_anchor():
    rng = random.Random(10)
    say = lambda n: [rng.choice([b"a", b"b"]) for _ in range(n)]
    length, gram = 8, 3
    texts, at, places = [], [], []
    for i in range(150):
        before, after = say(rng.randint(0, 5)), say(rng.randint(0, 5))
        before, after = before + say(max(0, 5 - len(before) - len(after))), after
        texts.append([*before, *rng.choice(([b"x", b"y", b"z"], [b"x", b"y", b"y"])), *after])
        at.append(len(before))
        places.append((rng.randrange(40), rng.randrange(2), 100 * i))
    first = {}
    for words, a, (doc, row, word) in zip(texts, at, places):
        for j in range(len(words) - length + 1):
            key = (a - j, *words[j : j + length])
            first[key] = min(first.get(key, (99, 0, 0)), (doc, row, word + j))
    solved = suffixes.first_equal_windows(gram)(texts, at, places, length)
    for words, a, runs in zip(texts, at, solved):
        got = [(doc, row, word + i) for n, doc, row, word in runs for i in range(n)]
        assert got == [first[(a - j, *words[j : j + length])] for j in range(len(words) - length + 1)]


def test_windows_are_compared_around_their_anchors():
    # the same words at another distance from the anchor are another window
    solved = suffixes.first_equal_windows(2)([[b"a"] * 6, [b"a"] * 6], [1, 3], [(1, 0, 0), (2, 0, 0)], 5)
    assert solved == [[(2, 1, 0, 0)], [(2, 2, 0, 0)]]
