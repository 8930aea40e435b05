"""Quality rules, licence scan, decontamination, URLs, language model, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from noticemill.llm import contamination, licenses, lm, quality, urls
from noticemill.llm.queries import queries
from tests.conftest import SMALL, plan_of, rows
from tests.llm.helpers import edge_documents, empty, prose, rows_of, white_words

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return PLAIN.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


# Quality rules


def measured(text):
    words = white_words(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if white_words(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines), len(lines) - len(set(lines)), len(repeated)


def test_measurements_of_edge_texts(spark):
    docs = edge_documents(spark)
    got = quality.measurements(docs)
    assert rows(got) == sorted(((d, *measured(t)) for d, t in rows_of(docs)), key=repr)
    assert "Exchange" not in plan_of(got) and "Python" not in plan_of(got)


def test_repeated_windows_of_random_texts(spark):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choices("abcde", k=rng.randint(0, 40)))) for i in range(80)]
    got = quality.measurements(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert rows(got) == sorted(((d, *measured(t)) for d, t in docs), key=repr)


def test_ledger_policies_and_ablations(spark):
    rng = random.Random(1)
    good = [prose(rng, 80) for _ in range(5)]
    texts = good + ["few words", "#$% " * 60, "w\n" * 60, "x", good[0] + " #" * 200]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    ledger = quality.rule_ledger(docs).cache()
    bits = {r.doc_id: {n for i, (n, _) in enumerate(quality.RULES) if r.failed >> i & 1} for r in ledger.collect()}
    assert all(not bits[i] for i in range(5))
    assert bits[5] == {"too_few_words"}
    assert bits[6] >= {"symbols", "repeated_words"} and bits[7] >= {"repeated_lines", "short_words"}
    for policy in (*quality.POLICIES.values(), quality.Policy(9, ("symbols",))):
        kept = {r.doc_id for r in quality.judged(ledger, policy).filter("kept").collect()}
        assert kept == {d for d, failed in bits.items() if not failed & set(policy.rules)}
        report = {r.rule: r for r in quality.ablations(ledger, policy).collect()}
        assert set(report) == set(policy.rules)
        for name, r in report.items():
            assert r.n_failed == sum(name in failed for failed in bits.values())
            assert r.n_only == sum(failed & set(policy.rules) == {name} for failed in bits.values())
            assert r.n_rejected == sum(bool(failed & set(policy.rules)) for failed in bits.values())
    assert rows(quality.accepted(docs).select("doc_id")) == [(i,) for i in range(5)]
    ledger.unpersist()


def test_accepted_rows_keep_their_columns(spark):
    docs = edge_documents(spark)
    kept = quality.accepted(docs)
    assert kept.columns == docs.columns and kept.count() > 0
    assert quality.accepted(empty(spark)).collect() == []
    assert quality.ablations(quality.rule_ledger(empty(spark))).select("n_rejected").distinct().collect()[0][0] == 0


# Licence scan


def base_places(text):
    words = plain_words(text)
    found = []
    for phrase, label in licenses.BASE_PHRASES.items():
        parts = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    return len(words), sorted(found)


def check_base(got, docs):
    want = []
    for doc_id, text in docs:
        n, found = base_places(text)
        at = [i for i, _ in found]
        labels = ",".join(sorted({label for _, label in found}))
        want.append((doc_id, n, len(at), min(at, default=None), max(at, default=None), labels))
    assert rows(got.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")) == sorted(want, key=repr)


def test_licence_query(spark):
    docs = rows_of(spark.read.parquet(f"{SMALL}/documents.parquet"))
    got = queries()["op4_license_scan"](spark, SMALL)
    check_base(got, docs)
    assert "Python" not in plan_of(got) and "Arrow" not in plan_of(got)
    for r in got.collect():
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score == 1) >= (r.n_base > 0)


def test_licence_edge_texts_and_templates(spark):
    notices = [text for text, _ in licenses.TEMPLATES.values()]
    extra = [f"start {n} and then {prose(random.Random(i), 30)}" for i, n in enumerate(notices)]
    extra += ["MIT License mit LICENSE apache-license", "mit x license", "software and associated files", "cc by nc " * 3000]
    docs = edge_documents(spark).select("doc_id", "text", "row")
    more = spark.createDataFrame([(100 + i, t, 0) for i, t in enumerate(extra)], "doc_id bigint, text string, row int")
    got = licenses.scan(docs.unionByName(more))
    check_base(got, rows_of(docs) + [(100 + i, t) for i, t in enumerate(extra)])
    labels = {r.doc_id: r.labels.split(",") for r in got.collect()}
    for i, label in enumerate(licenses.TEMPLATES):
        assert label in labels[100 + i], label
    assert labels[100 + len(notices) + 1] == labels[100 + len(notices) + 2] == [""]
    assert licenses.scan(empty(spark)).collect() == []


def test_all_notices_in_one_long_text(spark):
    notices = [text for text, _ in licenses.TEMPLATES.values()]
    ordinary = " ".join(w for text in notices for w in sorted(plain_words(text)))  # each licence word, none in place
    texts = [" and then ".join(notices)]
    texts += [" ".join([prose(random.Random(i), 400), ordinary, n, prose(random.Random(-i), 400)]) for i, n in enumerate(notices)]
    other = [prose(random.Random(100 + i), 30) for i in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts + other)), "doc_id bigint, text string")
    found = {r.doc_id: {f.label: f.share for f in r.found} for r in licenses.scan(docs).collect()}
    assert found[0].keys() == licenses.TEMPLATES.keys()
    for i, label in enumerate(licenses.TEMPLATES, 1):
        assert label in found[i], label
        assert found[0][label] > 0.999 and found[i][label] > 0.999, label


# Decontamination


def brute_contamination(docs, items, size=13):
    windows = []
    for item_id, text in items:
        words = plain_words(text)
        m = min(size, len(words))
        windows += [(item_id, words[i : i + m]) for i in range(len(words) - m + 1) if m]
    out = []
    for doc_id, text in docs:
        words = plain_words(text)
        hit, found = set(), set()
        for item_id, window in windows:
            for i in range(len(words) - len(window) + 1):
                if words[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    found.add(item_id)
        named = sorted(str(x) for x in found if x is not None)
        out.append((doc_id, len(words), len(hit), len(named), ",".join(named), bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(out, key=repr)


def contaminated(docs, items):
    got = contamination.contaminated(docs, items)
    return rows(got.select("doc_id", "n_words", "n_hit", "n_items", F.array_join("items", ","), "contaminated"))


@pytest.mark.parametrize("per_pass", [20_000, 2])
def test_contamination_against_brute_force(spark, monkeypatch, per_pass):
    if per_pass == 2:
        monkeypatch.setattr(contamination, "TERMS_PER_PASS", 40)
        monkeypatch.setattr(contamination, "BROADCAST_TERMS", 0)
    rng = random.Random(6)
    vocabulary = ["the", "of", "and", *prose(rng, 25).split()]
    say = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, say(rng.choice((1, 2, 5, 12, 13, 14, 20, 30)))) for i in range(14)]
    items += [(14, None), (15, " .,; "), (None, say(15)), (3, say(16)), (16, items[5][1]), (17, "the the " * 9)]
    docs = []
    for i in range(50):
        parts = [say(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 2)):
            words = plain_words(rng.choice(items)[1])
            parts += [", ".join(words[rng.randint(0, 2) : len(words) - rng.randint(0, 1)]).upper(), say(rng.randint(0, 9))]
        docs.append((i, ". ".join(parts)))
    docs += [(50, None), (51, ""), (None, docs[4][1]), (7, docs[9][1]), docs[3]]
    got = contaminated(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    )
    assert got == brute_contamination(docs, items)


def test_contamination_edge_documents(spark):
    docs = edge_documents(spark)
    items = spark.createDataFrame([(1, rows_of(docs)[6][1]), (2, "one"), (3, "日本語")], "item_id bigint, text string")
    want = brute_contamination(rows_of(docs), rows_of(items.withColumnRenamed("item_id", "doc_id")))
    assert contaminated(docs, items) == want
    clean = contamination.clean(docs, items)
    assert clean.columns == docs.columns
    assert clean.count() == sum(not w[-1] for w in want)
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert {r[2:] for r in contaminated(docs, none)} == {(0, 0, "", False)}
    assert contaminated(empty(spark), items) == []


def test_words_near_each_other(spark):
    docs = [(1, "zebra likes yellow apples and xylophones"), (2, "xylophones " + "word " * 40 + "zebra yellow"), (3, "zebra")]
    items = [(9, "the zebra plays yellow xylophones")]
    got = contamination.near_matches(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame([(i, t.replace("the ", "").replace("plays ", "")) for i, t in items], "item_id bigint, text string"),
        within=10,
    )
    assert [(r.doc_id, r.item_id, r["first"]) for r in got.collect()] == [(1, 9, 0)]


# URLs


def brute_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [
        r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best.name if best else None, best.verdict if best else None


ODD_URLS = [
    None, "", "no scheme", "://", "http://", "https://ORG", "https://org/", "https://EXAMPLE.org/es/1", "http://a.example.org/es",
    "http://a.example.org/en/12?x=1", "http://notexample.org/en/1", "ftp://x.com/de/#f", "http://x.com?/de/", "http://x.com/fr/a/b",
    "http://com/fr/", "http://a.b/c://org/", "http://x.com/de/" + "a" * 5000, "http://юникод.org/путь", "http://x.com/fr/a/b",
]


def test_url_query(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    got = queries()["op2_url_trees"](spark, SMALL)
    assert "Python" not in plan_of(got) and "Arrow" not in plan_of(got)
    check_urls({r.page_id: r for r in got.collect()}, [(p.page_id, p.url) for p in pages])


def check_urls(got, pages):
    assert len(got) == len(pages)
    for page_id, url in pages:
        host, path, rule, verdict = brute_rule(url)
        r = got[page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")


def test_odd_urls(spark):
    pages = list(enumerate(ODD_URLS))
    df = spark.createDataFrame([(i, u, "x", 1) for i, u in pages], "page_id bigint, url string, host string, rule int")
    check_urls({r.page_id: r for r in urls.judge(df).collect()}, pages)
    assert urls.judge(df.limit(0)).collect() == []
    only_null = spark.createDataFrame([(1, None)], "page_id bigint, url string")
    assert [r.verdict for r in urls.judge(only_null).collect()] == ["allow"]


def test_trees_learn_from_labelled_urls(spark):
    rng = random.Random(2)
    name = lambda: prose(rng, 1)
    bad = lambda: f"http://{name()}-{name()}-{rng.randrange(10**6)}.biz/{rng.randrange(10**9)}?a={rng.randrange(99)}&b=1"
    good = lambda: f"https://www.{name()}.info/{name()}/{name()}.html"
    labelled = spark.createDataFrame([(bad(), 1) for _ in range(150)] + [(good(), 0) for _ in range(150)], "url string, label int")
    held_out = [(i, (bad if i % 2 else good)()) for i in range(100)]
    got = urls.judge(spark.createDataFrame(held_out, "page_id bigint, url string"), rules=(), labelled=labelled)
    right = sum((r.verdict == "block") == bool(r.page_id % 2) for r in got.collect())
    assert right >= 95


# Language model


def brute_base(docs):
    held = {k: d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for k, (d, _) in enumerate(docs)}
    count = Counter(t for k, (_, text) in enumerate(docs) if not held[k] for t in lm.tokens(text))
    n, v = sum(count.values()), len(count)
    out = []
    for k, (doc_id, text) in enumerate(docs):
        found = lm.tokens(text)
        base = sum(math.log10((count[t] + 1) / (n + v + 1)) for t in found)
        out.append((doc_id, held[k], len(found), sum(count[t] > 0 for t in found), n, round(base, 6)))
    return sorted(out, key=repr)


def scored(df):
    got = df.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6).alias("b"))
    return rows(got)


def test_language_model_query(spark):
    docs = rows_of(spark.read.parquet(f"{SMALL}/documents.parquet"))
    got = queries()["op7_bloom_lm"](spark, SMALL)
    assert scored(got) == brute_base(docs)
    sums = got.groupBy("held_out").agg(F.sum("base_score").alias("base"), F.sum("score").alias("score"))
    for r in sums.collect():
        assert r.score > r.base


def scores_of(df, fields):
    return sorted(((*(r[f] for f in fields), round(r.score, 7)) for r in df.collect()), key=repr)


def test_slices_and_blocks_change_no_score(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    monkeypatch.setattr(lm, "SEGMENT_BIGRAMS", 5000)
    whole = scores_of(lm.score(docs), ("doc_id",))
    monkeypatch.setattr(lm, "BLOCK_BYTES", 50_000)
    rows = lm.with_fold(docs)
    stored = lm.count_filter(rows, lm.read_corpus(rows).train_tokens, 20_000)
    assert len(stored.slices()) > 2
    assert scores_of(lm.score(docs, max_filter_bytes=20_000), ("doc_id",)) == whole


def test_held_out_texts_are_foretold_better(spark):
    """By far more than by words alone, and by more than with one weight for all histories."""
    got = lm.score(spark.read.parquet(f"{SMALL}/documents.parquet")).filter("held_out")
    a_token = got.agg(F.sum("base_score") / F.sum("n_tokens"), F.sum("score") / F.sum("n_tokens")).first()
    assert a_token[1] > a_token[0] + 0.2


def test_probabilities_add_up_to_one():
    rng = np.random.default_rng(9)
    text = rng.integers(0, 30, 2000) ** 2 // 30
    text = np.append(text, text[0])  # every token is a history, and follows one
    v = 31  # one word that training does not hold
    counts = np.zeros((v, v))
    np.add.at(counts, (text[:-1], text[1:]), 1)
    totals = counts.sum(1)
    unigram = (totals + 1) / (totals.sum() + (totals > 0).sum() + 1)
    unknown = (totals == 0).sum()
    unigram[totals == 0] /= unknown
    sums = [float((totals[totals > 0] ** b).sum()) for b in lm.EXPONENTS]
    bigrams = int((counts > 0).sum())
    exponent = lm.successor_exponent(sums, bigrams)
    assert math.isclose((totals[totals > 0] ** exponent).sum(), bigrams, rel_tol=1e-3)
    for h in range(v):
        p = lm.interpolated(counts[h], np.full(v, totals[h]), unigram, exponent)
        assert math.isclose(p.sum(), 1) and (p > 0).all()
        assert totals[h] or (p == unigram).all()


def test_exponent_without_training_or_variety():
    assert lm.successor_exponent([0.0] * len(lm.EXPONENTS), 0) == 1.0
    assert lm.successor_exponent([5.0] * len(lm.EXPONENTS), 5) == 1.0
    assert (lm.history_weights(np.array([0, 1, 100]), 1.0) == [0, 0.5, 0.5]).all()


def test_language_model_edge_documents(spark, monkeypatch):
    docs = edge_documents(spark)
    monkeypatch.setattr(lm, "SEGMENT_BIGRAMS", 500)
    whole = lm.score(docs)
    assert scored(whole) == brute_base(rows_of(docs))
    monkeypatch.setattr(lm, "BLOCK_BYTES", 2000)
    sliced = lm.score(docs, max_filter_bytes=100)
    assert scored(sliced) == brute_base(rows_of(docs))
    fields = ("doc_id", "n_tokens", "held_out")
    assert scores_of(sliced, fields) == scores_of(whole, fields)
    assert lm.score(empty(spark)).collect() == []


def level_of(counts):
    return np.where(counts > 0, 1 + np.floor(np.log2(np.maximum(counts, 1))), 0)


def test_filter_gives_the_level_of_a_count():
    rng = np.random.default_rng(4)
    hashes = np.unique(rng.integers(0, 2**63, 5000, dtype=np.uint64) * np.uint64(2))
    counts = np.maximum(1, (rng.pareto(0.7, len(hashes))).astype(np.int64))
    segments = 7
    owner = lm.segment_of(hashes, segments)
    parts = [lm.filter_segment(hashes[owner == s] & lm.LOW_40, counts[owner == s]) for s in range(segments)]
    mine, found = lm.CountFilter(segments, 0, parts).levels(hashes)
    assert mine.all()
    assert (found >= level_of(counts)).all()
    assert (found == level_of(counts)).mean() > 0.97
    unseen = np.unique(rng.integers(0, 2**63, 5000, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    assert (lm.CountFilter(segments, 0, parts).levels(unseen)[1] > 0).mean() < 0.03
    part = lm.CountFilter(segments, 2, parts[2:5])
    mine, found_part = part.levels(hashes)
    assert (mine == ((owner >= 2) & (owner < 5))).all()
    assert (found_part[mine] == found[mine]).all()
    seen = rng.integers(0, counts + 1)
    assert (lm.CountFilter(segments, 0, parts).levels(hashes, seen)[1] == found).all()


def test_a_level_counts_as_its_mean(spark):
    """`a b` three times, `b c` twice, seven times `d e`: levels 2, 2 and 3."""
    text = "a b x a b y a b z b c v b c w " + " ".join(f"d e q{i}" for i in range(7))
    docs = spark.createDataFrame([(1, text, False)], "doc_id bigint, text string, held_out boolean")
    stored = lm.count_filter(docs, 60)
    assert stored.means[0] == 0 and stored.means[1] == 1
    assert math.isclose(stored.means[2], 2.5) and stored.means[3:].tolist() == [7.0] * 62
    assert stored.bigrams == len({*zip(["", *text.split()], [*text.split(), ""])})


def test_bigrams_that_training_holds_once_count(spark):
    rng = random.Random(7)
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2]
    learnt = [i for i in range(200) if i not in held]
    words = prose(rng, 40).split()
    shuffled = words[::2] + words[1::2]
    docs = [(learnt[0], " ".join(words)), (held[0], " ".join(words)), (held[1], " ".join(shuffled))]
    got = {r.doc_id: r for r in lm.score(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    shared, other = got[held[0]], got[held[1]]
    assert shared.held_out and other.held_out and math.isclose(shared.base_score, other.base_score)
    # all 41 bigrams stand once in training, each of its words too
    count = Counter(words)
    assert max(count.values()) == 1
    # a history seen once weighs 1 / (1 + 1) whatever the exponent
    estimate = 0.5 + 0.5 * 2 / (41 + 41 + 1)
    assert math.isclose(shared.score, 41 * math.log10(estimate))
    assert shared.score > other.score + 20


def test_digest_of_items_is_that_of_their_names(spark):
    empty_digest = hashlib.sha256(b"").hexdigest()
    got = queries()["op5_decontamination"](spark, SMALL)
    assert {r.items_sha256 for r in got.filter("n_items = 0").collect()} == {empty_digest}
