"""Streams with state and timers, run after run."""

import time
from datetime import date, datetime
from pathlib import Path
from types import SimpleNamespace

import pandas as pd

from noticemill import catalog
from noticemill.operators.registry import new_numbers
from noticemill.session import new_path
from noticemill.streaming.matches import missed_texts, stream_keyword_run
from noticemill.streaming.pages import PAGE_SCHEMA, PagesInOrder, stream_pages
from noticemill.streaming.reruns import report_run
from tests.conftest import SMALL

NOTICE = "law string, notice_num string, published_on date"
KNOWN = "id_notification bigint, notificationnumber string, law string"


def number(i):
    return f"{i:019d}"


def test_a_number_is_reported_until_registered_or_too_old(spark, tmp_path):
    landed, out, runs, state = (str(tmp_path / n) for n in ("landed", "out", "runs", "state"))
    registered = [(1, number(99), "44")]

    def registry():
        return spark.createDataFrame(registered, KNOWN)

    def run(as_of, rows=()):
        if rows:
            spark.createDataFrame(rows, NOTICE).write.mode("append").parquet(landed)
        report_run(spark, landed, NOTICE, registry, out, runs, state, as_of, days=10).awaitTermination()
        got = spark.read.parquet(out).filter(f"run_on = '{as_of}'").collect()
        window = spark.read.schema(NOTICE).parquet(landed).filter(f"published_on between date'{as_of}' - 10 and date'{as_of}' and length(notice_num) = 19")
        assert sorted(r.notice_num for r in got) == sorted(r.notice_num for r in new_numbers(window, registry()).collect())
        return sorted(int(r.notice_num) for r in got)

    first = [
        ("44", number(1), date(2001, 8, 1)),
        ("44", number(1), date(2001, 7, 30)),  # the same number again
        ("44", number(2), date(2001, 7, 25)),
        ("44", number(3), date(2001, 8, 4)),  # not yet
        ("44", number(99), date(2001, 8, 1)),  # known
        ("44", "12", date(2001, 8, 1)),  # malformed
        ("44", None, date(2001, 8, 1)),
        ("44", number(5), None),
    ]
    assert run(date(2001, 8, 1), first) == [1, 2]
    assert run(date(2001, 8, 2)) == [1, 2]  # again, with nothing landed
    registered.append((2, number(1), "44"))
    assert run(date(2001, 8, 4), [("44", number(4), date(2001, 8, 2))]) == [2, 3, 4]
    assert run(date(2001, 8, 5)) == [3, 4]  # 2 is out of the window
    registered.append((None, number(3), "44"))  # a row without id does not make it known
    assert run(date(2001, 8, 6)) == [3, 4]
    assert run(date(2001, 8, 30)) == []


def html_of(search, page):
    return f'<div id="content"><div class="card-item"><div class="card-item__about"><a href="/{search}/{page}">№{page}</a></div></div></div>'


def land(spark, folder, pages):
    rows = [(s, p, html_of(s, p) if s is not None else "") for s, p in pages]
    spark.createDataFrame(rows, PAGE_SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def released(spark, out):
    rows = spark.read.parquet(out).collect()
    return sorted((r.search_id, r.page_num) for r in rows if r.card_pos is not None), sorted((r.search_id, r.page_num) for r in rows if r.given_up)


def test_pages_leave_in_any_order_once_there_is_no_gap(spark, tmp_path):
    landed, out, state = (str(tmp_path / n) for n in ("landed", "out", "state"))
    land(spark, landed, [(1, 3), (1, 1), (2, 2), (3, 1), (3, 1), (None, 1), (4, 0), (4, None)])
    stream_pages(spark, landed, out, state).awaitTermination()
    assert released(spark, out) == ([(1, 1), (3, 1), (3, 1)], [])
    land(spark, landed, [(1, 2), (1, 5), (3, 3), (3, 3), (2, 3)])
    stream_pages(spark, landed, out, state).awaitTermination()
    assert released(spark, out)[0] == [(1, 1), (1, 2), (1, 3), (3, 1), (3, 1)]
    land(spark, landed, [(3, 2), (2, 1), (1, 1)])
    stream_pages(spark, landed, out, state).awaitTermination()
    assert released(spark, out) == ([(1, 1), (1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3), (3, 1), (3, 1), (3, 2), (3, 3), (3, 3)], [])


def test_a_search_that_waits_too_long_gives_its_pages_up(spark, tmp_path):
    landed, out, state = (str(tmp_path / n) for n in ("landed", "out", "state"))
    land(spark, landed, [(1, 1), (1, 3), (1, 4), (2, 1)])
    stream_pages(spark, landed, out, state, patience_ms=500).awaitTermination()
    assert released(spark, out) == ([(1, 1), (2, 1)], [])
    time.sleep(1)
    land(spark, landed, [(2, 2)])
    stream_pages(spark, landed, out, state, patience_ms=500).awaitTermination()
    assert released(spark, out) == ([(1, 1), (2, 1), (2, 2)], [(1, 3), (1, 4)])
    land(spark, landed, [(1, 2)])
    stream_pages(spark, landed, out, state, patience_ms=500).awaitTermination()
    assert released(spark, out)[0] == [(1, 1), (1, 2), (2, 1), (2, 2)]


def test_texts_meet_their_notices_whenever_they_land(spark, tmp_path):
    notice_schema = "notice_id bigint, law string, notice_num string, published_on date, landed_at timestamp"
    text_schema = "doc_id bigint, text string, landed_at timestamp"
    notices, texts, out, state = (str(tmp_path / n) for n in ("notices", "texts", "out", "state"))
    lists = spark.createDataFrame([("l", "Pine"), ("l", "fir"), ("m", "oak")], "list_id string, term string")
    known = spark.createDataFrame([(1, number(3), "44")], KNOWN)

    def day(n):
        return datetime(2001, 8, n)

    def run(new_notices, new_texts):
        rows = [(i, law, num, date(2001, 8, 1), day(d)) for i, law, num, d in new_notices]
        spark.createDataFrame(rows, notice_schema).write.mode("append").parquet(notices)
        spark.createDataFrame([(i, t, day(d)) for i, t, d in new_texts], text_schema).write.mode("append").parquet(texts)
        stream_keyword_run(spark, notices, notice_schema, texts, lists, lambda: known, out, state, policy="all").awaitTermination()
        got = spark.read.schema("list_id string, notice_num string").parquet(f"{out}/lines").collect()
        return sorted((r.list_id, int(r.notice_num)) for r in got)

    first = [(1, "44", number(1), 1), (2, "44", number(2), 1), (3, "44", number(3), 1), (4, "223", "30000000004", 1)]
    assert run(first, [(1, "PINES", 1), (1, None, 1), (3, "oak", 1), (4, "oak", 1), (5, "oak", 1), (None, "oak", 1)]) == []
    # the second term of 1 in another text, the notice of 5 after its text, 2 too far from its text
    got = run([(5, "44", number(5), 2), (5, "44", number(5), 2)], [(1, "a fir tree", 2), (1, "fir", 2), (2, "oak", 12)])
    assert got == [("l", 1), ("m", 5)]
    assert run([(9, "44", number(9), 28)], [(9, "oak", 28)]) == [("l", 1), ("m", 5), ("m", 9)]
    # 2 would have met this text, but it comes after the state of its time is gone
    assert run([(10, "44", number(10), 28)], [(2, "oak", 3)]) == [("l", 1), ("m", 5), ("m", 9)]
    all_notices, all_texts = spark.read.parquet(notices), spark.read.parquet(texts)
    missed = missed_texts(all_notices, all_texts, lists, out).collect()
    assert [(r.doc_id, r.landed_at) for r in missed] == [(2, day(3))]


def test_the_keyword_runs_make_a_batch_per_portion_however_many_files_it_has(spark, monkeypatch):
    """each file of the notices was a batch, so the batches grew with the tables."""
    made = []
    monkeypatch.setattr(catalog, "new_path", lambda session, name: made.append((name, new_path(session, name))) or made[-1][1])

    def batches():
        made.clear()
        rows = catalog.queries()["stream_kw_44"](spark, SMALL).collect()
        files = [f for name, path in made if name == "landed-notices" for f in Path(path).glob("part-*")]
        return sorted(rows), len(files), [len(list(Path(path).glob("met/batch_id=*"))) for name, path in made if name == "matches"]

    rows, few, once = batches()
    monkeypatch.setattr(catalog.Fixtures, "notices", property(lambda tables: tables._land("notices").repartition(4)), raising=False)
    again, many, more = batches()
    assert many > few and rows == again and rows
    assert once == more and max(more) <= 6


class Kept:
    """A value or map of the state that counts how often it is asked."""

    calls = 0

    def __init__(self, *_):
        self.rows = {}

    def _counted(result):
        def method(self, *args):
            Kept.calls += 1
            return result(self.rows, *args)

        return method

    exists = _counted(lambda rows: bool(rows))
    get = _counted(lambda rows: rows[None])
    update = _counted(lambda rows, value: rows.update({None: value}))
    containsKey = _counted(lambda rows, key: key in rows)
    getValue = _counted(lambda rows, key: rows.get(key))
    updateValue = _counted(lambda rows, key, value: rows.update({key: value}))
    removeKey = _counted(lambda rows, key: rows.pop(key))


def handled(processor, *parts):
    frames = [pd.DataFrame([(p, str(p)) for p in part], columns=["page_num", "html"]) for part in parts]
    now = SimpleNamespace(getCurrentProcessingTimeInMs=lambda: 0)
    out = [frame["page_num"].tolist() for frame in processor.handleInputRows((1,), iter(frames), now)]
    return [part for part in out if part]


def test_waiting_pages_are_kept_and_handed_on_many_at_a_time():
    """each waiting page was asked for, read, taken away and handed on alone."""
    processor = PagesInOrder(None)
    processor.init(SimpleNamespace(getValueState=Kept, getMapState=Kept))
    assert handled(processor, range(2, 2000), range(2001, 4000)) == []
    Kept.calls = 0
    first = handled(processor, [1])
    assert sum(first, []) == list(range(1, 2000)) and len(first) < 20 and Kept.calls < 100
    assert sum(handled(processor, [4001], [2000]), []) == list(range(2000, 4000))
    assert handled(processor, [4000]) == [[4000], [4001]]


def test_a_page_that_waits_and_lands_again_leaves_twice():
    processor = PagesInOrder(None)
    processor.init(SimpleNamespace(getValueState=Kept, getMapState=Kept))
    assert handled(processor, [254, 255, 257]) == []
    assert sorted(sum(handled(processor, range(1, 250), [250, 251, 252, 253, 254, 255]), [])) == sorted([*range(1, 256), 254, 255])
    assert sum(handled(processor, [256]), []) == [256, 257]
