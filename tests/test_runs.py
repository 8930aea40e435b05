import os
import random
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from noticemill.plans.search import keyword_hits, of_wanted, run_all, run_codes, run_keywords, run_notices_223, run_pages, write_by_id
from noticemill.session import new_path, shared_dir, stage
from noticemill.sources.lines import compact_lines, read_lines, write_lines
from noticemill.streaming.intake import overlooked_files, stream_lists
from noticemill.streaming.notices import stream_new_notices
from tests.conftest import plan_of, rows
from tests.test_registry import exchanges_below_joins

NUM_44 = [str(i).zfill(19) for i in range(10)]
NUM_223 = ["3" + str(i).zfill(10) for i in range(10)]
AS_OF = date(2001, 8, 1)


@pytest.fixture
def world(spark):
    """Ten notices per law; the registry knows those with even ids."""
    day = F.date_sub(F.lit(AS_OF), F.col("id").cast("int"))
    both = spark.range(10).select("id", F.explode(F.array(F.lit("44"), F.lit("223"))).alias("law"), day.alias("published_on"))
    number = F.when(F.col("law") == "44", F.lpad(F.col("id").cast("string"), 19, "0")).otherwise(
        F.concat(F.lit("3"), F.lpad(F.col("id").cast("string"), 10, "0"))
    )
    notices = both.select(
        (F.col("id") + F.when(F.col("law") == "44", 0).otherwise(100)).alias("notice_id"),
        "law",
        number.alias("notice_num"),
        "published_on",
        F.concat(F.lit("/n/"), number).alias("href"),
    )
    registry = notices.filter(F.col("notice_id") % 2 == 0).select(
        F.col("notice_id").alias("id_notification"), F.col("notice_num").alias("notificationnumber"), "law"
    )
    texts = notices.select(
        F.col("notice_id").alias("doc_id"),
        F.when(F.col("notice_id") % 100 < 6, "Сосна, елки").otherwise("Сосна").alias("text"),
    )
    lists = spark.createDataFrame([("l", 1, "сосна"), ("l", 2, "елки"), ("m", 1, "ЕЛКИ")], "list_id string, pos int, term string")
    details = notices.filter("law = '223' and notice_id <> 103").select(
        "href",
        F.concat(F.lit("https://zakupki.example/?noticeInfoId="), "notice_id").alias("final_url"),
        F.lit("/print /doc?pfid=9").alias("icon_hrefs"),
    )
    return {"notices": notices, "registry": registry, "texts": texts, "lists": lists, "details": details}


def test_keyword_run_44(world):
    got = run_keywords(world["notices"], world["registry"], world["texts"], world["lists"], "44", "all", AS_OF, 9)
    assert rows(got) == [("kw", name, NUM_44[i]) for name in "lm" for i in (1, 3, 5)]
    day = run_keywords(world["notices"], world["registry"], world["texts"], world["lists"], "44", "any", AS_OF, 1)
    assert rows(day) == [("kw", "l", NUM_44[1]), ("kw", "m", NUM_44[1])]


def test_keyword_run_in_chunks(world):
    one, two = (
        run_keywords(world["notices"], world["registry"], world["texts"], world["lists"], "44", "all", chunks=n) for n in (1, 2)
    )
    assert [r[1:] for r in rows(one)] == [(name, NUM_44[i]) for name in "lm" for i in (1, 3, 5)]
    assert [r[1:] for r in rows(two) if r[1] == "l"] == [("l", NUM_44[i]) for i in (1, 3, 5, 7, 9)]


def test_keyword_run_223(world):
    got = run_keywords(
        world["notices"], world["registry"], world["texts"], world["lists"], "223", "all", details=world["details"]
    )
    assert [line for _, name, line in rows(got) if name == "l"] == [f"{NUM_223[1]};101;9", NUM_223[3], f"{NUM_223[5]};105;9"]
    with pytest.raises(ValueError):
        run_keywords(world["notices"], world["registry"], world["texts"], world["lists"], "223", "all")


def test_texts_bucketed_by_id_are_not_shuffled(spark, world, plain_joins):
    write_by_id(world["texts"], "texts_by_id", "doc_id", 4)
    wanted = stage(world["notices"].filter("notice_id < 3"), "few")
    cut = of_wanted(spark.table("texts_by_id"), wanted, "doc_id")
    assert cut.count() == 3
    assert "Bucketed: true" in plan_of(cut)
    assert exchanges_below_joins(plan_of(cut), "texts_by_id") == 0


def test_texts_are_not_shuffled_for_many_notices(spark, world, plain_joins):
    """texts were cut by id before the search, with a shuffle of all of them where the ids are not broadcast."""
    texts = stage(world["texts"], "texts")
    hits = keyword_hits(stage(world["notices"], "wanted"), texts, world["lists"])
    assert hits.count() > 0
    assert "SortMergeJoin" in plan_of(hits) and "LeftSemi" not in plan_of(hits)


def test_attachments_are_searched(spark, world):
    attached = spark.createDataFrame([(7, "ЕЛКИ"), (7, "елки"), (9, None), (9, ""), (500, "елки")], "doc_id bigint, text string")
    args = (world["notices"], world["registry"], world["texts"], world["lists"], "44")
    got = run_keywords(*args, "all", AS_OF, 9, attachments=attached)
    assert [r[1:] for r in rows(got)] == [(name, NUM_44[i]) for name in "lm" for i in (1, 3, 5, 7)]


def test_items_are_cut_before_they_are_searched(spark, world, plain_joins):
    items = stage(spark.range(50).select(F.col("id").alias("item_id"), F.lit("10.1").alias("code")), "items")
    wanted = stage(world["notices"].filter("notice_id = 3"), "one")
    assert of_wanted(items, wanted, "item_id").count() == 1


def test_a_run_is_for_one_law(world):
    for law in (None, "45"):
        with pytest.raises(ValueError):
            run_keywords(world["notices"], world["registry"], world["texts"], world["lists"], law)
        with pytest.raises(ValueError):
            run_codes(world["notices"], world["registry"], None, None, None, law)
        with pytest.raises(ValueError):
            run_pages(world["notices"], world["registry"], law)


def test_run_over_result_pages(spark, world):
    def card(label, href):
        return f'<div class="card-item"><div class="card-item__about"><a href="{href}">{label}</a></div></div>'

    def page(*cards):
        return '<div id="content">' + "".join(card(label, href) for label, href in cards) + "</div>"

    pages = [
        (1, 1, page((f"№{NUM_44[1]}", "/a"), (f"№ {NUM_44[1]}", "/a"), (f"№{NUM_44[2]}", "/b"), ("no number", "/c"))),
        (1, 2, page((f"№{NUM_44[3]}", "/d"), ("№12", "/e"))),
        (1, 4, page((f"№{NUM_44[5]}", "/after a gap"))),
        (2, 1, page((f"№{NUM_44[1]}", "/a"))),
    ]
    found, rejects = run_pages(spark.createDataFrame(pages, "search_id int, page_num int, html string"), world["registry"], "44")
    assert rows(found) == [("1", NUM_44[1]), ("1", NUM_44[3]), ("2", NUM_44[1])]
    assert rows(rejects) == [("1", "12", "/e", "bad_length"), ("1", None, "/c", "no_number")]


def test_runs_are_put_together(spark):
    one = spark.createDataFrame([("kw", "a", "1"), ("kw", "a", "2")], "source string, list_id string, line string")
    assert rows(run_all([one, one], [one])) == [("kw", "a", "1"), ("kw", "a", "2"), ("okpd", "a", "1"), ("okpd", "a", "2")]


def test_code_run(spark, world):
    items = spark.createDataFrame([(i, f"10.{i}") for i in range(10)] + [(101, "10.1")], "item_id bigint, code string")
    tree = items.select("code").union(spark.createDataFrame([("10",)], "code string")).distinct()
    codes = spark.createDataFrame([("a", "10"), ("b", "10.3"), ("b", "0.7"), ("c", "99")], "list_id string, code string")
    got = run_codes(world["notices"], world["registry"], items, codes, tree, "44")
    assert rows(got) == [("okpd", "a", NUM_44[i]) for i in (1, 3, 5, 7, 9)] + [("okpd", "b", NUM_44[i]) for i in (3, 7)]
    got = run_codes(world["notices"], world["registry"], items, codes, tree, "223", details=world["details"])
    assert rows(got) == [("okpd", "a", f"{NUM_223[1]};101;9")]


def test_run_over_all_223_notices(world):
    got = rows(run_notices_223(world["notices"], world["registry"], world["details"]))
    assert got == [((f"{NUM_223[i]};{100 + i};9" if i != 3 else NUM_223[i]),) for i in (1, 3, 5, 7, 9)]


def test_lines_are_appended_and_compacted(spark, tmp_path):
    out, compacted = str(tmp_path / "out"), str(tmp_path / "compacted")
    lines = spark.createDataFrame(
        [("kw", "a", "01;2"), ("kw", "a", "01;2"), ("okpd", "a", "01;2"), ("kw", "44", "7 ")], "source string, list_id string, line string"
    )
    write_lines(lines, out, datetime(2001, 8, 1, 1, 2, 3))
    write_lines(lines.limit(1), out, datetime(2001, 8, 1, 1, 2, 4))
    back = read_lines(spark, out, with_source=True)
    assert back.count() == 5
    assert {r.run_ts for r in back.collect()} == {"01_08_2001_01_02_03", "01_08_2001_01_02_04"}
    compact_lines(spark, out, compacted, datetime(2001, 8, 2), with_source=True)
    compact = read_lines(spark, compacted, with_source=True).select("source", "list_id", "line")
    assert rows(compact) == [("kw", "44", "7"), ("kw", "a", "01;2"), ("okpd", "a", "01;2")]


def test_no_folder_when_nothing_is_new(spark, tmp_path):
    out = tmp_path / "out"
    write_lines(spark.createDataFrame([], "list_id string, line string"), str(out), datetime(2001, 8, 1))
    assert [p for p in out.iterdir() if p.name.startswith("list_id=")] == []


def test_shared_folder_is_the_one_of_the_session(spark):
    assert new_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert new_path(spark, "x") != new_path(spark, "x")
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_staged_table_has_the_same_rows_and_no_lineage(spark):
    df = spark.createDataFrame([(1, "44"), (2, None)], "i int, law string")
    staged = stage(df.filter("i > 0"), "t")
    assert rows(staged) == rows(df) and staged.schema == df.schema
    assert "Filter (" not in plan_of(staged)


def test_dropped_lists_are_read_once_and_archived(spark, tmp_path):
    drop, archive = tmp_path / "drop", tmp_path / "archive"
    drop.mkdir()
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def intake():
        stream_lists(spark, str(drop), str(archive), out, state, files_per_batch=1).awaitTermination()
        return rows(spark.read.parquet(out).select("list_id", "pos", "term"))

    (drop / "a.txt").write_bytes("сосна\n\nелки".encode())
    time.sleep(0.05)
    (drop / "b.txt").write_bytes("лекарство\r\n".encode("cp1251"))
    first = [("a.txt", 1, "сосна"), ("a.txt", 3, "елки"), ("b.txt", 1, "лекарство")]
    assert intake() == first
    (drop / "c.txt").write_bytes(b"10.86.10.191")
    assert intake() == [*first, ("c.txt", 1, "10.86.10.191")]
    archived = {p.name for p in archive.rglob("*.txt")}
    assert {"a.txt", "b.txt"} <= archived and not archived & {p.name for p in drop.iterdir()}


def test_new_notices_are_reported_once(spark, tmp_path):
    landed, out, state = str(tmp_path / "landed"), str(tmp_path / "out"), str(tmp_path / "state")
    schema = "law string, notice_num string, published_ts timestamp"
    registry = [(1, NUM_44[0], "44")]

    def land(*notices):
        ts = [(law, num, datetime(2001, 8, day)) for law, num, day in notices]
        spark.createDataFrame(ts, schema).write.mode("append").parquet(landed)
        known = lambda: spark.createDataFrame(registry, "id_notification bigint, notificationnumber string, law string")
        stream_new_notices(spark, landed, schema, known, out, state, window_days=10).awaitTermination()
        return [(law, num) for law, num, *_ in rows(spark.read.parquet(out))]

    first = [("223", NUM_223[1]), ("44", NUM_44[1])]
    assert land(("44", NUM_44[0], 1), ("44", NUM_44[1], 1), ("44", NUM_44[1], 1), ("223", NUM_223[1], 2), ("44", "1", 1)) == first
    registry.append((2, NUM_44[2], "44"))
    second = land(("44", NUM_44[1], 3), ("44", NUM_44[2], 3), ("44", NUM_44[3], 3), ("223", None, 3))
    assert second == sorted([*first, ("44", NUM_44[3])])


@pytest.mark.parametrize("files_per_batch", [1, 2, 1000])
def test_files_in_any_order_give_the_notices_of_their_union(spark, tmp_path, files_per_batch):
    landed, out, state = str(tmp_path / "landed"), str(tmp_path / "out"), str(tmp_path / "state")
    schema = "law string, notice_num string, published_ts timestamp"
    rng = random.Random(files_per_batch)
    files = [[("44", NUM_44[rng.randrange(10)], datetime(1999 + rng.randrange(4), 1, 1 + i)) for _ in range(4)] for i in range(7)]
    for file in files:
        spark.createDataFrame(file, schema).coalesce(1).write.mode("append").parquet(landed)
    registry = [(1, NUM_44[0], "44"), (2, NUM_44[4], "44")]
    known = lambda: spark.createDataFrame(registry, "id_notification bigint, notificationnumber string, law string")
    stream_new_notices(spark, landed, schema, known, out, state, window_days=1, files_per_batch=files_per_batch).awaitTermination()
    got = rows(spark.read.parquet(out).select("law", "notice_num"))
    assert got == sorted({(law, num) for file in files for law, num, _ in file} - {("44", NUM_44[0]), ("44", NUM_44[4])})


def test_old_list_files_are_read(spark, tmp_path):
    drop, out = tmp_path / "drop", str(tmp_path / "out")
    drop.mkdir()
    (drop / "new.txt").write_bytes(b"new")
    (drop / "old.txt").write_bytes(b"old")
    ten_days_ago = time.time() - 10 * 86400
    os.utime(drop / "old.txt", (ten_days_ago, ten_days_ago))
    stream_lists(spark, str(drop), str(tmp_path / "archive"), out, str(tmp_path / "state"), files_per_batch=1).awaitTermination()
    assert rows(spark.read.parquet(out).select("list_id")) == [("new.txt",), ("old.txt",)]


def test_overlooked_files_are_listed(spark, tmp_path):
    for name, days in (("new.txt", 0), ("old.txt", 10)):
        (tmp_path / name).write_bytes(b"x")
        os.utime(tmp_path / name, (time.time() - days * 86400,) * 2)
    named = lambda age: [r.path.rsplit("/", 1)[1] for r in overlooked_files(spark, str(tmp_path), age).collect()]
    assert named("7d") == named("36h") == named(" 90 min") == ["old.txt"] and named("30d") == named("900h") == []
