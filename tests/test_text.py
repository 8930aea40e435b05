import pytest
from pyspark.sql import functions as F

from noticemill.functions import text
from noticemill.functions.validity import check_law, reject_reason
from noticemill.sources.lists import list_id_from_path, read_terms, scan_lists, single_term_list, strip_terms
from tests.conftest import rows


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize("raw", ["  a\t", "\r\na\x0b", " a ", "\x1ca\x85", "a b", "", "   ", "　x　"])
def test_strip_is_unicode_strip(spark, raw):
    assert one(spark, raw, text.strip) == raw.strip()


@pytest.mark.parametrize(
    "label, number",
    [
        ("Извещение №0123", "0123"),
        ("Извещение № 77 от 5", "77"),
        ("№ 42", "42"),
        ("№ 42", "42"),
        ("№\t42", "42"),
        ("№  42", None),
        ("Извещение без номера", None),
        ("№", None),
        ("", None),
        (None, None),
        ("№12 №34", "12"),
    ],
)
def test_notice_number(spark, label, number):
    assert one(spark, label, text.notice_number) == number


def test_ids_of_urls(spark):
    assert one(spark, "https://h/view?x=1&noticeInfoId=15&y=2", text.notice_info_id) == "15"
    assert one(spark, "https://h/view?noticeInfoId=", text.notice_info_id) is None
    assert one(spark, "https://h/doc?pfid=007", text.pfid) == "007"
    assert one(spark, "https://h/doc", text.pfid) is None


def test_first_link_with(spark):
    first = lambda c: text.first_link_with(F.split(c, " "), "pfid")
    assert one(spark, "/a /b?pfid=1 /c?pfid=2", first) == "/b?pfid=1"
    assert one(spark, "/a /b", first) is None


@pytest.mark.parametrize("label, hits", [("1 234", 1234), ("Найдено: 7", 7), ("1 000 001", 1000001), ("", None), ("нет", None)])
def test_hit_count(spark, label, hits):
    assert one(spark, label, text.hit_count) == hits


def test_full_pages_rounds_down(spark):
    pages = spark.createDataFrame([(0,), (9,), (10,), (1234,), (None,)], "v bigint").select(text.full_pages(F.col("v")).alias("p"))
    assert [r.p for r in pages.collect()] == [0, 0, 1, 123, None]


def test_output_line_skips_empty_fields(spark):
    df = spark.createDataFrame([("1", "2", "3"), ("1", "", ""), ("1", None, None)], "n string, i string, p string")
    lines = df.select(text.output_line(F.col("n"), F.col("i"), F.col("p")).alias("r"))
    assert [r.r for r in lines.collect()] == ["1;2;3", "1", "1"]


def test_date_label(spark):
    assert one(spark, "2001-02-03", lambda c: text.date_label(c.cast("date"))) == "03-02-2001"


@pytest.mark.parametrize(
    "law, number, reason",
    [
        ("44", "0" * 19, None),
        ("44", "0" * 18, "bad_length"),
        ("44", "3" * 11, "bad_length"),
        ("223", "3" + "0" * 10, None),
        ("223", "4" + "0" * 10, "bad_prefix"),
        ("223", "3" + "0" * 9, "bad_length"),
        ("223", "0" * 19, "bad_length"),
        ("44", None, "no_number"),
        ("223", None, "no_number"),
    ],
)
def test_reject_reason(spark, law, number, reason):
    df = spark.createDataFrame([(law, number)], "law string, n string")
    assert df.select(reject_reason(F.col("law"), F.col("n")).alias("r")).first().r == reason


def test_unknown_law_is_an_error():
    with pytest.raises(ValueError):
        check_law("94")
    assert check_law(None) is None


SAMPLES = {
    "utf8.txt": ("сосна\nелки".encode(), ["сосна", "елки"]),
    "one.txt": ("лекарство".encode(), ["лекарство"]),
    "code.txt": (b"10.86.10.191", ["10.86.10.191"]),
    "cp1251.txt": ("сосна\r\n\r\n  Ёлки №5 \r\nелки".encode("cp1251"), ["сосна", "Ёлки №5", "елки"]),
    "bom.txt": ("﻿сосна\rелки\r".encode(), ["сосна", "елки"]),
    "utf16.txt": ("сосна\nелки".encode("utf-16"), ["сосна", "елки"]),
    "empty.txt": (b"", []),
    "blank.txt": (b"\n \n\t\n", []),
}


def test_lists_in_any_charset(spark, tmp_path):
    for name, (content, _) in SAMPLES.items():
        (tmp_path / name).write_bytes(content)
    (tmp_path / "_hidden.txt").write_bytes(b"no")
    got: dict = {}
    for row in sorted(read_terms(scan_lists(spark, str(tmp_path))).collect(), key=lambda r: r.pos):
        got.setdefault(row.list_id, []).append(row.term)
    assert got == {name: terms for name, (_, terms) in SAMPLES.items() if terms}


def test_line_numbers_count_blank_lines(spark, tmp_path):
    (tmp_path / "l").write_bytes(b"a\r\n\r\nb\rc\nd")
    terms = read_terms(scan_lists(spark, str(tmp_path))).select("pos", "term")
    assert rows(terms) == [(1, "a"), (3, "b"), (4, "c"), (5, "d")]


def test_every_cyrillic_byte_is_decoded(spark):
    content = bytes(b for b in range(32, 256) if b != 0x98)  # 0x98 has no character
    assert one(spark, bytearray(content), text.decode_text, "binary") == content.decode("cp1251")
    word = "Съешь ещё этих мягких французских булок №1"
    assert one(spark, word, lambda c: text.decode_text(text.encode_cyrillic(c))) == word


def test_list_id_is_folder_or_file_name(spark):
    name = lambda path: one(spark, path, list_id_from_path)
    assert name("file:/in/kw one.txt") == "kw one.txt"
    assert name("file:/out/list_id=a/part-0.txt") == "a"


def test_single_and_landed_lists(spark):
    assert rows(single_term_list(spark, "x", "сосна")) == [("x", 1, "сосна")]
    raw = spark.createDataFrame([("a", 1, " t "), ("a", 2, " ")], "list_id string, pos int, raw_term string")
    assert rows(strip_terms(raw)) == [("a", 1, "t")]
