"""Search lists: one file per list, one term per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticemill.functions import text

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def list_id_from_path(path: Column) -> Column:
    """A list is named by its `list_id=` folder if it has one, else by its file name."""
    folder = F.regexp_extract(path, "/list_id=([^/]+)/", 1)
    return F.coalesce(text.none_if_empty(folder), F.regexp_extract(path, "([^/]+)$", 1))


def scan_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Every list file below `folder` as (list_id, content).

    A list is read as one row, so it has to fit one; lists are written by people. Files
    starting with `.` or `_` are not lists.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(list_id_from_path(F.col("path")).alias("list_id"), "content")


def read_terms(files: DataFrame) -> DataFrame:
    """(list_id, content) to (list_id, pos, term): one row per non-blank line, stripped.

    `pos` is the line number from 1. Blank lines are dropped: as a keyword a blank would
    match every notice.
    """
    numbered = files.select("list_id", F.posexplode(text.lines(text.decode_text(F.col("content")))).alias("line", "raw"))
    terms = numbered.select("list_id", (F.col("line") + 1).alias("pos"), text.strip(F.col("raw")).alias("term"))
    return terms.filter(F.col("term") != "")


def single_term_list(spark: SparkSession, list_id: str, term: str) -> DataFrame:
    """A bare string is a list of that one term."""
    return spark.createDataFrame([(list_id, 1, term)], "list_id string, pos int, term string")


def strip_terms(lists: DataFrame, raw: str = "raw_term") -> DataFrame:
    """The same for lists landed as a table of raw lines (list_id, pos, raw_term)."""
    return lists.select("list_id", "pos", text.strip(F.col(raw)).alias("term")).filter(F.col("term") != "")
