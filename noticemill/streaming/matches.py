"""Keyword runs over notices and texts that land at different times."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from noticemill.operators.filters import law_filter, published_window, valid_numbers
from noticemill.operators.keywords import clauses_of, found_terms, lists_satisfied
from noticemill.operators.registry import new_numbers
from noticemill.session import stage
from noticemill.streaming.intake import MAX_FILE_AGE


@dataclass(frozen=True)
class Meeting:
    """When a notice and a text belong together, and how late either may be.

    Both sides carry `landed_at`. They meet if it differs by at most `within`; a row may be
    `lateness` behind the newest of its side. State older than both together is dropped.
    """

    within: str = "7 days"
    lateness: str = "1 day"


def _sides(notices: DataFrame, texts: DataFrame, clauses: DataFrame, law: str, window: tuple[date, int] | None):
    rows = valid_numbers(law_filter(notices, law))
    if window:
        rows = published_window(rows, *window)
    left = rows.select("notice_id", "law", "notice_num", F.col("landed_at").alias("_noticed_at"))
    # only the terms found go on from here, never a text
    right = found_terms(texts.dropna(subset=["doc_id", "text"]), clauses.select("term"), ["doc_id", "landed_at"])
    return left, right


def _meet(left: DataFrame, right: DataFrame, meeting: Meeting) -> DataFrame:
    apart = F.expr(f"interval {meeting.within}")
    near = F.col("landed_at").between(F.col("_noticed_at") - apart, F.col("_noticed_at") + apart)
    return left.join(right, (F.col("notice_id") == F.col("doc_id")) & near)


def stream_keyword_run(
    spark: SparkSession,
    notices: str,
    notice_schema: StructType | str,
    texts: str,
    lists: DataFrame,
    registry: Callable[[], DataFrame],
    out: str,
    checkpoint: str,
    law: str = "44",
    policy: str = "any",
    window: tuple[date, int] | None = None,
    meeting: Meeting = Meeting(),
    files_per_batch: int = 1000,
    max_file_age: str = MAX_FILE_AGE,
) -> StreamingQuery:
    """(list_id, notice_num) of new notices whose texts match a list, as both land.

    `notices` has (notice_id, law, notice_num, published_on, landed_at), `texts` the texts
    and attachments (doc_id = notice id, text, landed_at), in any order and any number per
    notice. The two streams are joined by id within `meeting`; what met is appended to
    out/met/batch_id=…. Under `all` the terms of a list may come from different texts and
    batches: each batch looks at everything that met so far for its own notices. A list
    reports a number once, in out/lines/batch_id=…, if the registry, asked anew for each
    batch, does not know it. A batch that is repeated overwrites its own folders. Texts too
    late to meet their notice are listed by `missed_texts`.
    """
    clauses = stage(clauses_of(lists, policy), "clauses")
    text_schema = "doc_id bigint, text string, landed_at timestamp"

    def landed(path: str, schema: StructType | str) -> DataFrame:
        source = spark.readStream.format("parquet").schema(schema).option("maxFilesPerTrigger", files_per_batch)
        return source.option("maxFileAge", max_file_age).load(path).withWatermark("landed_at", meeting.lateness)

    left, right = _sides(landed(notices, notice_schema), landed(texts, text_schema), clauses, law, window)
    met = _meet(left, right, meeting).select("notice_id", "law", "notice_num", "doc_id", "landed_at", "term")
    met_schema = "notice_id bigint, law string, notice_num string, doc_id bigint, landed_at timestamp, term string, batch_id bigint"
    line_schema = "list_id string, notice_num string, batch_id bigint"

    def until(last: int, folder: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{out}/{folder}").filter(F.col("batch_id") <= last)

    def report(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/met/batch_id={batch_id}")
        all_met = until(batch_id, "met", met_schema)
        ids = all_met.filter(F.col("batch_id") == batch_id).select("notice_id").distinct()
        of_batch = stage(all_met.join(ids, "notice_id", "left_semi").select("notice_id", "law", "notice_num", "term").distinct(), "met")
        lists_of = lists_satisfied(of_batch, clauses, "notice_id")
        new = new_numbers(of_batch, registry(), law)
        numbers = of_batch.select("notice_id", "law", "notice_num").distinct().join(new, ["law", "notice_num"], "left_semi")
        lines = numbers.join(lists_of, "notice_id").select("list_id", "notice_num").distinct()
        if batch_id > 0:
            reported = until(batch_id - 1, "lines", line_schema)
            lines = lines.join(reported, ["list_id", "notice_num"], "left_anti")
        lines.write.mode("overwrite").parquet(f"{out}/lines/batch_id={batch_id}")

    return (
        met.writeStream.foreachBatch(report)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def missed_texts(
    notices: DataFrame,
    texts: DataFrame,
    lists: DataFrame,
    out: str,
    law: str = "44",
    window: tuple[date, int] | None = None,
    meeting: Meeting = Meeting(),
) -> DataFrame:
    """Distinct (doc_id, landed_at) that belong to a notice and have a term, but came too late to meet it."""
    left, right = _sides(notices, texts, clauses_of(lists, "any"), law, window)
    due = _meet(left, right, meeting).select("doc_id", "landed_at").distinct()
    met = notices.sparkSession.read.schema("doc_id bigint, landed_at timestamp").parquet(f"{out}/met")
    return due.join(met.distinct(), ["doc_id", "landed_at"], "left_anti")
