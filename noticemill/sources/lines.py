"""Output lines as text files, one folder per source, list and run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticemill.functions import text

RUN_COLUMNS = ("source", "list_id", "run_ts")
RUN_TS_FORMAT = "%d_%m_%Y_%H_%M_%S"


def write_lines(lines: DataFrame, path: str, run_at: datetime) -> None:
    """Append `line` below list_id=…/run_ts=…; a list without lines leaves no folder.

    Rebalancing puts a list into as few files as its size allows and splits a large one.
    """
    run = lines.withColumn("run_ts", F.lit(run_at.strftime(RUN_TS_FORMAT)))
    folders = [c for c in RUN_COLUMNS if c in run.columns]
    (
        run.select(*folders, "line")
        .hint("rebalance", *folders)
        .write.mode("append")
        .partitionBy(*folders)
        .text(path)
    )


def read_lines(spark: SparkSession, path: str, with_source: bool = False) -> DataFrame:
    folders = [c for c in RUN_COLUMNS if with_source or c != "source"]
    schema = ", ".join(["line string", *(f"{c} string" for c in folders)])
    return spark.read.schema(schema).text(path)


def distinct_lines(lines: DataFrame) -> DataFrame:
    """Lines stripped, each once per list (and source)."""
    folders = [c for c in ("source", "list_id") if c in lines.columns]
    return lines.select(*folders, text.strip(F.col("line")).alias("line")).distinct()


def compact_lines(spark: SparkSession, path: str, new_path: str, run_at: datetime, with_source: bool = False) -> None:
    """Rewrite an output folder without repeated lines into a new folder."""
    write_lines(distinct_lines(read_lines(spark, path, with_source)), new_path, run_at)
