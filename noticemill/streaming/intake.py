"""Drop-folder intake of search lists."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from noticemill.sources.lists import BINARY_FILE_SCHEMA, list_id_from_path, read_terms

# How much older than the newest file seen a file may be and still be read. Spark remembers
# the names of files of that age on the driver, so a folder that is never emptied and takes
# in very many files wants a shorter age.
MAX_FILE_AGE = "3650d"
# How Spark writes ages; a bare number is in milliseconds.
AGE_UNITS = {"": "milliseconds", "us": "microseconds", "ms": "milliseconds", "s": "seconds", "m": "minutes", "min": "minutes", "h": "hours", "d": "days"}


def stream_lists(
    spark: SparkSession,
    drop_folder: str,
    archive: str,
    out: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    max_file_age: str = MAX_FILE_AGE,
) -> StreamingQuery:
    """Append the terms of list files not seen before to Parquet, then stop.

    Files that a finished batch has read move to `archive`, one batch later; the last ones
    stay until the next run and are not read again. Files more than `max_file_age` older
    than the newest one seen are not read; `overlooked_files` lists them.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", max_file_age)
        .option("cleanSource", "archive")
        .option("sourceArchiveDir", archive)
        .load(drop_folder)
    )
    terms = read_terms(files.select(list_id_from_path(F.col("path")).alias("list_id"), "content"))
    return (
        terms.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(out)
    )


def overlooked_files(spark: SparkSession, folder: str, max_file_age: str = MAX_FILE_AGE) -> DataFrame:
    """(path, modificationTime) of the files in a folder that are too old for a stream to read."""
    files = (
        spark.read.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "modificationTime")
    )
    newest = files.agg(F.max("modificationTime").alias("t")).scalar()
    number, unit = re.fullmatch(r"(\d+)\s*([a-z]*)", max_file_age.strip().lower()).groups()
    age = F.expr(f"interval {number} {AGE_UNITS[unit]}")
    return files.filter(F.col("modificationTime") < newest - age)
