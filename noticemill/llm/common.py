"""What the operators share: words in SQL and in bytes, row keys, the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticemill.session import configure, shared_dir

# White space of the word contracts: space and U+0009 to U+000D.
WHITE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# What separates words that are letters, digits and everything beyond ASCII. Capital
# letters separate too, so a text is put into small letters first.
NOT_IN_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{folder}/{name}.parquet")


def work_path(spark: SparkSession, name: str) -> str:
    """A path in the folder that driver and executors share, used by nothing else."""
    return f"{shared_dir(spark)}/noticemill-llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read back from there."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_letters(text: Column) -> Column:
    """A-Z in small letters, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def white_words(text: Column) -> Column:
    """Array of the maximal runs of characters that are not white space."""
    trimmed = F.btrim(text, F.lit(WHITE))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))


def plain_words(text: Column) -> Column:
    """Array of words of letters, digits and characters beyond ASCII, A-Z in small letters."""
    spaced = F.btrim(F.regexp_replace(small_letters(text), NOT_IN_WORD, " "))
    return F.when(F.length(spaced) > 0, F.split(spaced, " ")).otherwise(F.array().cast("array<string>"))
