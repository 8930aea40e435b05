"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but
the last return the columns of `docs`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticemill.llm import automaton, contamination, jaccard, packing, quality
from noticemill.llm.common import table, written
from noticemill.llm.queries import tokenizer_path
from noticemill.session import configure


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule of the current policy."""
    configure(spark)
    return quality.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document (smallest doc_id) of each group linked at 0.8 over five-word shingles."""
    configure(spark)
    return jaccard.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of 13-word windows that a document with a smaller id has.

    A text that loses words is its remaining words joined by one space, with `n_chars` set
    anew where there is such a column; one that loses all is left out; others stay as they are.
    """
    configure(spark)
    found = automaton.dedup(docs).filter("n_removed = 0 or n_removed < n_words")
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text")).alias("text")
    cut = found.select("row.*", text, (F.col("n_removed") > 0).alias("_cut"))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", F.when(F.col("_cut"), length).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def benchmark_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with items of the benchmark."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents in sequences of at most 1024."""
    configure(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_texts", benchmark_texts),
    ("packed_sequences", packed_sequences),
]

# Similarity groups, suffix automata and packing have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written to the shared folder before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
