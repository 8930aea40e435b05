"""One query per operator, over whole tables, with SQL where SQL can say the same."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticemill.llm import automaton, bpe, contamination, conversations, jaccard, licenses, lm, merkle, packing, quality, records, suffixes, urls
from noticemill.llm.common import table, work_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TOKENIZER_FILE = "byte_bpe_50k.json"
RANKS_FILE = "byte_bpe_50k.tiktoken"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str = TOKENIZER_FILE) -> str:
    """Where a tokenizer file is: in $NOTICEMILL_TOKENIZERS, or in the installed package."""
    folder = os.environ.get("NOTICEMILL_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_prefix_tree_join(spark: SparkSession, folder: str) -> DataFrame:
    rule = jaccard.Similarity(words=4, percent=85)
    found = jaccard.linked_documents(table(spark, folder, "documents"), rule)
    return found.select("doc_id", F.col("n_ngrams").alias("n_shingles"), F.col("first_doc").alias("component_id"), "n_links")


@query
def op2_url_trees(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query
def op3_token_records(spark: SparkSession, folder: str) -> DataFrame:
    path = work_path(spark, "records")
    records.write_records(table(spark, folder, "documents"), path, tokenizer_path())
    return records.read_records(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents")).drop("found")


@query
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


@query
def op6_suffix_automata(spark: SparkSession, folder: str) -> DataFrame:
    found = automaton.dedup(table(spark, folder, "documents"))
    return found.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_bloom_lm(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score(table(spark, folder, "documents")).drop("train_words")


@query
def op8_minimum_bin_slack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path()).drop("ids")


@query
def op9_rule_ledger(spark: SparkSession, folder: str) -> DataFrame:
    ledger = quality.judged(quality.rule_ledger(table(spark, folder, "documents")))
    base = F.col("failed").bitwiseAND(F.lit(quality.mask_of(quality.BASE_RULES)).cast("bigint")) != 0
    return ledger.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept"
    )


@query
def op10_sparse_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of 50 words and more that also stand at an earlier place, one row for each."""
    found = suffixes.repeated_passages(table(spark, folder, "documents"))
    spans = found.select("row.doc_id", F.inline("spans"))
    return spans.select(
        "doc_id",
        F.col("first").cast("bigint").alias("first_word"),
        F.col("n").cast("bigint").alias("n_words"),
        "of_doc_id",
        F.col("of_first").cast("bigint").alias("of_first_word"),
    )


@query
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    found = merkle.manifest(table(spark, folder, "documents"))
    digests = [merkle.as_hex(F.col(name)).alias(name) for name in ("leaf", "subroot", "root", "folded_root")]
    proof = F.sha2(merkle.as_hex(F.col("proof")), 256).alias("proof_sha256")
    return found.select("doc_id", *digests[:3], proof, digests[3], "verified")


@query
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair(conversations.damaged(table(spark, folder, "conversations")))[0]


@query
def op13_recursive_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    found = bpe.encode(table(spark, folder, "documents"), tokenizer_path(RANKS_FILE), public_tokenizers.PATTERN)
    ids, decoded = F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    return found.select("doc_id", "n_tokens", ids, decoded)


def queries() -> dict[str, Query]:
    return dict(QUERIES)
