"""Quality rules kept as a ledger of failure bits, judged by versioned policies.

Every rule is evaluated once per document. `rule_ledger` stores the measurements and one
integer whose bit i says that rule i failed; policies are masks over these bits, so a new
policy, or the question what a rule costs, needs no second look at the texts. Everything is
a column expression on one scan: no shuffle, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticemill.llm.common import white_words

SYMBOLS = "[#*$%&|<>]"
HAS_WORD = r"[^\x20\x09-\x0D]"

# Bit i of a ledger is RULES[i]; a rule is a predicate over the measurements that says "failed".
# New rules go to the end, so that old ledgers keep their meaning.
RULES: tuple[tuple[str, str], ...] = (
    ("too_few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "5 * n_symbols > word_chars"),
    ("repeated_lines", "2 * n_dup_lines > n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
)
MEASUREMENTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
BASE_RULES = ("too_few_words", "repeated_words")


def mask_of(names: tuple[str, ...]) -> int:
    """The bits of the named rules."""
    bits = {name: 1 << i for i, (name, _) in enumerate(RULES)}
    return sum(bits[name] for name in set(names))


@dataclass(frozen=True)
class Policy:
    """A version of what counts: a document is rejected if one of these rules failed."""

    version: int
    rules: tuple[str, ...] = field(default=tuple(name for name, _ in RULES))

    @property
    def mask(self) -> int:
        return mask_of(self.rules)


POLICIES = {1: Policy(1, BASE_RULES), 2: Policy(2)}
CURRENT = POLICIES[2]


def _repeat_words(df: DataFrame) -> DataFrame:
    """Add `n_repeat_words` to rows with `_words`: words in 3-word windows that occur again.

    The hashes of all windows are sorted as plain numbers; only texts in which two are equal
    sort (hash, place) pairs to find the places. All steps are n log n in the text's length.
    """
    df = df.withColumn(
        "_hashes",
        F.when(
            F.size("_words") >= 3,
            F.transform(
                F.slice("_words", F.lit(1), F.size("_words") - 2),
                lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)),
            ),
        ),
    )
    df = df.withColumn("_sorted", F.sort_array("_hashes"))
    again = F.exists(
        F.sequence(F.lit(1), F.size("_sorted") - 1), lambda i: F.get("_sorted", i) == F.get("_sorted", i - 1)
    )
    df = df.withColumn("_again", (F.size("_sorted") > 1) & F.coalesce(again, F.lit(False)))
    places = F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_places", F.when(F.col("_again"), places))
    # `get` gives null outside the array, so the first and last place compare with one side
    shared = F.filter(
        F.sequence(F.lit(0), F.size("_places") - 1),
        lambda k: F.coalesce(F.get("_places", k)["h"] == F.get("_places", k - 1)["h"], F.lit(False))
        | F.coalesce(F.get("_places", k)["h"] == F.get("_places", k + 1)["h"], F.lit(False)),
    )
    starts = F.sort_array(F.transform(shared, lambda k: F.get("_places", k)["i"]))
    df = df.withColumn("_starts", F.when(F.col("_again"), starts))
    covered = F.aggregate(
        F.transform("_starts", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_starts", k + 1) - p, F.lit(3)))),
        F.lit(0).cast("bigint"),
        lambda total, n: total + n,
    )
    return df.withColumn("n_repeat_words", F.when(F.col("_again"), covered).otherwise(F.lit(0).cast("bigint")))


def _measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The measurements of each row, and its columns `keep` in the struct `_row`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select(F.struct(*keep).alias("_row"), text.alias("_text"))
    df = df.withColumn("_words", white_words(F.col("_text")))
    df = df.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda line: line.rlike(HAS_WORD)))
    df = df.select(
        "_row",
        "_words",
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
    )
    df = _repeat_words(df)
    return df.select("_row", *MEASUREMENTS)


def measurements(docs: DataFrame) -> DataFrame:
    """doc_id of each row, with the measurements of its whole text.

    n_words, word_chars (code points in words), n_symbols, n_lines (lines with a word),
    n_dup_lines (of those, equal to an earlier one) and n_repeat_words, all long. A null or
    empty text has zero of everything. Rows are never merged or dropped, null and repeated
    doc_ids stay; other columns of `docs` are ignored, whatever their names.
    """
    return _measured(docs, ["doc_id"]).select("_row.*", *MEASUREMENTS)


def failures() -> Column:
    """The failure bits over the columns of `measurements`."""
    bits = F.lit(0).cast("bigint")
    for i, (_, failed) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(failed), F.lit(1 << i)).otherwise(0).cast("bigint"))
    return bits


def rule_ledger(docs: DataFrame) -> DataFrame:
    """`measurements` and `failed`, the bits of the rules that each document fails."""
    return measurements(docs).withColumn("failed", failures())


def judged(ledger: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """The ledger with `kept` under a policy and its `policy_version`."""
    passed = F.col("failed").bitwiseAND(F.lit(policy.mask).cast("bigint")) == 0
    return ledger.withColumn("kept", passed).withColumn("policy_version", F.lit(policy.version))


def ablations(ledger: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """For each rule of a policy: documents that fail it, and that only it rejects.

    rule, n_failed, n_only (kept if the rule were dropped), n_rejected (by the whole
    policy). One pass over the ledger's bits, combined in the map tasks.
    """
    bits = F.col("failed").bitwiseAND(F.lit(policy.mask).cast("bigint"))
    sums = [F.count(F.when(bits != 0, 1)).alias("n_rejected")]
    names = [name for name, _ in RULES if name in policy.rules]
    for name in names:
        bit = mask_of((name,))
        sums.append(F.count(F.when(bits.bitwiseAND(F.lit(bit).cast("bigint")) != 0, 1)).alias(f"f_{name}"))
        sums.append(F.count(F.when(bits == bit, 1)).alias(f"o_{name}"))
    rows = F.array(
        *(
            F.struct(F.lit(n).alias("rule"), F.col(f"f_{n}").alias("n_failed"), F.col(f"o_{n}").alias("n_only"), "n_rejected")
            for n in names
        )
    )
    return ledger.agg(*sums).select(F.inline(rows))


def accepted(docs: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """The rows of `docs` that the policy keeps, with the columns they came with."""
    ledger = judged(_measured(docs, docs.columns).withColumn("failed", failures()), policy).select("_row", "kept")
    # a filter is not moved below a projection that is not deterministic; moved down, it would
    # take the place of the columns it reads and evaluate each of them many times
    return ledger.withColumn("_here", F.spark_partition_id()).filter("kept and _here >= 0").select("_row.*")
