"""URL rules and a gradient-boosted classifier on lexical features for the rest.

Host rules decide where they fit. For other URLs a model is fitted on labelled ones: boosted
trees over length, depth, digit ratio, entropy, parameter counts and how often URLs with
the same host ending were blocked. Column expressions and the JVM's tree learner only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticemill.llm.common import small_letters, written

# Labelled URLs the model is fitted on, the smallest by a hash of the URL; documented bound.
TRAINING_ROWS = 20_000
TREES, DEPTH, STEP = 10, 4, 0.3
# Weight, in URLs, of the overall rate in the rate of one ending.
PRIOR = 20.0
FEATURES = (
    "length",
    "host_length",
    "path_length",
    "depth",
    "labels",
    "digit_ratio",
    "entropy",
    "n_params",
    "n_hyphens",
    "longest_label",
    "suffix_rate",
    "suffix_log_count",
)


@dataclass(frozen=True)
class Rule:
    """`verdict` for a host and its subdomains, where the path starts with `path`."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in small letters and path; both empty for null or a URL without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = small_letters(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def fitting_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct (name, verdict) of the longest rule that fits, null if none; a block wins a tie."""
    ordered = sorted(set(rules), key=lambda r: (-len(r.name), r.verdict != "block", r.name))
    chosen = F.lit(None).cast("struct<name: string, verdict: string>")
    for rule in reversed(ordered):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        chosen = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def with_parts(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, url (null: empty), host, path, rule and its verdict as `rule_verdict`."""
    host, path = host_and_path(F.col("url"))
    df = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    df = df.withColumn("_rule", fitting_rule(F.col("host"), F.col("path"), rules))
    return df.select("*", F.col("_rule.name").alias("rule"), F.col("_rule.verdict").alias("rule_verdict")).drop("_rule")


def _count_of(text: str, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(F.col(text), chars, ""))


def lexical(df: DataFrame) -> DataFrame:
    """Add the features of `url`, `host` and `path`, and `suffix`, the last part of the host."""
    labels = F.split("host", r"\.")
    n = F.greatest(F.length("url"), F.lit(1))
    share = lambda c: (F.length("url") - F.length(F.replace(F.col("url"), c, F.lit("")))) / n
    chars = F.filter(F.array_distinct(F.split("url", "")), lambda c: c != "")
    entropy = F.aggregate(F.transform(chars, lambda c: -share(c) * F.log2(share(c))), F.lit(0.0), lambda a, b: a + b)
    query = F.regexp_extract("url", r"\?([^#]*)", 1)
    return df.select(
        "*",
        F.element_at(labels, -1).alias("suffix"),
        F.length("url").cast("double").alias("length"),
        F.length("host").cast("double").alias("host_length"),
        F.length("path").cast("double").alias("path_length"),
        _count_of("path", "/").cast("double").alias("depth"),
        F.size(labels).cast("double").alias("labels"),
        (_count_of("url", "0123456789") / n).alias("digit_ratio"),
        entropy.alias("entropy"),
        F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))).cast("double").alias("n_params"),
        _count_of("host", "-").cast("double").alias("n_hyphens"),
        F.array_max(F.transform(labels, lambda x: F.length(x))).cast("double").alias("longest_label"),
    )


def _with_suffix_rates(df: DataFrame, rates: DataFrame, overall: float) -> DataFrame:
    joined = df.join(rates, "suffix", "left")
    return joined.withColumns(
        {
            "suffix_rate": F.coalesce("suffix_rate", F.lit(overall)),
            "suffix_log_count": F.coalesce("suffix_log_count", F.lit(0.0)),
        }
    )


class UrlModel:
    """Boosted trees and the suffix statistics they were fitted with."""

    def __init__(self, rates: DataFrame, overall: float, trees, constant: str | None):
        self.rates, self.overall, self.trees, self.constant = rates, overall, trees, constant

    def verdicts(self, urls: DataFrame) -> DataFrame:
        """`urls` (with url, host, path) and `model_verdict`, allow or block."""
        if self.trees is None:
            return urls.withColumn("model_verdict", F.lit(self.constant))
        kept = urls.columns
        rows = _with_suffix_rates(lexical(urls.select(F.struct(*kept).alias("_row"), "url", "host", "path")), self.rates, self.overall)
        rows = VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(rows)
        scored = self.trees.transform(rows)
        verdict = F.when(F.col("_blocked") > 0.5, "block").otherwise("allow")
        return scored.select("_row.*", verdict.alias("model_verdict"))


def fit(labelled: DataFrame, max_rows: int = TRAINING_ROWS) -> UrlModel:
    """Fit on rows (url, host, path, label), label 1 for block, at most `max_rows` of them.

    The suffix statistics count all labelled rows. With labels of one kind only the model
    is that verdict, without any it is allow.
    """
    rows = lexical(labelled.select("url", "host", "path", F.col("label").cast("double").alias("label")))
    stats = rows.groupBy("suffix").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("blocked"))
    stats = written(stats, "url-suffixes")
    total = stats.agg(F.sum("n").alias("n"), F.sum("blocked").alias("blocked")).first()
    n, blocked = total.n or 0, total.blocked or 0.0
    overall = blocked / n if n else 0.0
    rate = (F.col("blocked") + PRIOR * overall) / (F.col("n") + PRIOR)
    rates = stats.select("suffix", rate.alias("suffix_rate"), F.log1p("n").alias("suffix_log_count"))
    if not n or blocked in (0, n):
        return UrlModel(rates, overall, None, "block" if n and blocked else "allow")
    chosen = rows.orderBy(F.xxhash64("url"), "url", "label").limit(max_rows)
    sample = written(_with_suffix_rates(chosen, rates, overall).select("label", *FEATURES), "url-sample")
    sample = VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(sample)
    learner = GBTClassifier(
        featuresCol="_features",
        labelCol="label",
        predictionCol="_blocked",
        maxIter=TREES,
        maxDepth=DEPTH,
        stepSize=STEP,
        seed=7,
    )
    return UrlModel(rates, overall, learner.fit(sample), None)


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, labelled: DataFrame | None = None) -> DataFrame:
    """Each row's page_id, url, host, path, rule (null if none fits), verdict and by (rule or model).

    The model learns from `labelled` (url, label: 1 block, 0 allow), or from the URLs that
    rules decide. A null URL, or one without `://`, has no host and no path, fits no rule
    and is left to the model. Repeated rows stay; other columns are ignored.
    """
    parts = with_parts(pages, rules)
    if labelled is None:
        known = parts.filter(F.col("rule").isNotNull())
        known = known.select("url", "host", "path", (F.col("rule_verdict") == "block").cast("int").alias("label"))
    else:
        host, path = host_and_path(F.col("url"))
        known = labelled.filter(F.col("url").isNotNull() & F.col("label").isNotNull())
        known = known.select("url", host.alias("host"), path.alias("path"), "label")
    scored = fit(known).verdicts(parts)
    return scored.select(
        "page_id",
        "url",
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", "model_verdict").alias("verdict"),
        F.when(F.col("rule").isNotNull(), "rule").otherwise("model").alias("by"),
    )
