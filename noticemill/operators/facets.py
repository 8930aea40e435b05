"""Match wanted facet options to the offered ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticemill.operators.filters import contains_ignoring_case
from noticemill.operators.skew import key_counts, skew_join
from noticemill.session import stage

# Characters of a gram; a shorter term is looked up as a whole. Shorter grams have more labels
# and are chosen by more pairs, which are compared with each other; there are more of longer ones.
GRAM = 5


def facet_resolve(offered: DataFrame, wanted: Sequence[tuple[str, str]]) -> DataFrame:
    """How many offered (facet, option) rows each wanted (facet, option) finds.

    A facet title has to contain the wanted name and an option label the wanted option,
    ignoring case. Wanted pairs are arguments of a run, so they are plain predicates over
    one pass of `offered`; a pair that found nothing is reported with 0.
    """
    spark = offered.sparkSession
    schema = "facet string, option string"
    pairs = spark.createDataFrame(list(dict.fromkeys(wanted)), schema)
    hits = F.array(
        *[
            F.when(
                contains_ignoring_case(F.col("facet"), facet) & contains_ignoring_case(F.col("option"), option),
                F.struct(F.lit(facet).alias("facet"), F.lit(option).alias("option")),
            )
            for facet, option in dict.fromkeys(wanted)
        ]
    )
    matched = offered.select(F.inline(F.array_compact(hits))).groupBy("facet", "option").agg(F.count(F.lit(1)).alias("_n"))
    return pairs.join(matched, ["facet", "option"], "left").select(
        "facet", "option", F.coalesce("_n", F.lit(0)).cast("bigint").alias("n_matched")
    )


def _substrings(text: Column, size: int) -> Column:
    """All substrings of a size as an array."""
    places = F.sequence(F.lit(1), F.length(text) - size + 1)
    return F.when(F.length(text) >= size, F.transform(places, lambda at: F.substring(text, at, F.lit(size)))).otherwise(
        F.array().cast("array<string>")
    )


def _on_side(side: str, grams: Column) -> Column:
    return F.transform(grams, lambda gram: F.struct(F.lit(side).alias("side"), gram.alias("gram")))


def _sided(facet: Column, option: Column) -> Column:
    """The grams of both texts as one array of (side, gram), each once.

    Each side's strings are made distinct by themselves: structs would be compared pair by pair.
    """
    return F.concat(_on_side("f", F.array_distinct(facet)), _on_side("o", F.array_distinct(option)))


def _offered_grams(text: Column, sizes: list[int]) -> Column:
    """What wanted terms with grams of these sizes may be looked up by; the empty term is in every text."""
    of_size = [_substrings(text, size) if size else F.array(F.lit("")) for size in sizes]
    return F.concat(F.array().cast("array<string>"), *of_size)


def _wanted_grams(term: Column) -> Column:
    return F.when(F.length(term) < GRAM, F.array(term)).otherwise(_substrings(term, GRAM))


def facet_resolve_joined(offered: DataFrame, wanted: DataFrame) -> DataFrame:
    """The same between two tables, for any number of wanted (facet, option) rows.

    Offered labels, each once with its count, are listed under their grams of the sizes that
    wanted terms have, at most `GRAM` characters, as far as a wanted pair has that gram. A pair takes the rarest of its grams
    on either side, is looked up among the labels under it alone, and both texts are then
    compared in full. A pair with a gram that no label has needs no look-up. Labels under a
    frequent gram are spread over the tasks; the pairs that chose one gram come to them as
    one row. A null on either side matches nothing; a wanted pair given twice is reported once.
    """
    pairs = stage(wanted.select("facet", "option").distinct(), "wanted-facets")
    complete = pairs.filter(F.col("facet").isNotNull() & F.col("option").isNotNull())
    terms = _sided(_wanted_grams(F.lower("facet")), _wanted_grams(F.lower("option")))
    looked_up = complete.select("facet", "option", F.inline(terms))
    labels = offered.groupBy(F.lower("facet").alias("_facet"), F.lower("option").alias("_option")).agg(F.count(F.lit(1)).alias("_n"))
    labels = labels.filter(F.col("_facet").isNotNull() & F.col("_option").isNotNull())
    # a label becomes some hundred rows: few bytes of labels are work for all tasks
    splits = int(offered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    labels = labels.repartition(splits, F.xxhash64("_facet", "_option"))
    made = looked_up.select("side", F.length("gram").alias("size")).distinct().collect()  # at most GRAM + 1 a side
    facet_sizes, option_sizes = (sorted(row["size"] for row in made if row["side"] == side) for side in "fo")
    grams = _sided(_offered_grams(F.col("_facet"), facet_sizes), _offered_grams(F.col("_option"), option_sizes))
    listed = labels.select("*", F.inline(grams))
    by_gram = ["side", "gram"]
    postings = stage(listed.join(looked_up.select(*by_gram).distinct(), by_gram, "left_semi"), "facet-grams")
    counts = key_counts(postings, by_gram)
    sizes = looked_up.join(counts, by_gram, "left").withColumn("_rows", F.coalesce("_rows", F.lit(0)))
    rarest = sizes.groupBy("facet", "option").agg(F.min(F.struct("_rows", *by_gram)).alias("_rarest"))
    pair = F.struct("facet", "option", F.lower("facet").alias("in_facet"), F.lower("option").alias("in_option"))
    chosen = rarest.filter("_rarest._rows > 0").select("_rarest.side", "_rarest.gram", pair.alias("_pair"))
    chosen = stage(chosen.groupBy(*by_gram).agg(F.collect_list("_pair").alias("_pairs")), "chosen-grams")
    met = skew_join(postings, chosen, by_gram, "inner", ["_facet", "_option"], counts)
    contained = F.filter(
        "_pairs", lambda p: F.contains(F.col("_option"), p["in_option"]) & F.contains(F.col("_facet"), p["in_facet"])
    )
    matched = met.select("_n", F.inline(contained)).groupBy("facet", "option").agg(F.sum("_n").alias("_matched"))
    # `matched` holds no null, so null pairs find nothing and are kept by the outer join
    return pairs.join(matched, ["facet", "option"], "left").select(
        "facet", "option", F.coalesce("_matched", F.lit(0)).cast("bigint").alias("n_matched")
    )
