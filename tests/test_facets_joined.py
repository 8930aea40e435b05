"""Wanted facets as a table, against plain containment of all pairs."""

import random
import time

from pyspark.sql import functions as F

from noticemill.operators.facets import facet_resolve_joined
from tests.conftest import plan_of, rows

SCHEMA = "facet string, option string"


def brute_force(offered, wanted):
    def n(facet, option):
        if facet is None or option is None:
            return 0
        return sum(f is not None and o is not None and facet.lower() in f.lower() and option.lower() in o.lower() for f, o in offered)

    return sorted(((f, o, n(f, o)) for f, o in set(wanted)), key=repr)


def test_pairs_of_any_length(spark):
    rng = random.Random(3)

    def word(most):
        return "".join(rng.choice("abÄб %_") for _ in range(rng.randint(0, most)))

    offered = [(word(6), word(9)) for _ in range(200)] + [("Правило", "44-ФЗ")] * 50 + [(None, "ab"), ("ab", None), (None, None), ("", "")]
    wanted = [(word(3), word(4)) for _ in range(300)] + [("правил", "-фз"), ("Правил", "-фз"), ("правил", "фз-"), ("", "")]
    wanted += [(None, "a"), ("a", None), (None, None)] + [("правил", "-фз")] * 3
    got = facet_resolve_joined(spark.createDataFrame(offered, SCHEMA), spark.createDataFrame(wanted, SCHEMA))
    assert rows(got) == brute_force(offered, wanted)


def test_empty_tables_and_further_columns(spark):
    none = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame([("Ab", "cd", "x", 1, "y")], f"{SCHEMA}, side string, _n int, gram string")
    assert rows(facet_resolve_joined(none, one)) == [("Ab", "cd", 0)]
    assert rows(facet_resolve_joined(one, none)) == []
    assert rows(facet_resolve_joined(one, one)) == [("Ab", "cd", 1)]


def test_many_pairs_without_a_pairwise_join(plain_joins):
    spark = plain_joins
    offered = spark.range(20_000).select(F.lit("Region").alias("facet"), F.concat(F.lit("option no "), F.lpad("id", 6, "0")).alias("option"))
    wanted = spark.range(10_000).select(F.lit("gio").alias("facet"), F.lpad((F.col("id") * 4).cast("string"), 6, "0").alias("option"))
    got = facet_resolve_joined(offered, wanted)
    assert "NestedLoop" not in plan_of(got) and "Cartesian" not in plan_of(got)
    counts = {r.n_matched: r["count"] for r in got.groupBy("n_matched").count().collect()}
    assert counts == {1: 5000, 0: 5000}


def test_a_long_label_is_listed_in_time_in_proportion(spark):
    """the grams of a label were compared pair by pair, each size of gram was made, wanted or not."""
    rng = random.Random(4)
    label = "".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(40_000))
    offered = [("Region", label), ("Region", label[:50]), ("Other", label)]
    wanted = [("gio", label[20:30]), ("gio", label[30_000:30_012]), ("gio", "no such"), ("her", label[20:24])]
    start = time.monotonic()
    got = rows(facet_resolve_joined(spark.createDataFrame(offered, SCHEMA), spark.createDataFrame(wanted, SCHEMA)))
    assert got == brute_force(offered, wanted)
    assert time.monotonic() - start < 30
