"""Every query against its SQL counterpart, and the counts noted in FIXTURES.md."""

from collections import Counter

import pytest

import __spark_entry__ as driver
from noticemill import catalog, oracles
from tests.conftest import SMALL, plan_of

QUERIES = catalog.queries()
SQL = oracles.oracle_sql()


def sorted_rows(columns, rows):
    order = sorted(columns)
    return sorted((tuple(row[columns.index(c)] for c in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert len(QUERIES) == 67
    assert set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    cursor = duck.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(columns, cursor.fetchall())


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize(
    "name, expected",
    [
        ("published_window", 31),
        ("valid_num_44", 600),
        ("valid_num_223", 450),
        ("new_nums_44", 395),
        ("new_rows_223", 300),
        ("contiguous_pages", 1391),
        ("notice_numbers", 1470 - 16),
        ("url_notice_id", 504),
    ],
)
def test_anchor_counts(spark, name, expected):
    assert QUERIES[name](spark, SMALL).count() == expected


@pytest.mark.parametrize(
    "name, expected",
    [
        ("kw_any", {"kw_a": 143, "kw_b": 40, "kw_c": 143}),
        ("kw_all", {"kw_a": 2, "kw_c": 143}),
        ("code_subtree", {"okpd_a": 6}),
        ("code_search", {"okpd_a": 6, "okpd_b": 1}),
        ("run_okpd_44", {"okpd_a": 1, "okpd_b": 1}),
    ],
)
def test_anchor_counts_per_list(spark, name, expected):
    found = Counter(row.list_id for row in QUERIES[name](spark, SMALL).collect())
    assert {k: n for k, n in found.items() if k in ("kw_a", "kw_b", "kw_c", "okpd_a", "okpd_b")} == expected


def test_anchor_attachments(spark):
    found = Counter((r.policy, r.list_id) for r in QUERIES["kw_in_attachments"](spark, SMALL).collect())
    assert found == {
        ("any", "kw_a"): 149,
        ("any", "kw_b"): 41,
        ("any", "kw_c"): 151,
        ("all", "kw_a"): 2,
        ("all", "kw_c"): 151,
    }


def test_anchor_runs(spark):
    kw = [r for r in QUERIES["run_kw_44"](spark, SMALL).collect() if r.list_id == "kw_a"]
    assert len(kw) == 27
    lines = [r.line for r in QUERIES["run_223"](spark, SMALL).collect()]
    assert len(lines) == 300
    assert sum(line.count(";") == 2 for line in lines) == 169
    assert {line.count(";") for line in lines} == {0, 2}


def test_no_query_joins_every_pair(spark):
    for name, query in QUERIES.items():
        if name.startswith(("stream", "scan", "sink", "compact")):
            continue
        plan = plan_of(query(spark, SMALL))
        assert "Cartesian" not in plan and "NestedLoop" not in plan, name
