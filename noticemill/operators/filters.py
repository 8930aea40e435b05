"""Row filters: publication window, law, number validity, facets."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticemill.functions.validity import check_law, is_valid_number, reject_reason


def published_window(notices: DataFrame, as_of: date, days: int, published: str = "published_on") -> DataFrame:
    """Notices published from `days` days before `as_of` up to `as_of`, both included."""
    last = F.lit(as_of)
    return notices.filter(F.col(published).between(F.date_sub(last, days), last))


def law_filter(notices: DataFrame, law: str | None) -> DataFrame:
    """Notices under one law; None keeps both laws."""
    if check_law(law) is None:
        return notices.filter(F.col("law").isin("44", "223"))
    return notices.filter(F.col("law") == law)


def valid_numbers(notices: DataFrame, number: str = "notice_num") -> DataFrame:
    return notices.filter(is_valid_number(F.col("law"), F.col(number)))


def invalid_numbers(notices: DataFrame, number: str = "notice_num") -> DataFrame:
    """What `valid_numbers` leaves out, with the reason."""
    rejects = notices.withColumn("reason", reject_reason(F.col("law"), F.col(number)))
    return rejects.filter(F.col("reason").isNotNull())


def contains_ignoring_case(label: Column, part: str) -> Column:
    return F.contains(F.lower(label), F.lower(F.lit(part)))


def facet_filter(rows: DataFrame, label: str, options: Sequence[str]) -> DataFrame:
    """Rows whose label contains any of the options; no options means no restriction."""
    if not options:
        return rows
    return rows.filter(reduce(or_, [contains_ignoring_case(F.col(label), o) for o in options]))
