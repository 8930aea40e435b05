"""Which notice numbers are well formed, by law."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The shape of a notice number under each law.
LAWS = ("44", "223")
LENGTH_44 = 19
LENGTH_223 = 11
PREFIX_223 = "3"


def check_law(law: str | None) -> str | None:
    if law is not None and law not in LAWS:
        raise ValueError(f"law must be one of {LAWS} or None, not {law!r}")
    return law


def is_valid_number(law: Column, number: Column) -> Column:
    return ((law == "44") & (F.length(number) == LENGTH_44)) | (
        (law == "223") & (F.length(number) == LENGTH_223) & F.startswith(number, F.lit(PREFIX_223))
    )


def reject_reason(law: Column, number: Column) -> Column:
    """Why a number is not usable; NULL for a valid one."""
    return (
        F.when(number.isNull(), "no_number")
        .when(is_valid_number(law, number), None)
        .when((law == "223") & (F.length(number) == LENGTH_223), "bad_prefix")
        .otherwise("bad_length")
    )
