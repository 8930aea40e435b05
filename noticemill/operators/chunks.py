"""Cut lists into balanced parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticemill.operators.skew import number_rows


def chunk_terms(lists: DataFrame, parts: int) -> DataFrame:
    """Add `chunk` (1-based): contiguous parts of each list, the first ones one longer.

    With more parts than terms the empty tail parts do not appear.
    """
    if parts < 1:
        raise ValueError("parts must be at least 1")
    short = F.expr(f"group_rows div {parts}")
    longer = F.expr(f"group_rows % {parts}")
    head = longer * (short + 1)
    chunk = F.when(F.col("row_pos") < head, F.floor(F.col("row_pos") / (short + 1))).otherwise(
        longer + F.floor((F.col("row_pos") - head) / F.greatest(short, F.lit(1)))
    )
    numbered = number_rows(lists, ["list_id"], "pos")
    return numbered.withColumn("chunk", (chunk + 1).cast("int")).drop("row_pos", "group_rows")
