"""Report new notices from a stream of landed ones, each number once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from noticemill.operators.filters import valid_numbers
from noticemill.operators.registry import NUMBER_KEY, new_numbers
from noticemill.session import stage
from noticemill.streaming.intake import MAX_FILE_AGE

# A number landed very often is first made distinct in this many parts.
NUMBER_SPLITS = 32


def stream_new_notices(
    spark: SparkSession,
    landed: str,
    schema: StructType | str,
    registry: Callable[[], DataFrame],
    out: str,
    checkpoint: str,
    window_days: int,
    published: str = "published_ts",
    files_per_batch: int = 1000,
    max_file_age: str = MAX_FILE_AGE,
) -> StreamingQuery:
    """Write (law, notice_num, published) of unknown valid numbers below out/batch_id=….

    A number is reported once per `window_days` of arrival, the time of the batch that reads
    it; state older than that is dropped. As a row is never later than its own batch, no row
    is too late, whatever its publication time and however the files are cut into batches.
    Copies are first dropped within a part of the input files, so that a number with very
    many copies never meets in one task before it has shrunk. `registry` is asked anew for
    every batch and only its rows of the batch's numbers are looked at. A batch that is
    repeated overwrites its own folder. Files more than `max_file_age` older than the
    newest one seen are not read; `intake.overlooked_files` lists them.
    """
    rows = (
        spark.readStream.format("parquet")
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", max_file_age)
        .load(landed)
    )
    part = F.pmod(F.col("_metadata.row_index"), F.lit(NUMBER_SPLITS))
    numbers = (
        valid_numbers(rows.withColumn("_part", part))
        .select(*NUMBER_KEY, published, "_part", F.current_timestamp().alias("_arrived"))
        .withWatermark("_arrived", f"{window_days} days")
        .dropDuplicatesWithinWatermark([*NUMBER_KEY, "_part"])
        .dropDuplicatesWithinWatermark(NUMBER_KEY)
        .drop("_part", "_arrived")
    )

    def report(batch: DataFrame, batch_id: int) -> None:
        batch = stage(batch, "batch")  # read twice below; the state is to be asked once
        # numbers are distinct by now, so this join has no hot key
        new = batch.join(new_numbers(batch, registry()), NUMBER_KEY, "left_semi")
        new.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return (
        numbers.writeStream.foreachBatch(report)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
