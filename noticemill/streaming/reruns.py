"""Report a notice at each run until the registry knows it or its window is over.

A run reports what was published in its window and is not registered. The notices arrive
as a stream, so a run reads only the files landed since the one before; what is still open
from earlier runs is kept as state, one entry per number, with a timer that is due at the
next run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date, timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from noticemill.operators.filters import valid_numbers
from noticemill.operators.registry import NUMBER_KEY, new_numbers
from noticemill.session import stage
from noticemill.streaming.intake import MAX_FILE_AGE

OPEN = "law string, notice_num string"
# Timers need this state store. A run ends with its last file: as timers may always be due,
# Spark would go on with empty batches for ever.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


@contextmanager
def stream_settings(spark: SparkSession) -> Iterator[None]:
    """Settings that a query takes over when it starts; the session has its own again after that."""
    before = {name: spark.conf.get(name, None) for name in STREAM_SETTINGS}
    for name, value in STREAM_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


class OpenNumbers(StatefulProcessor):
    """Per number the days on which it was published, as long as one can be in a window.

    Rows and timer of a number both lead to `_report`, which gives the number once per run.
    """

    def __init__(self, as_of: date, days: int) -> None:
        self.as_of, self.first = as_of, as_of - timedelta(days=days)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.number = handle.getValueState("number", "reported_on date, published array<date>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        landed = {day for part in rows for day in part["published_on"]}
        reported, published = self.number.get() if self.number.exists() else (None, [])
        yield from self._report(key, reported, sorted({*published, *landed}), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.number.exists():
            yield from self._report(key, *self.number.get(), timerValues)

    def _report(self, key, reported, published, timer_values) -> Iterator[pd.DataFrame]:
        still = [day for day in published if day >= self.first]
        due = reported != self.as_of and any(day <= self.as_of for day in still)
        if due:
            yield pd.DataFrame([key], columns=NUMBER_KEY)
        if still:
            self.number.update((self.as_of if due else reported, still))
            self.handle.registerTimer(timer_values.getCurrentProcessingTimeInMs() + 1)
        elif self.number.exists():
            self.number.clear()

    def close(self) -> None:
        pass


def report_run(
    spark: SparkSession,
    landed: str,
    schema: StructType | str,
    registry: Callable[[], DataFrame],
    out: str,
    runs: str,
    checkpoint: str,
    as_of: date,
    days: int,
    published: str = "published_on",
    max_file_age: str = MAX_FILE_AGE,
) -> StreamingQuery:
    """One run: (law, notice_num) in the window [as_of - days, as_of] that are not registered.

    Written below out/run_on=<as_of>/batch_id=…; each number once per run, again at every
    later run until the registry knows it or its window is over. The state is shared by the
    runs through `checkpoint`, so runs come one after the other, as_of ascending. Each run
    puts a row into the folder `runs`: with it there is something to read, and so timers
    are looked at, also when no notice has landed. The registry is asked anew for each batch. A
    run that died is finished, or repeated without change, by calling it again.
    Files more than `max_file_age` older than the newest one seen are not read.
    """
    marker = spark.createDataFrame([(as_of,)], "run_on date")
    marker.coalesce(1).write.mode("append").parquet(runs)
    notices = spark.readStream.format("parquet").schema(schema).option("maxFileAge", max_file_age).load(landed)
    day = F.col(published).cast("date")
    in_time = valid_numbers(notices).filter(day >= F.lit(as_of - timedelta(days=days)))
    rows = in_time.select(*NUMBER_KEY, day.alias("published_on")).dropna(subset=NUMBER_KEY)
    starts = spark.readStream.format("parquet").schema("run_on date").option("maxFileAge", max_file_age).load(runs)
    nothing = starts.filter(F.lit(False)).select(*[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns])
    still_open = (
        rows.unionByName(nothing)
        .groupBy(*NUMBER_KEY)
        .transformWithStateInPandas(OpenNumbers(as_of, days), OPEN, outputMode="Append", timeMode="ProcessingTime")
    )

    def report(batch: DataFrame, batch_id: int) -> None:
        batch = stage(batch, "open-numbers")  # the state is asked once, the numbers are read twice
        new_numbers(batch, registry()).write.mode("overwrite").parquet(f"{out}/run_on={as_of}/batch_id={batch_id}")

    with stream_settings(spark):
        return (
            still_open.writeStream.foreachBatch(report)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
