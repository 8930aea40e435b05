"""A run that counts what it collects and writes while it does so, for each worker."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from noticemill.functions import text
from noticemill.operators.registry import flagged_numbers, numbers_per_list
from noticemill.session import stage
from noticemill.sources.runs import write_run

# Each worker is a few aggregates of the run itself.
MAX_WORKERS = 256
REPORT = "worker int, found_rows bigint, found_distinct bigint, new_distinct bigint"


class WorkerCounts:
    """Sums for each worker, taken by Spark from rows that pass on their way to a sink.

    `observe` belongs on the rows that are written, behind the last shuffle: a task of the
    writing stage counts once however often it is tried.
    """

    def __init__(self, worker: Column, workers: int) -> None:
        if not 0 < workers <= MAX_WORKERS:
            raise ValueError(f"a run has 1 to {MAX_WORKERS} workers, not {workers}")
        self.worker, self.workers, self.observation = worker, workers, Observation()

    def observe(self, rows: DataFrame, **values: Column) -> DataFrame:
        sums = [
            F.sum(F.when(self.worker == k, value)).alias(f"{name}_{k}") for k in range(self.workers) for name, value in values.items()
        ]
        return rows.observe(self.observation, *sums)

    def of(self, name: str) -> list[int]:
        """The sums of one value, once the rows have been written; 0 for a worker without rows."""
        found = self.observation.get
        return [found.get(f"{name}_{k}") or 0 for k in range(self.workers)]


def counted_run(
    collected: DataFrame, registry: DataFrame, path: str, run_at: datetime, worker: Column, workers: int
) -> DataFrame:
    """Write the new numbers of `collected` (list_id, law, notice_num) as a run, and report it.

    `worker`, an expression of list_id, says who had a list: 0 to `workers` - 1; rows of
    nobody are written and not reported. The counts come with the two writes that the run
    makes anyway, nothing is read again for them: rows and distinct (list, law, number) as
    the collected numbers are written, and new ones as the lines are. Every worker has a
    row, also one without lists.
    """
    found, new = WorkerCounts(worker, workers), WorkerCounts(worker, workers)
    per_number = stage(found.observe(numbers_per_list(collected), found=F.col("_found"), numbers=F.lit(1)), "per-number")
    new_numbers = flagged_numbers(per_number, registry).filter(F.col("_is_known").isNull())
    lines = new_numbers.select("list_id", text.output_line(F.col("notice_num")).alias("line"))
    write_run(lines, path, run_at, lambda rows: new.observe(rows, numbers=F.lit(1)))
    columns = zip(range(workers), found.of("found"), found.of("numbers"), new.of("numbers"))
    return collected.sparkSession.createDataFrame(list(columns), REPORT)
