"""Output lines with a manifest for each run: a run counts as a whole or not at all.

Tasks write files under names of their own. When all have ended, the driver writes the
run's manifest, one row for each file; what no manifest names is not read. A run that was
killed leaves none, and one that is repeated replaces its own, so each line is there once.

Compaction merges only the lists with runs not merged yet. It writes new files and a
manifest that says which runs it stands for; files of other lists stay as they are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import datetime
from urllib.parse import quote

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from noticemill.functions import text
from noticemill.session import file_system
from noticemill.sources.lines import RUN_TS_FORMAT

MANIFEST = "run_ts string, version bigint, source string, list_id string, file string, n_lines bigint, merged array<string>"
FORMAT = "notice_lines"


@dataclass
class Written(WriterCommitMessage):
    """Files of one task: (source, list_id, file, lines)."""

    files: list[tuple[str | None, str | None, str, int]] = field(default_factory=list)


class LinesSource(DataSource):
    """The write side: rows (source, list_id, line), clustered by the first two."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return LinesWriter(self.options)


class LinesWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.run_ts, self.version = options["path"], options["run_ts"], int(options["version"])
        self.merged = json.loads(options["merged"])

    def write(self, rows: Iterator[Row]) -> Written:
        folder, root = file_system(self.path)
        done = Written()
        key, out, n = None, None, 0
        try:
            for source, list_id, line in rows:
                if out is None or (source, list_id) != key:
                    if out is not None:
                        out.close()
                        done.files[-1] = (*done.files[-1][:3], n)
                    key, n = (source, list_id), 0
                    own = "/".join(quote("none" if k is None else f"is-{k}", safe="") for k in key)
                    folder.create_dir(f"{root}/data/{own}", recursive=True)
                    done.files.append((source, list_id, f"data/{own}/{uuid.uuid4().hex}.txt", 0))
                    out = folder.open_output_stream(f"{root}/{done.files[-1][2]}")
                out.write(f"{line}\n".encode())
                n += 1
        finally:
            if out is not None:
                out.close()
        if done.files:
            done.files[-1] = (*done.files[-1][:3], n)
        return done

    def commit(self, messages: list[Written | None]) -> None:
        """Write the manifest under another name, then give it its own: readers see all of it or none."""
        folder, root = file_system(self.path)
        rows = [
            {"run_ts": self.run_ts, "version": self.version, "source": source, "list_id": list_id, "file": file, "n_lines": n, "merged": self.merged}
            for message in messages
            if message is not None
            for source, list_id, file, n in message.files
        ]
        folder.create_dir(f"{root}/manifests", recursive=True)
        begun = f"{root}/manifests/_{uuid.uuid4().hex}"
        with folder.open_output_stream(begun) as out:
            out.write("".join(json.dumps(row) + "\n" for row in rows).encode())
        folder.move(begun, f"{root}/manifests/{quote(self.run_ts, safe='')}.json")

    def abort(self, messages: list[Written | None]) -> None:
        """Files of ended tasks are taken away; those of a killed driver stay, but no manifest names them."""
        folder, root = file_system(self.path)
        for message in messages:
            for *_, file, _ in message.files if message is not None else ():
                folder.delete_file(f"{root}/{file}")


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """One row per file of the committed runs."""
    folder, root = file_system(path)
    folder.create_dir(f"{root}/manifests", recursive=True)
    return spark.read.schema(MANIFEST).json(f"{path}/manifests")


def _write(
    lines: DataFrame, path: str, run_ts: str, version: int, merged: list[str], measured: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> None:
    spark = lines.sparkSession
    spark.dataSource.register(LinesSource)
    source = F.col("source") if "source" in lines.columns else F.lit(None).cast("string")
    rows = lines.select(source.alias("source"), F.col("list_id").cast("string"), F.col("line").cast("string"))
    rows = rows.dropna(subset=["line"]).hint("rebalance", "source", "list_id").sortWithinPartitions("source", "list_id")
    options = {"path": path, "run_ts": run_ts, "version": str(version), "merged": json.dumps(merged)}
    measured(rows).write.format(FORMAT).options(**options).mode("append").save()


def write_run(lines: DataFrame, path: str, run_at: datetime, measured: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
    """Add the lines (source if there is one, list_id, line) of a run as a whole.

    A run repeated with the same `run_at` replaces what it wrote before. Once it has been
    merged by `compact_runs` it can't be repeated, which raises ValueError. Null lines are
    left out; a run without lines is an empty manifest. `path` must be a folder that all
    executors share; runs of one `path` come one after the other. `measured` may observe
    the rows (source, list_id, line) as they are written.
    """
    spark, run_ts = lines.sparkSession, run_at.strftime(RUN_TS_FORMAT)
    known = manifests(spark, path)
    if not known.filter(F.array_contains("merged", run_ts)).isEmpty():
        raise ValueError(f"run {run_ts} has been merged")
    _write(lines, path, run_ts, _next_version(known), [], measured)


def _next_version(known: DataFrame) -> int:
    return (known.agg(F.max("version")).first()[0] or 0) + 1


def _current(known: DataFrame) -> DataFrame:
    """The files that count: of each list its last compaction and the runs after it."""
    of_list = Window.partitionBy("source", "list_id")
    compacted = F.max(F.when(F.size("merged") > 0, F.col("version"))).over(of_list)
    return known.withColumn("_compacted", F.coalesce(compacted, F.lit(0))).filter(F.col("version") >= F.col("_compacted")).drop("_compacted")


def _lines_of(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    stored = spark.read.schema("line string").option("recursiveFileLookup", "true").text(f"{path}/data")
    # file names are unique, their folders are only there for people
    own = files.withColumn("_name", F.substring_index("file", "/", -1))
    return stored.select("line", F.col("_metadata.file_name").alias("_name")).join(own, "_name")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """(source, list_id, run_ts, line) of the committed runs; merged lines have the run_ts of the merge."""
    files = _current(manifests(spark, path))
    folder, root = file_system(path)
    folder.create_dir(f"{root}/data", recursive=True)
    return _lines_of(spark, path, files).select("source", "list_id", "run_ts", "line")


def compact_runs(spark: SparkSession, path: str, run_at: datetime) -> int:
    """Merge the lists that have runs not merged yet: stripped lines, each once per list.

    Returns how many lists were merged. Other lists keep their files.
    """
    known = manifests(spark, path)
    files = _current(known)
    of_list = Window.partitionBy("source", "list_id")
    open_runs = F.count(F.when(F.size("merged") == 0, 1)).over(of_list)
    files = files.withColumn("_open", open_runs).filter("_open > 0")
    n_lists = files.select("source", "list_id").distinct().count()
    if n_lists:
        runs = [row.run_ts for row in files.filter(F.size("merged") == 0).select("run_ts").distinct().collect()]
        merged = _lines_of(spark, path, files).select("source", "list_id", text.strip(F.col("line")).alias("line")).distinct()
        _write(merged, path, run_at.strftime(RUN_TS_FORMAT), _next_version(known), sorted(runs))
    return n_lists
