"""Answers of tasks under way, kept as they come, so that a lost task or driver repeats few calls.

A task appends the answers it has to small Parquet files in a folder of its own, at the
latest every `rows` answers or `seconds` seconds. A file appears whole or not at all. Where
the task runs again it takes its answers from there; where the whole run is lost, the next
run over the same log writes them as records before it calls anything (`take_over`). What a
finished write has put into the log is deleted here.

The folder starts with an underscore, so that readers of the log do not see it. Two runs may
use one log: an answer is taken over only for an item and attempt that the run would call.
"""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harkline.session import delete_folder, local_path, written

_FILE = "answers-"


@dataclasses.dataclass(frozen=True)
class Journal:
    """Where answers are kept, and how many answers or seconds one file holds at most."""

    folder: str
    rows: int = 256
    seconds: float = 30.0

    @classmethod
    def of(cls, log_path: str, **bounds) -> Journal:
        """The journal of a log."""
        return cls(f"{log_path.rstrip('/')}/_journal", **bounds)

    def below(self, *names: object) -> Journal:
        return dataclasses.replace(self, folder="/".join([self.folder, *map(str, names)]))

    def task(self, number: int) -> TaskJournal:
        return TaskJournal(self.below(f"task-{number:07d}").folder)


class TaskJournal:
    """The files of one task, written and read inside it."""

    def __init__(self, folder: str):
        path = local_path(folder)
        self._system, self._folder = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)

    def append(self, batch: pa.RecordBatch) -> None:
        self._system.create_dir(self._folder, recursive=True)
        name = f"{_FILE}{uuid.uuid4().hex}.parquet"
        hidden = f"{self._folder}/.{name}"
        pq.write_table(pa.Table.from_batches([batch]), hidden, filesystem=self._system)
        self._system.move(hidden, f"{self._folder}/{name}")

    def answers(self, names: list[str]) -> dict[str, list[tuple]]:
        """Answers of earlier attempts of this task, by the row they belong to (`names`: its columns)."""
        found: dict[str, list[tuple]] = {}
        for file in self._system.get_file_info(fs.FileSelector(self._folder, allow_not_found=True)):
            if file.base_name.startswith(_FILE):
                table = pq.read_table(file.path, filesystem=self._system, partitioning=None)
                for row in zip(*(c.to_pylist() for c in table.columns)):
                    found.setdefault(repr(row[: len(names)]), []).append(row)
        return found


def _lost(spark: SparkSession, journal: Journal) -> list[str]:
    """Folders that hold answers, one for each run that was lost or is under way."""
    path = spark._jvm.org.apache.hadoop.fs.Path(journal.folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def filled(folder) -> bool:
        files = system.listFiles(folder, True)
        while files.hasNext():
            if files.next().getPath().getName().startswith(_FILE):
                return True
        return False

    if not system.exists(path):
        return []
    return sorted(f.getPath().toString() for f in system.listStatus(path) if f.isDirectory() and filled(f.getPath()))


def take_over(todo: DataFrame, state: DataFrame, journal: Journal, key: str, write: Callable[[DataFrame], None]) -> DataFrame:
    """Write the answers that lost runs left for calls in `todo`; return the calls that remain.

    `write` gets rows as `annotate` returns them. An answer belongs to a call with the same
    key and the same attempt. A run's folder is deleted if all its answers are now in the
    log, by `state` or by this write; the others belong to a run that is still under way.
    """
    spark, call = todo.sparkSession, [key, "retry_attempt"]
    told = F.coalesce("done", F.lit(False)) | (F.coalesce("retry", F.lit(0)) >= F.col("retry_attempt"))
    for folder in _lost(spark, journal):
        files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"{_FILE}*.parquet")
        answers = files.parquet(folder)
        if not set(call) <= set(answers.columns):
            continue
        taken = written(answers.join(todo.select(*call), call, "left_semi").select(*answers.columns), "taken-over")
        write(taken)
        todo = written(todo.join(taken.select(*call), call, "left_anti").select(*todo.columns), "pending")
        rest = answers.select(*call).join(taken.select(*call), call, "left_anti").join(state, key, "left")
        if rest.where(~told).isEmpty():
            delete_folder(spark, folder)
    return todo
