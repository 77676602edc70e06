"""Layer tables as parquet folders, each run behind a log that names its data."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from vanewatch.operators.analysis import Bound, period_bounds
from vanewatch.operators.quality import SPLIT_RAW, for_run, split_rows
from vanewatch.schemas import BRONZE, RAW, RUN, TABLES, RequiredColumns, conform, table_info

# UTC day and microsecond of a silver reading, kept in the files but not part of the table's columns.
# Timestamps are stored as INT96 by default, which has no statistics to skip by; a number has them.
DAY, MICROS = "telemetry_day", "telemetry_micros"

# Where the rows of one write are, below a table; rows of silver and quarantine written in one pass are below SPLIT.
COMMIT, SPLIT, SPLIT_TABLE = "commit", "split", "table"
LOG = "_log"
# Files from which on the quarantined rows of a split are worth being written again in fewer.
MANY_FILES = 64

# Hive partition naming, fixed values: the folder of a NULL value, and the escaped characters.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = set("\"#%'*/:=?\\{[]^\x7f") | {chr(code) for code in range(0x20)}


def partition_folder(run: str | None) -> str:
    if run is None:
        return f"{RUN}={NULL_PARTITION}"
    if not run:
        raise ValueError("a run id must not be empty")
    return f"{RUN}=" + "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in run)


def utc_day(time: Column) -> Column:
    """Days since 1970, the same in every session time zone."""
    return F.floor(F.unix_seconds(time) / 86400).cast("int")


def live(entries: list[str]) -> tuple[list[str], bool]:
    """Places that a run's rows are in, from the names in its log, and whether rows outside of the log count too.

    A name is ``<number>.<replace or append>.<place>``. The rows are those of the last replacement and of what was
    added after it; before any replacement, rows of other writers belong to the run as well.
    """
    found: list[str] = []
    others = True
    for name in sorted(entries):
        _, kind, place = name.split(".", 2)
        if kind == "replace":
            found, others = [], False
        found.append(place)
    return found, others


class ParquetStore:
    """Tables under one root folder: ``<root>/<layer>/<table>/commit=<write>/event_id=<run>/``.

    Every write has a folder of its own, which nothing changes later. A run's rows are those that its log names:
    empty files in ``<table>/_log/event_id=<run>/``, one for each write. To create such a file is one step for the file
    system, also for object stores, where a rename would be a copy. A reader therefore sees the old rows up to that
    step and the new ones from it on; a job that fails, or a driver that is lost before it, leaves the run as it was.
    Replaced rows are removed after the step. What lost drivers leave behind goes with ``sweep``.

    Files that other writers put into ``<table>/event_id=<run>/`` are read too, until a run is replaced.

    With ``daily``, a run's silver is laid out in one folder per UTC day, so that a period reads the folders of its
    days alone, whatever the order of the input. That costs one shuffle when silver is written. With ``ordered``, the
    rows of each silver file are sorted by time, so that a period reads the pages of its own time alone; that costs a
    sort in each task. Reading needs no option.

    ``required`` says what becomes of a NULL in a column that a table declares as required: ``ignore``, ``fail`` or
    ``count`` (then ``violations`` has the numbers of the last write of each table).
    """

    # a second pass over columnar files is cheaper than caching a large intermediate frame
    cheap_rescan = True

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        mode: str = "replace",
        daily: bool = False,
        ordered: bool = False,
        required: str = "ignore",
    ):
        if mode not in ("replace", "append"):
            raise ValueError(f"unknown mode {mode!r}, expected replace or append")
        self.spark = spark
        self.root = root.rstrip("/")
        self.mode = mode
        self.daily = daily
        self.ordered = ordered
        self.required = RequiredColumns(required)

    @property
    def violations(self) -> dict[str, dict[str, int]]:
        return self.required.counts

    def path(self, table: str) -> str:
        layer, name, _ = table_info(table)
        return f"{self.root}/{layer}/{name}"

    # --- writing ----------------------------------------------------------------------------------

    def write(self, table: str, df: DataFrame, run: str | None, compact: bool = False) -> None:
        """Store the rows of ``run`` in ``df``, replacing that run's old rows or adding to them.

        ``compact`` evens out file sizes for results that are much smaller than their input.
        """
        if run is None and self.required.how == "fail":
            raise ValueError(f"{table}.{RUN} is required")
        place = self._new_place(COMMIT)
        df, counted = self.required.apply(conform(for_run(df, run), table), table)
        folder = f"{self._folder(table, place)}/{partition_folder(run)}"
        self._laid_out(table, df.drop(RUN), compact).write.partitionBy(*self._days(table)).parquet(folder)
        self.required.take(table, counted)
        self._commit(table, partition_folder(run), place)

    def write_runs(
        self, table: str, df: DataFrame, compact: bool = False, runs: Iterable[str | None] = ()
    ) -> None:
        """Store every run in ``df`` with one scan of it, and ``runs`` also if it has no rows of them.

        Other runs stay as they are.
        """
        place = self._new_place(COMMIT)
        folder = self._folder(table, place)
        df, counted = self.required.apply(conform(df, table), table)
        self._laid_out(table, df, compact, RUN).write.partitionBy(RUN, *self._days(table)).parquet(folder)
        self.required.take(table, counted)
        for run in {*self._names(folder, f"{RUN}="), *map(partition_folder, runs)}:
            self._commit(table, run, place)

    def write_split(self, quality: DataFrame, runs: Iterable[str | None]) -> None:
        """Store the valid and the invalid rows of ``runs`` as silver and quarantine, with one scan of ``quality``.

        Every one of the runs gets what ``quality`` has of it, be it nothing. The invalid rows come as one file for
        each task, and are written again in fewer files where there are many.
        """
        place = self._new_place(SPLIT)
        folder = f"{self.root}/{SPLIT}/{place.replace(SPLIT, COMMIT, 1)}"
        rows, counted = self.required.apply(
            split_rows(quality, SPLIT_TABLE), "silver", F.col(SPLIT_TABLE) == "silver"
        )
        rows = self._laid_out("silver", rows, False, SPLIT_TABLE, RUN)
        rows.write.partitionBy(SPLIT_TABLE, RUN, *self._days("silver")).parquet(folder)
        self.required.take("silver", counted)
        for run in runs:
            name = partition_folder(run)
            for table in ("silver", "quarantine"):
                self._commit(table, name, place)
            if self._number_of_files(f"{folder}/{SPLIT_TABLE}=quarantine/{name}") > MANY_FILES and self.mode == "replace":
                self.write("quarantine", self.read("quarantine", run), run, compact=True)

    def _new_place(self, kind: str) -> str:
        return f"{kind}={uuid.uuid4().hex}"

    def _folder(self, table: str, place: str) -> str:
        """Folder of a table's rows of one write; the runs' folders are in it."""
        kind, name = place.split("=", 1)
        if kind == SPLIT:
            return f"{self.root}/{SPLIT}/{COMMIT}={name}/{SPLIT_TABLE}={table}"
        return f"{self.path(table)}/{place}"

    def _days(self, table: str) -> list[str]:
        return [DAY] if self.daily and table == "silver" else []

    def _laid_out(self, table: str, df: DataFrame, compact: bool, *parts: str) -> DataFrame:
        """Rows as they are written to one folder for each value of ``parts``, and of the day if silver is by day."""
        if table == "silver":
            time = F.col("telemetry_time")
            df = df.withColumns({DAY: utc_day(time), MICROS: F.unix_micros(time)})
        if self._days(table):
            # few files for each day; a day with much of the input is split
            df = df.hint("rebalance", *parts, DAY)
        elif compact:
            df = df.hint("rebalance")
        if table == "silver" and self.ordered:
            # a writer wants its rows in the order of their folders anyway
            df = df.sortWithinPartitions(*parts, *self._days(table), MICROS)
        return df

    # --- the log ----------------------------------------------------------------------------------

    def _log(self, table: str, run_folder: str) -> str:
        return f"{self.path(table)}/{LOG}/{run_folder}"

    def _commit(self, table: str, run_folder: str, place: str) -> None:
        """Make ``place`` what the run's rows are in, or part of it. The one step that readers notice."""
        log = self._log(table, run_folder)
        entries = self._names(log)
        number = max([int(name.split(".", 1)[0]) for name in entries], default=0) + 1
        files, path = self._files(f"{log}/{number:010d}.{self.mode}.{place}")
        if not files.createNewFile(path):
            raise RuntimeError(f"cannot create {path}")
        if self.mode == "replace":
            self._drop(table, run_folder, entries)

    def _drop(self, table: str, run_folder: str, entries: list[str]) -> None:
        """Remove the rows that older entries of the log name, then these entries, and rows of other writers."""
        for name in sorted(entries):
            folder = self._folder(table, name.split(".", 2)[2])
            self._delete(f"{folder}/{run_folder}")
            if not self._names(folder):
                self._delete(folder)
        self._delete(f"{self.path(table)}/{run_folder}")
        for name in sorted(entries):
            self._delete(f"{self._log(table, run_folder)}/{name}")

    def sweep(self, older_than_hours: float = 24.0) -> list[str]:
        """Remove rows that no log names, as failed jobs and lost drivers leave them, and return their folders.

        Younger folders are spared: they may belong to a job that is still running.
        """
        before = (time.time() - older_than_hours * 3600) * 1000
        removed: list[str] = []
        for table in TABLES:
            base = self.path(table)
            named: set[tuple[str, str]] = set()
            for run in self._names(f"{base}/{LOG}"):
                named |= {(place, run) for place in live(self._names(self._log(table, run)))[0]}
            places = self._names(base, f"{COMMIT}=")
            places += [name.replace(COMMIT, SPLIT, 1) for name in self._names(f"{self.root}/{SPLIT}", f"{COMMIT}=")]
            for place in places:
                folder = self._folder(table, place)
                if self._modified(folder) >= before:
                    continue
                runs = self._names(folder)
                orphans = [run for run in runs if (place, run) not in named]
                for run in orphans:
                    self._delete(f"{folder}/{run}")
                    removed.append(f"{folder}/{run}")
                if len(orphans) == len(runs) and self._delete(folder) and not runs:
                    removed.append(folder)
        return removed

    # --- files ------------------------------------------------------------------------------------

    def _files(self, folder: str):
        """The file system of a folder, and its path there."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _names(self, folder: str, start: str = "") -> list[str]:
        """Names in a folder that begin with ``start``, but for markers of writers; none if there is no such folder."""
        files, path = self._files(folder)
        if not files.exists(path):
            return []
        names = [status.getPath().getName() for status in files.listStatus(path)]
        return sorted(name for name in names if name.startswith(start) and name[0] not in "._")

    def _number_of_files(self, folder: str) -> int:
        files, path = self._files(folder)
        return files.getContentSummary(path).getFileCount() if files.exists(path) else 0

    def _modified(self, folder: str) -> float:
        files, path = self._files(folder)
        return files.getFileStatus(path).getModificationTime() if files.exists(path) else float("inf")

    def _delete(self, folder: str) -> bool:
        files, path = self._files(folder)
        return files.delete(path, True)

    # --- reading ----------------------------------------------------------------------------------

    def read(
        self, table: str, run: str | None, period: tuple[Bound, Bound] | None = None
    ) -> DataFrame:
        """Rows of one run; a run never written has none. Lists no other run's files.

        ``period`` lets a silver scan skip the folders, row groups and pages of other times.
        """
        return self.read_runs(table, [run], period)

    def read_runs(
        self, table: str, runs: Iterable[str | None], period: tuple[Bound, Bound] | None = None
    ) -> DataFrame:
        """Rows of several runs in one frame."""
        runs = list(runs)
        df = self._scan(table, [partition_folder(run) for run in runs])
        if len(runs) == 1:
            df = for_run(df, runs[0])
        if period and table == "silver":
            first, last = period_bounds(self.spark, *period)
            day, micros = F.col(DAY), F.col(MICROS)
            # files of other writers lack these numbers: their rows stay for in_period to judge
            df = df.filter(day.isNull() | day.between(utc_day(first), utc_day(last)))
            df = df.filter(micros.isNull() | micros.between(F.unix_micros(first), F.unix_micros(last)))
        return df.select(*table_info(table)[2].names)

    def read_all(self, table: str) -> DataFrame:
        """Rows of every run; a table never written has none."""
        base = self.path(table)
        runs = {*self._names(f"{base}/{LOG}"), *self._names(base, f"{RUN}=")}
        return self._scan(table, sorted(runs)).select(*table_info(table)[2].names)

    def runs(self, table: str) -> list[str]:
        """Ids of the runs that have been written, from the names of their logs alone; without a null id."""
        found = []
        for name in self._names(f"{self.path(table)}/{LOG}"):
            value = name.split("=", 1)[1]
            if value != NULL_PARTITION:
                parts = value.split("%")
                found.append(parts[0] + "".join(chr(int(p[:2], 16)) + p[2:] for p in parts[1:]))
        return sorted(found)

    def _scan(self, table: str, run_folders: list[str]) -> DataFrame:
        """The rows in all folders that the logs of these runs name, with the columns that the files have besides."""
        schema = table_info(table)[2]
        if table == "silver":
            schema = StructType([*schema.fields, StructField(DAY, IntegerType()), StructField(MICROS, LongType())])
        base = self.path(table)
        found: dict[str, list[str]] = {COMMIT: [], SPLIT: [], RUN: []}
        inside: dict[str, set[str]] = {}

        def add(kind: str, folder: str, run: str) -> None:
            if folder not in inside:
                inside[folder] = set(self._names(folder, f"{RUN}="))
            if run in inside[folder]:
                found[kind].append(f"{folder}/{run}")

        for run in run_folders:
            places, others = live(self._names(self._log(table, run)))
            for place in places:
                add(place.split("=", 1)[0], self._folder(table, place), run)
            if others:
                add(RUN, base, run)
        plain = self.spark.read.schema(schema).option("basePath", base)
        frames = [plain.parquet(*found[kind]).select(*schema.names) for kind in (COMMIT, RUN) if found[kind]]
        if found[SPLIT]:
            text = StructType([StructField(SPLIT_RAW, RAW), BRONZE[RUN]])
            stored = self.spark.read.schema(text if table == "quarantine" else schema)
            rows = stored.option("basePath", f"{self.root}/{SPLIT}").parquet(*found[SPLIT])
            frames.append(rows.select(f"{SPLIT_RAW}.*", RUN) if table == "quarantine" else rows.select(*schema.names))
        if not frames:
            return self.spark.createDataFrame([], schema)
        return reduce(DataFrame.unionByName, frames)
