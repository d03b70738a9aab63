"""Shared folders and the timeline of a table."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import time
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.functions.instants import pad_instant, validate_instant
from rowtide.spec import COMMIT, TableSpec

# What a timeline entry says happened at its instant.
COMMITTED, COMPACTED, TRIMMED, REPLACED, JOINED = "committed", "compacted", "trimmed", "replaced", "joined"

# Folder columns of stored data: the attempt that wrote it, and what of the table it holds.
ATTEMPT, SLICE = "_attempt", "_slice"

# Files removed side by side.
REMOVERS = 16


@functools.cache
def _temporary() -> str:
    path = tempfile.mkdtemp(prefix="rowtide-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder every executor can reach, below the one the session names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of the machine, which goes when the process ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = _temporary()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _file_system(spark, path)
    return fs.exists(folder)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if it is not there."""
    fs, folder = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def file_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the Parquet files in a folder, those of its folders not counted."""
    fs, folder = _file_system(spark, path)
    found = fs.listStatus(folder) if fs.exists(folder) else []
    return sum(s.getLen() for s in found if s.getPath().getName().endswith(".parquet"))


def create(spark: SparkSession, path: str) -> None:
    """An empty file."""
    fs, file = _file_system(spark, path)
    fs.mkdirs(file.getParent())
    fs.create(file, True).close()


def remove(spark: SparkSession, path: str) -> None:
    fs, folder = _file_system(spark, path)
    fs.delete(folder, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    fs, folder = _file_system(spark, path)
    if fs.exists(folder) and not fs.rename(folder, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"could not rename {path} to {to}")


def remove_all(spark: SparkSession, paths: list[str]) -> None:
    with ThreadPoolExecutor(REMOVERS) as pool:
        list(pool.map(lambda path: remove(spark, path), paths))


def require_keys(records: DataFrame, spec: TableSpec) -> DataFrame:
    """Fail the job on a record without key or partition value; a folder name cannot tell null from empty text."""
    checked = {}
    for column in spec.scope:
        value = F.col(column)
        missing = value.isNull()
        if column in spec.partition:
            missing = missing | (value.cast("string") == "")
        checked[column] = F.when(missing, F.raise_error(F.lit(f"record without {column}"))).otherwise(value)
    return records.withColumns(checked)


def new_attempt() -> str:
    return uuid.uuid4().hex


@dataclass(frozen=True, order=True)
class Entry:
    written: int
    instant: str
    action: str
    attempt: str


def parse_entries(names: Iterable[str]) -> list[Entry]:
    """What the files of a timeline say, oldest first: per action and instant the last entry, and nothing from before a
    replacement."""
    found = []
    for name in names:
        if not name.startswith("."):  # checksums beside the files
            written, instant, action, attempt = name.split("-")
            found.append(Entry(int(written), instant, action, attempt))
    started = max((e.written for e in found if e.action == REPLACED), default=0)
    last = {(e.action, e.instant): e for e in sorted(found) if e.written >= started}
    return sorted(last.values(), key=lambda e: (e.instant, e.written))


class Timeline:
    """Which attempts at a commit count. Data is written first and entered here last.

    Every attempt writes to a folder of its own. An entry is an empty file whose name says when it was made, its
    instant, what happened and which attempt did it, so the timeline is read by listing one folder. A job that dies
    half way leaves a folder without an entry, which readers do not see; a repeated commit replaces the entry before
    it. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path}/timeline"

    def entries(self) -> list[Entry]:
        """What counts, see ``parse_entries``."""
        return parse_entries(children(self.spark, self.path))

    def enter(self, instant: str, action: str, attempt: str, replace: bool = False) -> None:
        """Make an attempt count. ``replace``: and nothing that was entered before."""
        (written,) = self.enter_all([instant], action, attempt)
        if replace:
            # hides all older ones at once, and with them the entry just made until this one stands
            create(self.spark, f"{self.path}/{written:020d}-{instant}-{REPLACED}-{attempt}")

    def enter_all(self, instants: Iterable[str], action: str, attempt: str) -> list[int]:
        """Make an attempt at several instants count, one after another. The timeline is listed once."""
        newest = max((int(n.split("-")[0]) for n in children(self.spark, self.path)), default=0)
        made = []
        for instant in instants:
            newest = max(time.time_ns(), newest + 1)
            create(self.spark, f"{self.path}/{newest:020d}-{instant}-{action}-{attempt}")
            made.append(newest)
        return made

    def forget(self, keep: list[Entry]) -> None:
        """Remove the entries that are not in ``keep``."""
        names = {f"{e.written:020d}-{e.instant}-{e.action}-{e.attempt}" for e in keep}
        remove_all(self.spark, [f"{self.path}/{n}" for n in children(self.spark, self.path) if n not in names])


def of_action(entries: list[Entry], action: str, until: str | None = None) -> list[Entry]:
    """Entries of one kind up to an instant, oldest first."""
    bound = None if until is None else pad_instant(until)
    return [e for e in entries if e.action == action and (bound is None or e.instant <= bound)]


def last_instant(entries: list[Entry], action: str, until: str | None = None) -> str | None:
    found = of_action(entries, action, until)
    return found[-1].instant if found else None


def commits_frame(spark: SparkSession, entries: list[Entry]) -> DataFrame:
    return spark.createDataFrame([(e.instant,) for e in of_action(entries, COMMITTED)], f"{COMMIT} string")


def check_new_commit(entries: list[Entry], commit: str) -> None:
    validate_instant(commit)
    last = last_instant(entries, COMMITTED)
    if last is not None and commit < last:
        raise ValueError(f"commit {commit} is before the last commit {last}")


def check_kept(entries: list[Entry], instant: str) -> None:
    floor = last_instant(entries, TRIMMED)
    if floor is not None and pad_instant(instant) < floor:
        raise ValueError(f"versions before {floor} were removed; cannot read as of {instant}")


def oldest_kept(instants: list[str], keep: int, above: int | None) -> str | None:
    """The oldest of the last ``keep`` commits, or None if there are none or not more than ``above``."""
    if keep < 1:
        raise ValueError("at least one commit is kept")
    if not instants or (above is not None and len(instants) <= above):
        return None
    return instants[-keep:][0]
