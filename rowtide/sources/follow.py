"""The commits of a stored changelog as a stream: what was entered in its timeline after an instant, each record once.

A Python data source. Offsets are instants, so consumers with checkpoints of their own go on where they stopped. Readers plan
from the timeline (one listing) and open the files of the commits between two offsets, a task per file; the commits' folders
are read as they were written, so nothing is folded and deletes are records like others.

    spark.dataSource.register(Commits)
    spark.readStream.format("rowtide_commits").schema(spec.record_schema).option("path", path).option("after", instant).load()

Files are reached with ``pyarrow.fs``: plain paths, ``file:``, ``hdfs:``, ``s3:`` and ``gs:``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rowtide.spec import COMMIT
from rowtide.tables.folders import COMMITTED, JOINED, SLICE, TRIMMED, Entry, last_instant, of_action, parse_entries

# Rows a task holds at a time.
BATCH_ROWS = 8192


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _names(path: str) -> list[str]:
    system, place = open_path(path)
    found = system.get_file_info(fs.FileSelector(place, allow_not_found=True))
    return [f.base_name for f in found]


def _files(path: str) -> list[tuple[str, dict[str, str | None]]]:
    """The Parquet files below a folder with the values their folders name."""
    system, place = open_path(path)
    out = []
    for info in system.get_file_info(fs.FileSelector(place, recursive=True, allow_not_found=True)):
        if info.type == fs.FileType.File and info.base_name.endswith(".parquet"):
            named = [p.split("=", 1) for p in info.path[len(place) :].split("/")[:-1] if "=" in p]
            values = {unquote(k): None if v == "__HIVE_DEFAULT_PARTITION__" else unquote(v) for k, v in named}
            out.append((info.path, values))
    return sorted(out, key=lambda f: f[0])


@dataclass
class FileOfCommits(InputPartition):
    file: str
    values: dict[str, str | None]
    first: str
    last: str


class Commits(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rowtide_commits"

    def streamReader(self, schema: StructType) -> CommitReader:
        return CommitReader(self.options["path"].rstrip("/"), self.options.get("after", ""), schema)


class CommitReader(DataSourceStreamReader):
    def __init__(self, path: str, after: str, schema: StructType):
        self.path, self.after, self.schema = path, after, schema

    def _entries(self) -> list[Entry]:
        return parse_entries(_names(f"{self.path}/timeline"))

    def initialOffset(self) -> dict:
        return {"commit": self.after}

    def latestOffset(self) -> dict:
        return {"commit": last_instant(self._entries(), COMMITTED) or self.after}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """The files of the commits after ``start`` up to ``end``."""
        entries, after = self._entries(), start["commit"]
        floor = last_instant(entries, TRIMMED)
        if floor is not None and after < floor:
            raise ValueError(f"commits up to {floor} were removed; a stream cannot go on after {after or 'the start'!r}")
        wanted = [e for e in of_action(entries, COMMITTED) if after < e.instant <= end["commit"]]
        joined = of_action(entries, JOINED)[-1:]
        out, covered = [], []
        for entry in wanted:
            files = _files(f"{self.path}/log/{SLICE}={entry.instant}.{entry.attempt}")
            if not files and joined and joined[0].attempt.split(".")[0] <= entry.instant <= joined[0].instant:
                covered.append(entry.instant)  # its own files went when they were joined
            out += [FileOfCommits(f, v, entry.instant, entry.instant) for f, v in files]
        if covered:
            files = _files(f"{self.path}/log/{SLICE}={joined[0].attempt}")
            out += [FileOfCommits(f, v, covered[0], covered[-1]) for f, v in files]
        return out

    def read(self, partition: FileOfCommits) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(self.schema, prefers_large_types=False)
        system, _ = open_path(self.path)
        with system.open_input_file(partition.file) as file:
            for batch in pq.ParquetFile(file).iter_batches(BATCH_ROWS):
                commit = batch.column(COMMIT)
                inside = pc.and_(pc.greater_equal(commit, partition.first), pc.less_equal(commit, partition.last))
                batch = batch.filter(inside)
                columns = []
                for field in target:
                    if field.name in batch.schema.names:
                        columns.append(batch.column(field.name).cast(field.type))
                    else:
                        value = partition.values.get(field.name)
                        columns.append(pa.array([value] * batch.num_rows, pa.string()).cast(field.type))
                yield pa.RecordBatch.from_arrays(columns, schema=target)

    def commit(self, end: dict) -> None:
        """Nothing is kept beside the checkpoint."""
