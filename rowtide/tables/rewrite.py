"""Copy-on-write table: a commit rewrites the slices that hold changed rows and leaves the others alone.

The number of buckets of the record key sets how much a small commit rewrites. ``slices`` says how the data lies; the
``timeline`` says which commits count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.functions.instants import LAST_INSTANT, validate_instant
from rowtide.operators.merge import combine, fold
from rowtide.operators.meta import with_read_meta
from rowtide.spec import COMMIT, DELETED, TableSpec
from rowtide.tables import folders
from rowtide.tables.changes import between
from rowtide.tables.folders import COMMITTED, TRIMMED, Entry
from rowtide.tables.slices import Slices


class RewriteTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        spec: TableSpec,
        buckets: int | None = None,
        file_names: bool = False,
        global_key: bool = False,
    ):
        """``buckets`` is fixed by the first commit; a table that has another number refuses the handle. ``file_names``
        adds ``_file_name``, the file a row is in, to every read. With ``global_key`` a record key is one row in the whole
        table: a record with another partition value moves it. That too is for the life of the table."""
        self.spark, self.path, self.spec = spark, path.rstrip("/"), spec
        self.file_names, self.by_partition = file_names, not global_key
        self.slices = Slices(spark, self.path, spec, buckets, self.by_partition)
        self.data_path = self.slices.data_path
        self.timeline = folders.Timeline(spark, self.path)

    @property
    def buckets(self) -> int:
        return self.slices.buckets

    def apply(
        self, records: DataFrame, commit: str, overwrite: bool = False, max_records_per_file: int = 0, file_bytes: int = 0
    ) -> None:
        """Upsert and delete one batch of records as one commit. Repeating a commit replaces it once it is complete.

        ``overwrite`` replaces the whole table, commits included; the old one can be read until the new one stands, so
        records may come from it. ``max_records_per_file`` caps files by rows, ``file_bytes`` makes them of about that size.
        """
        entries = [] if overwrite else self.timeline.entries()
        folders.check_new_commit(entries, commit)
        attempt = folders.new_attempt()
        records = folders.require_keys(records, self.spec).withColumn(COMMIT, F.lit(commit))
        before = [e for e in folders.of_action(entries, COMMITTED) if e.instant < commit]

        def merge(rows: DataFrame) -> DataFrame:
            # a combined batch has one record per key already
            return fold(rows, self.spec, by_partition=self.by_partition) if before else rows.filter(~F.col(DELETED))

        batch = combine(records, self.spec, self.by_partition)
        self.slices.write(batch, commit, attempt, before, merge, max_records_per_file, file_bytes)
        self.timeline.enter(commit, COMMITTED, attempt, replace=overwrite)
        if overwrite:
            self._clean()

    def commits(self) -> DataFrame:
        """The commits that can be read."""
        return folders.commits_frame(self.spark, self.timeline.entries())

    def _read(self, slices: DataFrame, meta: bool) -> DataFrame:
        rows = self.slices.read(slices, meta or self.file_names)
        return with_read_meta(rows, self.spec) if meta else rows

    def as_of(self, instant: str, meta: bool = False) -> DataFrame:
        """The rows at ``instant``. ``meta`` puts the columns about a row in front, its file included."""
        entries = self.timeline.entries()
        folders.check_kept(entries, instant)
        return self._read(self.slices.newest(folders.of_action(entries, COMMITTED, instant)), meta)

    def snapshot(self, meta: bool = False) -> DataFrame:
        return self.as_of(LAST_INSTANT, meta)

    def incremental(self, begin: str, meta: bool = False) -> DataFrame:
        """Rows of the current table whose last commit is after ``begin``.

        A rewritten row keeps the commit of its last change, and such a row can only be in a slice rewritten after
        ``begin``, so the other slices are not opened.
        """
        validate_instant(begin)
        later = [e for e in folders.of_action(self.timeline.entries(), COMMITTED) if e.instant > begin]
        # the newest version of a slice is after begin if any version is
        return self._read(self.slices.newest(later), meta).filter(F.col(COMMIT) > begin)

    def changes(self, begin: str, end: str = LAST_INSTANT) -> DataFrame:
        """What became of the rows from ``begin`` to ``end``: see ``changes.between``. Only slices that were written
        between the two are opened."""
        entries = self.timeline.entries()
        folders.check_kept(entries, begin)
        before, after = (folders.of_action(entries, COMMITTED, i) for i in (begin, end))
        old, new = (self.slices.read(s) for s in self.slices.changed(before, after))
        return between(old, new, self.spec, self.by_partition)

    def retain(self, keep: int, above: int | None = None) -> str | None:
        """Keep the last ``keep`` commits readable and remove every slice none of them needs. Returns the oldest kept.

        With ``above`` nothing happens until there are more commits than that. Run it while nobody writes or reads an
        older version. The lists of older commits become one, that of the oldest kept.
        """
        commits = folders.of_action(self.timeline.entries(), COMMITTED)
        floor = folders.oldest_kept([e.instant for e in commits], keep, above)
        if floor is None:
            return None
        if commits[0].instant < floor:
            attempt = self.slices.join_lists([e for e in commits if e.instant <= floor], floor)
            self.timeline.enter(floor, COMMITTED, attempt)
        self.timeline.enter(floor, TRIMMED, folders.new_attempt())
        self.timeline.forget([e for e in self.timeline.entries() if e.instant >= floor])
        self._clean()
        return floor

    def _clean(self) -> None:
        """Remove lists and slices that no commit of the timeline needs, those of failed attempts included."""
        entries: list[Entry] = self.timeline.entries()
        self.timeline.forget(entries)
        self.slices.clean(folders.of_action(entries, COMMITTED))
