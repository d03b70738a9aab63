"""Merge-on-read table: records are appended and folded when they are read.

Layout below the table path: ``log/_slice=<commit>.<attempt>/<partition>=<value>/`` for batch commits, the base of
compactions in ``slices`` (see there), and ``timeline/``. Readers open the folders the timeline names and no others. A log
written by a stream belongs to its own sink; its folders are ``log/_commit_day=<day>/<partition>=<value>/``.

A compaction rewrites the slices that the log has records for; the others stay as they are, files included. A read takes
the base as it lies and joins it with the keys of the log since then: broadcast if a count has shown that they are few, so
the base is not shuffled; else only slices the log has records for are folded and the others pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.functions import lists
from rowtide.functions.instants import LAST_INSTANT, pad_instant, validate_instant
from rowtide.operators.merge import combine, fold
from rowtide.operators.meta import FILE_NAME, with_file_name, with_read_meta
from rowtide.spec import COMMIT, COMMIT_DAY, DELETED, REFUSED_DAY, REFUSED_REASON, REFUSED_VALUE, TableSpec
from rowtide.tables import folders, sizing
from rowtide.tables.changes import between
from rowtide.tables.folders import COMMITTED, COMPACTED, JOINED, SLICE, TRIMMED, Entry
from rowtide.tables.slices import Slices


class LateCommit(ValueError):
    """Records arrived for a commit that was compacted before."""


@dataclass(frozen=True)
class Joined:
    """A folder of the log with the commits from ``first`` to ``last``."""

    first: str
    last: str
    folder: str

    def covers(self, commit: str) -> bool:
        return self.first <= commit <= self.last


class ChangelogTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        spec: TableSpec,
        policy: str = "commit",
        streamed: bool = False,
        file_names: bool = False,
        buckets: int | None = None,
        global_key: bool = False,
    ):
        """``streamed``: the log is written by a stream. ``file_names`` adds ``_file_name`` to every read. ``buckets`` of
        the record key per partition value, fixed by the first compaction, set how much a compaction rewrites for few
        changes. With ``global_key`` a record key is one row in the whole table, whatever its partition value; that is for
        the life of the table."""
        self.spark, self.path, self.spec, self.policy, self.streamed = spark, path.rstrip("/"), spec, policy, streamed
        self.file_names, self.by_partition = file_names, not global_key
        self.key = spec.scope if self.by_partition else spec.record_key
        self.log_path = f"{self.path}/log"
        self.timeline = folders.Timeline(spark, self.path)
        self.slices = Slices(spark, f"{self.path}/base", spec, buckets, self.by_partition)
        self.base_path = self.slices.data_path

    # --- writing

    def append(
        self,
        records: DataFrame,
        commit: str,
        combine_first: bool = True,
        max_records_per_file: int = 0,
        file_bytes: int = 0,
    ) -> None:
        """Add one commit. Repeating a commit replaces it once the repeat is complete, so a failed job can run again.

        ``combine_first`` stores one record per key. Without it nothing is shuffled and readers do the combining; the
        rows read are the same. ``max_records_per_file`` caps files by rows, ``file_bytes`` makes them of about that size.
        """
        self._check_new(self.timeline.entries(), [commit])
        batch = folders.require_keys(records, self.spec).withColumn(COMMIT, F.lit(commit))
        attempt = folders.new_attempt()
        if combine_first:
            batch = combine(batch, self.spec, self.by_partition)
        if file_bytes:
            batch = self._sized(batch, file_bytes, attempt)
        elif combine_first:
            batch = batch.hint("rebalance", *self.spec.partition)
        self._write(batch, f"{self.log_path}/{SLICE}={commit}.{attempt}", max_records_per_file)
        self.timeline.enter(commit, COMMITTED, attempt)
        folders.remove(self.spark, f"{self.path}/pending/{attempt}")

    def _sized(self, rows: DataFrame, file_bytes: int, attempt: str) -> DataFrame:
        """The rows, stored once and dealt to files of about a size."""
        pending = f"{self.path}/pending/{attempt}"
        rows.select(*self.spec.record_schema.fieldNames()).write.parquet(f"{pending}/rows")
        rows = self.spark.read.schema(self.spec.record_schema).parquet(f"{pending}/rows")
        # rows of a key keep their order of commits in a file, which its statistics serve
        dealt = sizing.deal(rows, self.spec.partition, [*self.spec.record_key, COMMIT], file_bytes, f"{pending}/trial")
        return dealt.sortWithinPartitions(*self.spec.partition, COMMIT)

    def join_files(self, file_bytes: int) -> str | None:
        """Write the log since the last base anew, in files of about ``file_bytes`` per partition value whatever commits
        they are of, and read it from there. Returns the folder, None if there is nothing to join.

        The commits stay what they were, each can be read as before; the old files go with the next ``retain``. Reads
        that began before go on with them. Those commits cannot be repeated afterwards.
        """
        self._check_batches_allowed()
        entries = self.timeline.entries()
        base = folders.last_instant(entries, COMPACTED) or ""
        commits = [e.instant for e in folders.of_action(entries, COMMITTED) if e.instant > base]
        if len(commits) < 2:
            return None
        attempt = folders.new_attempt()
        path = f"{self.log_path}/{SLICE}={commits[0]}.{attempt}"
        self._write(self._sized(self._log(entries, commits[-1], False), file_bytes, attempt), path, 0)
        self.timeline.enter(commits[-1], JOINED, f"{commits[0]}.{attempt}")
        folders.remove(self.spark, f"{self.path}/pending/{attempt}")
        return path

    def append_history(self, records: DataFrame, max_records_per_file: int = 0) -> None:
        """Add many commits at once, each record under the commit it carries. They become visible one after another,
        oldest first; running it again replaces them. None becomes visible if one of them is before the last commit and
        new, or is compacted already."""
        self._check_batches_allowed()
        attempt, log = folders.new_attempt(), self.log_path
        batch = combine(folders.require_keys(records, self.spec), self.spec, self.by_partition)
        batch = batch.withColumn(SLICE, F.concat(COMMIT, F.lit(f".{attempt}")))
        # one shuffle more, so that a task writes to few folders; adaptive execution splits the large ones
        batch = batch.hint("rebalance", SLICE, *self.spec.partition)
        self._write(batch, log, max_records_per_file, SLICE, mode="append")
        names = [n.removeprefix(f"{SLICE}=") for n in folders.children(self.spark, log) if n.endswith(f".{attempt}")]
        commits = [n.split(".")[0] for n in names]
        entries = self.timeline.entries()
        self._check_new(entries, commits, known={e.instant for e in folders.of_action(entries, COMMITTED)})
        self.timeline.enter_all(commits, COMMITTED, attempt)

    def _write(self, rows: DataFrame, path: str, max_records_per_file: int, *folder: str, mode: str = "error") -> None:
        writer = rows.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
        if folder or self.spec.partition:
            writer = writer.partitionBy(*folder, *self.spec.partition)
        writer.parquet(path)

    def _check_batches_allowed(self) -> None:
        if self.streamed:
            raise ValueError("this log belongs to a stream; batch commits would be hidden by its sink")

    def _check_new(self, entries: list[Entry], commits: list[str], known: set[str] = frozenset()) -> None:
        self._check_batches_allowed()
        final = {a: folders.last_instant(entries, a) or "" for a in (COMPACTED, JOINED)}
        for commit in commits:
            if commit not in known:
                folders.check_new_commit(entries, commit)
            for action, instant in final.items():
                if commit <= instant:
                    raise ValueError(f"commit {commit} is already {action}")

    # --- reading

    def commits(self) -> DataFrame:
        """The commits that can be read."""
        entries = self.timeline.entries()
        if not self.streamed:
            return folders.commits_frame(self.spark, entries)
        floor = folders.last_instant(entries, TRIMMED)
        log = self._streamed_log(floor or "", "")
        return log.filter(F.col(COMMIT) >= (floor or "")).select(COMMIT).distinct()

    def _last_instants(self, entries: list[Entry], count: int, until: str = LAST_INSTANT) -> list[str]:
        """The last ``count`` commits up to an instant, oldest first. Of a streamed log only the last days are opened."""
        if not self.streamed:
            return [e.instant for e in folders.of_action(entries, COMMITTED, until)][-count:]
        floor, last = folders.last_instant(entries, TRIMMED) or "", pad_instant(until)
        days = [n.removeprefix(f"{COMMIT_DAY}=") for n in folders.children(self.spark, self.log_path) if n.startswith(COMMIT_DAY)]
        days = sorted(d for d in days if floor[:8] <= d <= last[:8])
        found: list[str] = []
        opened = 1
        while days and len(found) < count:
            # twice as many days each time: a table with a commit a day needs few rounds as well
            days, part = days[:-opened], days[-opened:]
            opened *= 2
            log = self._streamed_log(part[0], part[-1]).filter((F.col(COMMIT) >= floor) & (F.col(COMMIT) <= last))
            newest = log.select(COMMIT).distinct().orderBy(F.desc(COMMIT)).limit(count - len(found)).collect()
            found = [r[COMMIT] for r in reversed(newest)] + found
        return found

    def _scan(self, paths: list[str], parent: str, names: bool) -> DataFrame:
        schema = self.spec.record_schema
        if not paths:
            empty = self.spark.createDataFrame([], schema)
            return empty.withColumn(FILE_NAME, F.lit(None).cast("string")) if names else empty
        stored = self.spark.read.schema(schema).option("basePath", parent).parquet(*paths)
        columns = schema.fieldNames()
        if names:
            stored, columns = with_file_name(stored), [*columns, FILE_NAME]
        return stored.select(*columns)

    def _streamed_log(self, first: str, last: str, names: bool = False, files: list[str] | None = None) -> DataFrame:
        """The streamed log of the days of two instants and between them; an empty text is no bound. With ``files``, of
        those files alone."""
        if files == [] or not folders.exists(self.spark, self.log_path):
            return self._scan([], self.log_path, names)
        schema = T.StructType([*self.spec.record_schema.fields, T.StructField(COMMIT_DAY, T.StringType())])
        reader = self.spark.read.schema(schema)
        stored = reader.option("basePath", self.log_path).parquet(*files) if files else reader.parquet(self.log_path)
        day = F.col(COMMIT_DAY)
        if first:
            stored = stored.filter(day >= first[:8])
        # what was refused lies in folders after all days
        stored = stored.filter(day <= last[:8]) if last else stored.filter(day < REFUSED_DAY)
        columns = self.spec.record_schema.fieldNames()
        if names:
            stored, columns = with_file_name(stored), [*columns, FILE_NAME]
        return stored.select(*columns)

    def records(self, instant: str = LAST_INSTANT) -> DataFrame:
        """The records that decide the table at ``instant``: the last base up to it, and the log since that base."""
        entries = self.timeline.entries()
        folders.check_kept(entries, instant)
        bases, log = self._base(entries, instant), self._log(entries, instant, self.file_names)
        return self.slices.read(self.slices.newest(bases), self.file_names).unionByName(log) if bases else log

    def refused(self) -> DataFrame:
        """``_commit_time, _refused_reason, _refused_value``: what a stream with ``keep_refused`` did not take."""
        schema = T.StructType(
            [T.StructField(c, T.StringType()) for c in (COMMIT, REFUSED_REASON, REFUSED_VALUE, COMMIT_DAY)]
        )
        if not self.streamed or not folders.exists(self.spark, self.log_path):
            return self.spark.createDataFrame([], schema).drop(COMMIT_DAY)
        stored = self.spark.read.schema(schema).parquet(self.log_path).filter(F.col(COMMIT_DAY) >= REFUSED_DAY)
        return stored.select(COMMIT, REFUSED_REASON, REFUSED_VALUE)

    @staticmethod
    def _base(entries: list[Entry], instant: str) -> list[Entry]:
        """The compactions that make up the base at an instant."""
        return folders.of_action(entries, COMPACTED, instant)

    def _log(self, entries: list[Entry], instant: str, names: bool, after: str | None = None) -> DataFrame:
        """The log up to an instant, from the base before it (or after another instant)."""
        bases = self._base(entries, instant)
        start = after if after is not None else bases[-1].instant if bases else ""
        if not self.streamed:
            wanted = [e for e in folders.of_action(entries, COMMITTED, instant) if e.instant > start]
            joined = self._joined(entries)
            if joined is None or not any(joined.covers(e.instant) for e in wanted):
                return self._scan([self._folder(self.log_path, e) for e in wanted], self.log_path, names)
            paths = [f"{self.log_path}/{joined.folder}"]
            paths += [self._folder(self.log_path, e) for e in wanted if not joined.covers(e.instant)]
            # its files may have rows of commits before and after those wanted
            log = self._scan(paths, self.log_path, names)
            return log.filter((F.col(COMMIT) > start) & (F.col(COMMIT) <= wanted[-1].instant))
        log = self._streamed_log(start, pad_instant(instant), names)
        log = log.filter((F.col(COMMIT) > start) & (F.col(COMMIT) <= pad_instant(instant)))
        late = self._late(bases[-1], names) if bases and after is None else None
        return log if late is None else log.unionByName(late)

    @staticmethod
    def _joined(entries: list[Entry]) -> Joined | None:
        """What the last ``join_files`` wrote; it has the commits of those before it that no base has."""
        found = folders.of_action(entries, JOINED)
        return Joined(found[-1].attempt.split(".")[0], found[-1].instant, f"{SLICE}={found[-1].attempt}") if found else None

    @staticmethod
    def _folder(parent: str, entry: Entry) -> str:
        return f"{parent}/{SLICE}={entry.instant}.{entry.attempt}"

    def _current(self, entries: list[Entry], instant: str, names: bool) -> DataFrame:
        """The rows at an instant, those of the base and the log merged."""
        folders.check_kept(entries, instant)
        bases, log = self._base(entries, instant), self._log(entries, instant, names)
        if not bases:
            return fold(log, self.spec, self.policy, self.by_partition)
        newest = self.slices.newest(bases)
        touched = log.select(*self.key).distinct()
        if touched.limit(lists.SHORT_LIST + 1).count() <= lists.SHORT_LIST:
            # a base holds a key once, so what the log does not name is current
            base, touched = self.slices.read(newest, names), F.broadcast(touched)
            untouched = base.join(touched, [*self.key], "left_anti")
            if self.policy == "event":
                log = base.join(touched, [*self.key], "left_semi").select(*log.columns).unionByName(log)
        else:
            slices = log.withColumn("_bucket", self.slices.bucket()).select(*self.slices.key).distinct()
            both = newest.alias("a").join(slices.alias("b"), self.slices.same("a", "b"), "left_semi")
            none = newest.alias("a").join(slices.alias("b"), self.slices.same("a", "b"), "left_anti")
            untouched, log = self.slices.read(none, names), self.slices.read(both, names).unionByName(log)
        changed = fold(log, self.spec, self.policy, self.by_partition)
        return untouched.filter(~F.col(DELETED)).select(*changed.columns).unionByName(changed)

    def base_folders(self) -> DataFrame:
        """The folder columns of the last base: attempt, slice and partition values."""
        return self.slices.folders(self.slices.newest(self._base(self.timeline.entries(), LAST_INSTANT)))

    def snapshot(self, meta: bool = False) -> DataFrame:
        """The current rows. ``meta`` puts the columns about a row in front, its file included."""
        return self.as_of(LAST_INSTANT, meta)

    def as_of(self, instant: str, meta: bool = False) -> DataFrame:
        return self._shown(self._current(self.timeline.entries(), instant, meta or self.file_names), meta)

    def incremental(self, begin: str, meta: bool = False) -> DataFrame:
        entries, names = self.timeline.entries(), meta or self.file_names
        after = F.col(COMMIT) > validate_instant(begin)
        if self.policy == "commit" and not (folders.last_instant(entries, COMPACTED) or "") > begin:
            # nothing up to begin can be the answer, so neither a base nor its part of the log is opened
            log = self._log(entries, LAST_INSTANT, names, after=begin)
            return self._shown(fold(log.filter(after), self.spec, self.policy, self.by_partition), meta)
        return self._shown(self._current(entries, LAST_INSTANT, names).filter(after), meta)

    def changes(self, begin: str, end: str = LAST_INSTANT) -> DataFrame:
        """What became of the rows from ``begin`` to ``end``: see ``changes.between``.

        Only keys with a record between the two are compared; the rest of both versions is dropped before the join.
        """
        entries = self.timeline.entries()
        validate_instant(begin)
        folders.check_kept(entries, begin)
        keys = self._log(entries, end, False, after=pad_instant(begin)).select(*self.key).distinct()
        keys = lists.broadcast_if_short(keys)
        old, new = (self._current(entries, i, False).join(keys, [*self.key], "left_semi") for i in (begin, end))
        return between(old, new, self.spec, self.by_partition)

    def _shown(self, rows: DataFrame, meta: bool) -> DataFrame:
        return with_read_meta(rows, self.spec) if meta else rows

    # --- streamed logs: records that come after their commit was compacted

    def _sink_batch(self) -> int:
        """The number of the last micro-batch that the sink has entered, -1 if none."""
        names = folders.children(self.spark, f"{self.log_path}/_spark_metadata")
        return max((int(n.removesuffix(".compact")) for n in names if n.removesuffix(".compact").isdigit()), default=-1)

    def _sink_files(self, until: str) -> dict[str, str]:
        """Files of the streamed log with commits of the days up to an instant, by name. Their number is what the sink's
        own log lists on the driver."""
        if not folders.exists(self.spark, self.log_path):
            return {}
        found = {}
        for path in self.spark.read.schema(self.spec.record_schema).parquet(self.log_path).inputFiles():
            day = next((p.removeprefix(f"{COMMIT_DAY}=") for p in path.split("/") if p.startswith(f"{COMMIT_DAY}=")), "")
            if day <= until[:8]:
                found[path.rsplit("/", 1)[1]] = path
        return found

    def _folded_path(self, base: Entry) -> str:
        return f"{self.path}/folded/{base.instant}.{base.attempt}"

    def _late(self, base: Entry, names: bool) -> DataFrame | None:
        """Records of commits up to a base that came after it was made.

        Under ``policy="event"`` they take part in the fold, as if they had come in time: the base keeps deletes. Under
        ``policy="commit"`` it does not, so what they would have met is unknown and the read fails.
        """
        noted = [n for n in folders.children(self.spark, self._folded_path(base)) if n.startswith("batch=")]
        if not noted or int(noted[0].removeprefix("batch=")) == self._sink_batch():
            return None
        known = {r["value"] for r in self.spark.read.text(f"{self._folded_path(base)}/files").collect()}
        newer = [path for name, path in self._sink_files(base.instant).items() if name not in known]
        if not newer:
            return None
        late = self._streamed_log("", base.instant, names, newer).filter(F.col(COMMIT) <= base.instant)
        if self.policy == "event":
            return late
        found, first = late.agg(F.count(F.lit(1)), F.min(COMMIT)).first()
        if found:
            raise LateCommit(
                f"{found} records from commit {first} on came after {base.instant} was compacted; reopen({first!r}) folds them in"
            )
        return None

    def reopen(self, commit: str) -> None:
        """Give up the bases at ``commit`` and after it, so that reads and the next compaction fold the log since the base
        before. Only while the log from there on is kept."""
        entries = self.timeline.entries()
        floor = folders.last_instant(entries, TRIMMED)
        if floor is not None and commit <= floor:
            raise LateCommit(f"versions before {floor} were removed, so records of {commit} cannot be folded in")
        self.timeline.forget([e for e in entries if not (e.action == COMPACTED and e.instant >= commit)])

    # --- compaction and retention

    def compact_after(self, delta_commits: int) -> bool:
        """Compact at the last commit if that many commits came since the last base."""
        entries = self.timeline.entries()
        base = folders.last_instant(entries, COMPACTED) or ""
        if sum(i > base for i in self._last_instants(entries, delta_commits)) < delta_commits:
            return False
        self.compact(LAST_INSTANT)
        return True

    def compact(self, instant: str, max_records_per_file: int = 0) -> str | None:
        """Make the base at the last commit up to ``instant``, from the base before it and the log between the two.

        Slices without records in that log are carried over as they are. Returns the list of the slices written, None if
        nothing was committed.
        """
        entries = self.timeline.entries()
        upto = next(iter(self._last_instants(entries, 1, instant)), None)
        bases = self._base(entries, instant)
        if upto is None or (bases and bases[-1].instant >= upto):
            return f"{self.slices.lists_path}/{bases[-1].instant}.{bases[-1].attempt}" if bases else None
        attempt = folders.new_attempt()
        if self.streamed:
            # noted before the log is read: what comes meanwhile counts as late, if it has such a commit
            batch, files = self._sink_batch(), self._sink_files(upto)
            log = self._streamed_log("", upto, files=[*files.values()]).filter(F.col(COMMIT) <= upto)
            log = log.filter(F.col(COMMIT) > bases[-1].instant) if bases else log
            late = self._late(bases[-1], False) if bases else None
            log = log if late is None else log.unionByName(late)
        else:
            log = self._log(entries, upto, False)
        # late events of an event-ordered table may still meet a delete, so its base keeps them
        deletes = self.policy == "event"
        folded = fold(log, self.spec, self.policy, self.by_partition, keep_deletes=True)

        def merge(rows: DataFrame) -> DataFrame:
            if bases:
                return fold(rows, self.spec, self.policy, self.by_partition, keep_deletes=deletes)
            return rows if deletes else rows.filter(~F.col(DELETED))

        listed = self.slices.write(folded, upto, attempt, bases, merge, max_records_per_file)
        if self.streamed:
            made = Entry(0, upto, COMPACTED, attempt)
            known = self.spark.createDataFrame([(n,) for n in files], "value string")
            known.coalesce(1).write.text(f"{self._folded_path(made)}/files")
            folders.create(self.spark, f"{self._folded_path(made)}/batch={batch}")
        self.timeline.enter(upto, COMPACTED, attempt)
        return listed

    def retain(self, keep: int, above: int | None = None) -> str | None:
        """Keep the last ``keep`` commits readable and remove what only older ones need. Returns the oldest kept.

        With ``above`` nothing happens until there are more commits than that. Run it while nobody writes or reads an
        older version. Of a streamed log whole days go, and what was refused on them.
        """
        instants = self._last_instants(self.timeline.entries(), max(keep, (above or 0) + 1))
        floor = folders.oldest_kept(instants, keep, above)
        if floor is None:
            return None
        self.compact(floor)
        bases = self._base(self.timeline.entries(), floor)
        if len(bases) > 1:
            # older compactions become one, that of the oldest kept; a stream's notes on its files go along
            joined = Entry(0, floor, COMPACTED, self.slices.join_lists(bases, floor))
            if self.streamed:
                folders.rename(self.spark, self._folded_path(bases[-1]), self._folded_path(joined))
            self.timeline.enter(floor, COMPACTED, joined.attempt)
        self.timeline.enter(floor, TRIMMED, folders.new_attempt())
        kept = [
            e
            for e in self.timeline.entries()
            if e.instant >= floor and not (e.action == TRIMMED and e.instant > floor)
        ]
        self.timeline.forget(kept)
        # the log of the floor itself is in its base
        joined = self._joined(kept)
        live = {joined.folder} if joined and joined.last > floor else set()
        live |= {
            f"{SLICE}={e.instant}.{e.attempt}"
            for e in kept
            if e.action == COMMITTED and e.instant > floor and not (joined and joined.covers(e.instant))
        }
        gone = []
        for name in folders.children(self.spark, self.log_path):
            superseded = name.startswith(f"{SLICE}=") and name not in live
            day = name.removeprefix(f"{COMMIT_DAY}=").removeprefix(REFUSED_DAY)
            if superseded or name.startswith(f"{COMMIT_DAY}=") and day < floor[:8]:
                gone.append(f"{self.log_path}/{name}")
        notes = {f"{e.instant}.{e.attempt}" for e in kept if e.action == COMPACTED}
        gone += [f"{self.path}/folded/{n}" for n in folders.children(self.spark, f"{self.path}/folded") if n not in notes]
        folders.remove_all(self.spark, gone)
        self.slices.clean(folders.of_action(kept, COMPACTED))
        return floor
