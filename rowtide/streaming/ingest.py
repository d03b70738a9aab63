"""Stream a change feed into a table or to the console."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rowtide.operators.decode import observe_rejects, parse, with_routing_reason
from rowtide.operators.merge import in_order
from rowtide.operators.route import to_records
from rowtide.spec import COMMIT, COMMIT_DAY, DELETED, POSITION, REFUSED_DAY, REFUSED_REASON, REFUSED_VALUE, SRC_FILE, TableSpec
from rowtide.tables.changelog import ChangelogTable

# Fixed value: how often a stream looks for new events unless told otherwise.
TRIGGER_INTERVAL = "5 seconds"


def stream_records(
    feed: DataFrame,
    spec: TableSpec,
    commit: Column | None = None,
    follow_moves: bool = False,
    rejects: str | None = None,
    lenient: bool = False,
    redelivered_within: str | None = None,
    keep_refused: bool = False,
) -> DataFrame:
    """Records of a streamed feed. One narrow stage: no shuffle and, unless ``redelivered_within`` is given, no state.

    The commit is the time of the micro-batch, which the checkpoint keeps, so a replayed batch gets the same one. A
    ``commit`` column in its place must not fall back to a commit that was compacted already.
    ``rejects`` names an observation that counts refused events per micro-batch. ``lenient`` accepts scalars written
    as text, as ``decode.parse`` does. ``redelivered_within`` drops events that come again within that time, see
    ``drop_redelivered``. ``keep_refused`` keeps refused events for ``start_changelog`` to store beside the records.
    """
    parsed = parse(feed, spec.image, lenient)
    if redelivered_within:
        parsed = drop_redelivered(parsed, redelivered_within)
    if rejects:
        parsed = observe_rejects(with_routing_reason(parsed, spec.scope), rejects)
    return to_records(parsed, spec, commit, follow_moves, keep_refused)


def event_key(parsed: DataFrame) -> Column:
    """What makes an event the same when it is delivered again: its place in the source, else its text and its place in the
    feed, which a second delivery by the same queue keeps."""
    place = F.concat_ws(":", "source.file", F.col("source.pos").cast("string"), F.col("source.row").cast("string"))
    queue = [F.col(c).cast("string") for c in ("topic", "partition", "offset") if c in parsed.columns]
    text = F.sha2(F.concat_ws(":", F.col("value"), F.col("timestamp").cast("string"), *queue).cast("binary"), 256)
    return F.when(F.col("source.file").isNotNull() & F.col("source.pos").isNotNull(), place).otherwise(text)


def drop_redelivered(parsed: DataFrame, within: str) -> DataFrame:
    """Parsed events, each once: of events with the same key the first is kept, if the others come within ``within`` of it
    by the feed's time.

    The state has a row per event of that time and no more. An event that is later than ``within`` behind the newest one is
    dropped, for it can no longer be told from a repeat; ``late_events`` counts those. Batch feeds are compared as a whole.
    """
    keyed = parsed.withColumns({"__event_time": F.timestamp_seconds("timestamp"), "__event_key": event_key(parsed)})
    if parsed.isStreaming:
        once = keyed.withWatermark("__event_time", within).dropDuplicatesWithinWatermark(["__event_key"])
    else:
        once = keyed.dropDuplicates(["__event_key"])
    return once.drop("__event_time", "__event_key")


def late_events(query: StreamingQuery) -> int:
    """How many events the micro-batches that the query still remembers dropped for being late."""
    dropped = {}
    for p in query.recentProgress:
        # a micro-batch may report more than once
        count = sum(state.numRowsDroppedByWatermark for state in p.stateOperators)
        dropped[p.batchId] = max(count, dropped.get(p.batchId, 0))
    return sum(dropped.values())


def _trigger(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """Run every ``interval``, or once over all that is there when it is None."""
    return writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)


def start_changelog(
    records: DataFrame,
    spec: TableSpec,
    path: str,
    checkpoint: str,
    interval: str | None = TRIGGER_INTERVAL,
    files_per_partition: int = 1,
    max_records_per_file: int = 0,
    sink_log_retention: str | None = None,
) -> StreamingQuery:
    """Append records to the log of a ``ChangelogTable(..., streamed=True)`` at ``path``, each exactly once.

    The log has a folder per day of commits, which is what compaction lets readers skip and retention removes. A
    micro-batch writes ``files_per_partition`` files per partition value, for which it is shuffled by partition and
    part of the key; with 0 it is not shuffled, and every task writes a file for every value it has. Move or delete the
    checkpoint and the table only together.

    Refused events that ``stream_records`` kept go to folders of their own by the same sink, so a micro-batch stores both
    or neither, and each once when it is replayed; ``ChangelogTable.refused`` reads them.

    The sink keeps a log of its files. With ``sink_log_retention`` (such as ``"7d"``) it forgets files older than that
    when it joins its log; compact and trim the table more often than that, for what it forgets is no longer read.
    """
    day, key = F.substring(COMMIT, 1, 8), F.xxhash64(*spec.record_key)
    if REFUSED_REASON in records.columns:
        refused = F.col(REFUSED_REASON).isNotNull()
        day = F.when(refused, F.concat(F.lit(REFUSED_DAY), day)).otherwise(day)
        key = F.when(refused, F.xxhash64(REFUSED_VALUE)).otherwise(key)
    records = records.withColumn(COMMIT_DAY, day)
    if files_per_partition:
        records = records.repartition(*spec.partition, F.pmod(key, F.lit(files_per_partition)))
    writer = records.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.option("maxRecordsPerFile", max_records_per_file).partitionBy(COMMIT_DAY, *spec.partition)
    if sink_log_retention:
        writer = writer.option("retention", sink_log_retention)
    return _trigger(writer, interval).start(f"{path.rstrip('/')}/log")


def start_batches(records: DataFrame, table, checkpoint: str, interval: str | None = TRIGGER_INTERVAL):
    """Give each micro-batch as one commit to a ``RewriteTable``, or to a ``ChangelogTable`` that is not streamed: then
    it is combined, has few files and can be compacted and trimmed like batch commits."""
    writer = records.writeStream.option("checkpointLocation", checkpoint)
    return _trigger(writer.foreachBatch(lambda batch, number: apply_batch(table, batch, number)), interval).start()


def apply_batch(table, batch: DataFrame, number: int) -> None:
    """One micro-batch into a stored table.

    The commit is the one its records carry, the same for all. A batch replayed after a failure has the same and
    replaces itself.
    """
    batch = batch.persist()
    try:
        first, last = batch.agg(F.min(COMMIT), F.max(COMMIT)).first()
        if first != last:
            raise ValueError(f"a micro-batch is one commit, this one has records of {first} and {last}")
        if last is not None:
            put = table.append if isinstance(table, ChangelogTable) else table.apply
            put(batch, last)
    finally:
        batch.unpersist()


def start_console(
    records: DataFrame, interval: str | None = TRIGGER_INTERVAL, rows: int = 20
) -> StreamingQuery:
    """Print the first ``rows`` records of each micro-batch, their values in full. Keeps no checkpoint."""
    writer = records.writeStream.format("console").outputMode("append").option("truncate", "false")
    return _trigger(writer.option("numRows", rows), interval).start()


def run_refreshing(start: Callable[[], StreamingQuery], seconds: float, rounds: int) -> None:
    """Start a query, stop it after ``seconds``, and start it again from its checkpoint, ``rounds`` times."""
    for _ in range(rounds):
        query = start()
        try:
            query.awaitTermination(seconds)
        finally:
            query.stop()


def live_view(records: DataFrame, spec: TableSpec) -> DataFrame:
    """The event-ordered fold as streaming state: one row per key, updated with every micro-batch.

    The state grows with the number of keys. Deleted keys stay, marked, so that late events cannot revive them; filter
    on ``is_deleted`` in complete mode. ``expiring_view`` forgets them after a time.
    """
    rest = [c for c in records.columns if c not in spec.scope]
    order = F.struct(*(c.alias(f"o{i}") for i, c in enumerate(in_order((spec.order_by, *POSITION)))))
    newest = F.max_by(F.struct(*rest), order).alias("newest")
    return records.groupBy(*spec.scope).agg(newest).select(*spec.scope, "newest.*")


class NewestRecord:
    """The function of ``expiring_view``: a key's records of a micro-batch and its state to the rows to put out."""

    def __init__(self, spec: TableSpec, names: list[str], whole: set[str], forget_deleted: int, forget_idle: int | None):
        self.scope, self.names, self.whole, self.order_by = spec.scope, names, whole, spec.order_by
        self.forget_deleted, self.forget_idle = forget_deleted, forget_idle

    def _rank(self, record: dict) -> tuple:
        """What ``merge.in_order`` compares, nulls lowest."""
        file = record[SRC_FILE]
        number = int(file.rsplit(".", 1)[1]) if file and file.rsplit(".", 1)[-1].isdigit() and "." in file else None
        values = [record[self.order_by], number, file, *(record[c] for c in POSITION[1:])]
        return tuple((v is not None, v if v is not None else 0 if i != 2 else "") for i, v in enumerate(values))

    def _keep_until(self, record: dict, now: int) -> int | None:
        """When to forget a record, in epoch milliseconds."""
        span = self.forget_deleted if record[DELETED] else self.forget_idle
        return None if span is None else now + span

    def __call__(self, key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rest = [n for n in self.names if n not in self.scope]
        newest = dict(zip(rest, state.get)) | dict(zip(self.scope, key)) if state.exists else None
        known, latest = newest, 0
        for frame in batches:
            latest = max(latest, int(frame["__millis"].max()))
            plain = frame[self.names].astype(object).where(frame[self.names].notna(), None)
            for record in plain.to_dict("records"):
                # a frame turns whole numbers with nulls among them into floating point
                record = {n: int(v) if v is not None and n in self.whole else v for n, v in record.items()}
                if newest is None or self._rank(record) > self._rank(newest):
                    newest = record
        until = self._keep_until(newest, max(latest, state.getCurrentWatermarkMs()))
        state.update(tuple(newest[n] for n in rest))
        if until is not None:
            state.setTimeoutTimestamp(until)
        if newest is not known:
            yield pd.DataFrame([newest], columns=self.names)


def expiring_view(
    records: DataFrame, spec: TableSpec, event_time: Column, late: str, forget_deleted: int, forget_idle: int | None = None
) -> DataFrame:
    """The event-ordered fold as streaming state that forgets: in update mode, a row per key that changed.

    A deleted key is held for ``forget_deleted`` milliseconds after its last record, by ``event_time``, so that late records
    cannot revive it, and a live one for ``forget_idle`` (None: for ever). The watermark runs ``late`` behind the newest
    event; a record that is later finds its state perhaps gone. Deleted keys are put out with ``is_deleted`` set. Records
    go to Python in Arrow batches by key; the state of a key is one record.
    """
    names = [f.name for f in records.schema.fields if f.name in spec.record_schema.fieldNames()]
    kinds = {f.name: f.dataType.simpleString() for f in records.schema.fields}
    timed = records.select(*names, event_time.cast("timestamp").alias("__time")).withColumn("__millis", F.unix_millis("__time"))
    whole = {f.name for f in records.schema.fields if isinstance(f.dataType, T.IntegralType)}
    run = NewestRecord(spec, names, whole, forget_deleted, forget_idle)
    return timed.withWatermark("__time", late).groupBy(*spec.scope).applyInPandasWithState(
        run,
        ", ".join(f"`{n}` {kinds[n]}" for n in names),
        ", ".join(f"`{n}` {kinds[n]}" for n in names if n not in spec.scope),
        "update",
        GroupStateTimeout.EventTimeTimeout,
    )
