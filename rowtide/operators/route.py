"""From change events to records: operation filter, image choice, delete marker, partition moves.

All of it is one pass: a union of an upsert branch and a delete branch would read the feed twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.functions.instants import current_instant
from rowtide.operators import decode as d
from rowtide.spec import COMMIT, DELETED, REFUSED_REASON, REFUSED_VALUE, SRC_FILE, SRC_POS, SRC_ROW, TableSpec


def upserts(events: DataFrame) -> DataFrame:
    """Decoded events that insert or replace a row."""
    return events.filter(F.col("op").isin(*d.UPSERT_OPS))


def deletes(events: DataFrame) -> DataFrame:
    """Decoded events that remove a row."""
    return events.filter(F.col("op").isin(*d.DELETE_OPS))


def partition_moves(events: DataFrame, spec: TableSpec) -> DataFrame:
    """Updates that change the partition of their row."""
    return events.filter((F.col("op") == "u") & _moved(spec))


def _moved(spec: TableSpec) -> Column:
    before, after = F.col("before"), F.col("after")
    moved = F.lit(False)
    for column in spec.partition:
        moved = moved | (before[column] != after[column])
    # without an old key there is no old row to remove
    for column in spec.scope:
        moved = moved & before[column].isNotNull() & after[column].isNotNull()
    return moved


def _with_commit(events: DataFrame, commit: Column | str | None) -> DataFrame:
    if commit is None:
        commit = current_instant()
    elif isinstance(commit, str):
        commit = F.lit(commit)
    return events.withColumn(COMMIT, commit)


def to_records(
    parsed: DataFrame,
    spec: TableSpec,
    commit: Column | str | None = None,
    follow_moves: bool = False,
    keep_refused: bool = False,
) -> DataFrame:
    """Records of parsed events (``decode.parse`` or ``decode.decode``).

    A record has the image columns, ``is_deleted``, the position in the source (or in the feed) and ``_commit_time``. Events with another
    operation or an incomplete key are left out; ``decode.quarantine`` returns them. ``commit`` is a column over the
    events, an instant, or None for the time of the running batch. With ``follow_moves`` an update that changes the
    partition also deletes the row in the old partition. With ``keep_refused`` the events left out are rows too: without
    image, with the reason and the raw text in ``_refused_reason`` and ``_refused_value``.
    """
    if "reason" not in parsed.columns:
        parsed = parsed.withColumn("reason", F.lit(d.OK))
    routed = _with_commit(d.with_routing_reason(parsed, spec.scope), commit)
    op, more = F.col("op"), []
    if keep_refused:
        refused = F.col("reason") != d.OK
        more = [F.when(refused, F.col("reason")).alias(REFUSED_REASON), F.when(refused, F.col("value")).alias(REFUSED_VALUE)]
        routed = routed.withColumns({c: F.when(~refused, F.col(c)) for c in ("op", "before", "after")})
    else:
        routed = routed.filter(F.col("reason") == d.OK)
    own = _record(d.image_of(op, F.col("before"), F.col("after")), op.isin(*d.DELETE_OPS), spec)
    if follow_moves and spec.partition:
        left_behind = F.struct(*_record(F.col("before"), F.lit(True), spec))
        both = F.when((op == "u") & _moved(spec), F.array(F.struct(*own), left_behind))
        own = [F.inline(both.otherwise(F.array(F.struct(*own))))]
    return routed.select(*own, *_position(parsed), COMMIT, *more)


def _position(parsed: DataFrame) -> list[Column]:
    """Where a change stood in its source. Events without a ``source`` block take their place in the feed, if the feed
    has one: partition and offset."""
    file, pos = F.col("source.file"), F.col("source.pos")
    if "offset" in parsed.columns:
        placeless = file.isNull() & pos.isNull()
        pos = F.when(placeless, F.col("offset").cast("long")).otherwise(pos)
        if "partition" in parsed.columns:
            file = F.when(placeless, F.concat(F.lit("partition."), F.col("partition").cast("string"))).otherwise(file)
    return [file.alias(SRC_FILE), pos.alias(SRC_POS), F.col("source.row").alias(SRC_ROW)]


def _record(row: Column, deleted: Column, spec: TableSpec) -> list[Column]:
    return [*(row[c].alias(c) for c in spec.columns), deleted.alias(DELETED)]
