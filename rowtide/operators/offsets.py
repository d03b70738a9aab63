"""Feed positions: start and end arguments, offsets for a time, replay windows.

A landed feed is a DataFrame with ``partition``, ``offset`` and ``timestamp`` (epoch seconds).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.functions.epoch import normalize_epoch, to_millis
from rowtide.functions.lists import SHORT_LIST

# Start and end arguments.
LATEST, EARLIEST = -1, -2


@dataclass(frozen=True)
class Position:
    """``kind`` is ``earliest``, ``latest`` or ``time``; ``millis`` is set for a time."""

    kind: str
    millis: int | None = None


def start_position(argument: int) -> Position:
    """A positive argument is a time in seconds or milliseconds, -2 the earliest offset, anything else the latest."""
    if argument > 0:
        return Position("time", to_millis(argument))
    return Position("earliest" if argument == EARLIEST else "latest")


def end_position(argument: int) -> Position:
    """A positive argument is a time, anything else the latest offset."""
    return Position("time", to_millis(argument)) if argument > 0 else Position("latest")


def is_bounded(start: int, end: int) -> bool:
    """A scan is bounded when it has an end time that is after its start."""
    return end > 0 and to_millis(end) > (to_millis(start) if start > 0 else start)


def _feed_partition(feed: DataFrame) -> list[str]:
    return [c for c in ("topic", "partition") if c in feed.columns]


def _at_or_after(millis: Column, in_seconds: Column, bound: int) -> Column:
    """A feed in whole seconds has cut its messages' times down, so its bound is cut down as well."""
    return millis >= F.when(in_seconds, bound // 1000 * 1000).otherwise(bound)


def offsets_for(feed: DataFrame, start: int, end: int) -> DataFrame:
    """``[topic,] partition, lo, hi``: offsets of a replay window, one row per feed partition.

    A time becomes the first offset at or after it, or the end of the partition if there is none.
    """
    millis = normalize_epoch(F.col("timestamp"))
    in_seconds = millis != F.col("timestamp")
    past_end = F.max("offset") + 1

    def bound(position: Position) -> Column:
        if position.kind == "earliest":
            return F.min("offset")
        if position.kind == "latest":
            return past_end
        return F.coalesce(F.min(F.when(_at_or_after(millis, in_seconds, position.millis), F.col("offset"))), past_end)

    return feed.groupBy(*_feed_partition(feed)).agg(
        bound(start_position(start)).alias("lo"), bound(end_position(end)).alias("hi")
    )


def offsets_json(feed: DataFrame, time: int) -> DataFrame:
    """``topic, offsets``: per topic a JSON map from partition to the first offset at or after ``time``, -1 if none.

    This is the form the offset options of a message-queue reader take. A group here is the partitions of one topic,
    one small row each.
    """
    millis = normalize_epoch(F.col("timestamp"))
    in_seconds = millis != F.col("timestamp")
    found = F.min(F.when(_at_or_after(millis, in_seconds, to_millis(time)), F.col("offset")))
    first = feed.groupBy("topic", "partition").agg(F.coalesce(found, F.lit(LATEST)).alias("offset"))
    entry = F.struct(F.col("partition").cast("string").alias("key"), F.col("offset").alias("value"))
    entries = F.map_from_entries(F.sort_array(F.collect_list(entry)))
    return first.groupBy("topic").agg(F.to_json(entries).alias("offsets"))


def replay_window(feed: DataFrame, start: int, end: int) -> DataFrame:
    """The feed rows with ``lo <= offset < hi``.

    The bounds are one row per feed partition, joined with the feed. Their outer limits, two numbers, become a literal
    filter that reaches the scan of a landed feed. Topic and partition may be null, which is a place like any other.
    """
    by = _feed_partition(feed)
    bounds = offsets_for(feed, start, end).select(*(F.col(c).alias(f"__{c}") for c in by), "lo", "hi")
    bounds = bounds.filter("lo < hi")
    lowest, highest, partitions = bounds.agg(F.min("lo"), F.max("hi"), F.count(F.lit(1))).first()
    if not partitions:
        return feed.filter(F.lit(False))
    if partitions <= SHORT_LIST:
        bounds = F.broadcast(bounds)
    outer = feed.filter((F.col("offset") >= lowest) & (F.col("offset") < highest))
    same = F.lit(True)
    for column in by:
        same = same & F.col(column).eqNullSafe(F.col(f"__{column}"))
    inside = same & (F.col("offset") >= F.col("lo")) & (F.col("offset") < F.col("hi"))
    return outer.join(bounds, inside, "left_semi")
