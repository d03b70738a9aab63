"""Change feeds from Kafka. Needs the Spark Kafka connector on the session's class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowtide.operators.offsets import end_position, is_bounded, start_position
from rowtide.sources.landed import project_feed


def reader_options(
    servers: str,
    topics: str,
    start: int = -1,
    end: int = -1,
    max_offsets_per_trigger: int | None = None,
    security: dict[str, str] | None = None,
    bounded: bool | None = None,
) -> dict[str, str]:
    """Options of the ``kafka`` format.

    ``topics`` may be several names with commas between. ``start`` and ``end`` follow
    :mod:`rowtide.operators.offsets`: a time, -1 for the latest or -2 for the earliest offset. Lost offsets do not fail
    the query. ``security`` goes to the client as it is, for instance ``{"security.protocol": "SASL_PLAINTEXT",
    "sasl.mechanism": "PLAIN"}``.
    """
    bounded = is_bounded(start, end) if bounded is None else bounded
    first, last = start_position(start), end_position(end)
    options = {"kafka.bootstrap.servers": servers, "subscribe": topics, "failOnDataLoss": "false"}
    if first.kind == "time":
        options["startingTimestamp"] = str(first.millis)
        # a partition with nothing at or after the time starts at its end
        options["startingOffsetsByTimestampStrategy"] = "latest"
    else:
        options["startingOffsets"] = first.kind
    if bounded:
        if first.kind == "latest":
            raise ValueError("a bounded scan cannot start at the latest offset; give a start time or -2")
        if last.kind == "time":
            options["endingTimestamp"] = str(last.millis)
        else:
            options["endingOffsets"] = "latest"
    else:
        if last.kind == "time":
            raise ValueError("a stream has no end; give an end time after the start for a bounded scan")
        if max_offsets_per_trigger:
            options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    for name, value in (security or {}).items():
        options[name if name.startswith("kafka.") else f"kafka.{name}"] = value
    return options


def stream_feed(spark: SparkSession, servers: str, topics: str, start: int = -1, **options) -> DataFrame:
    """Unbounded feed. With a checkpoint, ``start`` counts for the first run only."""
    reader = spark.readStream.format("kafka").options(**reader_options(servers, topics, start, bounded=False, **options))
    return project_feed(reader.load())


def bounded_feed(spark: SparkSession, servers: str, topics: str, start: int, end: int = -1, **options) -> DataFrame:
    """Feed between two positions, as a batch."""
    reader = spark.read.format("kafka").options(**reader_options(servers, topics, start, end, bounded=True, **options))
    return project_feed(reader.load())
