"""Change feeds kept as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LANDED_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("value", T.StringType()),
    ]
)


def project_feed(messages: DataFrame) -> DataFrame:
    """``value`` as text and ``timestamp`` as whole seconds, with topic, partition and offset if there are any."""
    place = [c for c in ("topic", "partition", "offset") if c in messages.columns]
    return messages.select(F.col("value").cast("string"), F.col("timestamp").cast("long"), *place)


def land(feed: DataFrame, path: str, mode: str = "append") -> None:
    """Keep a feed as Parquet in the landed layout."""
    have = set(feed.columns)
    columns = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in LANDED_SCHEMA.fields
    ]
    feed.select(*columns).write.mode(mode).parquet(path)


def bounded_landed(spark: SparkSession, path: str) -> DataFrame:
    """A landed feed as a batch. Cut it with ``operators.offsets.replay_window``."""
    return spark.read.schema(LANDED_SCHEMA).parquet(path)


def stream_landed(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A landed feed as a stream, in the order its files arrived."""
    reader = spark.readStream.schema(LANDED_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def stream_text(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Text files with one event per line as a stream; the time is the file's modification time."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(path)
    return lines.select("value", F.col("_metadata.file_modification_time").cast("long").alias("timestamp"))
