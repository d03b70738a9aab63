"""From feed text to change events: JSON decode, reasons for refusal, quarantine.

A feed has the columns ``value`` (JSON text) and ``timestamp`` (epoch seconds); any further columns travel along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Operation codes. ``r`` is a row found by the first load, treated as an insert.
UPSERT_OPS = ("r", "c", "u")
DELETE_OPS = ("d",)

# Why an event does not become a record.
TOMBSTONE, BLANK, MALFORMED = "tombstone", "blank", "malformed"
NO_OP, UNKNOWN_OP, NULL_KEY = "no_op", "unknown_op", "null_key"
OK = "ok"

_CORRUPT = "_corrupt_record"

SOURCE_SCHEMA = T.StructType(
    [
        T.StructField("db", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("pos", T.LongType()),
        T.StructField("row", T.IntegerType()),
        T.StructField("ts_ms", T.LongType()),
    ]
)


def _as_struct(image: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(image) if isinstance(image, str) else image


def scalars_as_text(image: T.StructType) -> T.StructType:
    nested = (T.StructType, T.ArrayType, T.MapType)
    return T.StructType(
        [T.StructField(f.name, f.dataType if isinstance(f.dataType, nested) else T.StringType()) for f in image.fields]
    )


def try_casts(image: Column, schema: T.StructType) -> Column:
    return F.when(
        image.isNotNull(), F.struct(*(scalar(image[f.name], f.dataType).alias(f.name) for f in schema.fields))
    )


def scalar(text: Column, kind: T.DataType) -> Column:
    """A scalar read as text, null where it is not a value of ``kind``: whole numbers take no fraction."""
    value = text.try_cast(kind)
    if isinstance(kind, T.IntegralType):
        value = F.when(F.trim(text).rlike(r"^[+-]?\d+$"), value)
    return value


def lost(image: Column, schema: T.StructType) -> Column:
    """Whether a value is there that the cast could not keep."""
    lost = F.lit(False)
    for f in schema.fields:
        lost = lost | (image[f.name].isNotNull() & scalar(image[f.name], f.dataType).isNull())
    return F.coalesce(lost, F.lit(False))


def envelope_schema(image: T.StructType | str) -> T.StructType:
    image = _as_struct(image)
    payload = T.StructType(
        [
            T.StructField("before", image),
            T.StructField("after", image),
            T.StructField("source", SOURCE_SCHEMA),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
        ]
    )
    return T.StructType([T.StructField("payload", payload), T.StructField(_CORRUPT, T.StringType())])


def parse(feed: DataFrame, image: T.StructType | str, lenient: bool = False) -> DataFrame:
    """Every feed row with ``before, after, source, op, ts_ms`` and ``reason``; nothing is dropped.

    Missing image fields are null and unknown ones are ignored. A value of the wrong type makes the event malformed;
    ``lenient`` reads scalars as text and casts them, so ``"1"`` is accepted for an integer. A value that the cast
    cannot keep (``"abc"``, ``1.7`` or ``true`` for an integer) makes the event malformed there too.
    """
    target = _as_struct(image)
    read_as = scalars_as_text(target) if lenient else target
    parsed = F.from_json("value", envelope_schema(read_as), {"columnNameOfCorruptRecord": _CORRUPT})
    # inline() keeps later filters above the parse. A plain projection would be merged into them and parse twice.
    events = feed.select("*", F.inline(F.array(parsed)))
    value, op = F.col("value"), F.col("payload.op")
    before, after = F.col("payload.before"), F.col("payload.after")
    malformed = F.col(_CORRUPT).isNotNull()
    if lenient:
        malformed = malformed | lost(before, target) | lost(after, target)
    reason = (
        F.when(value.isNull(), TOMBSTONE)
        .when(F.trim(value) == "", BLANK)
        .when(malformed, MALFORMED)
        .when(op.isNull(), NO_OP)
        .otherwise(OK)
    )
    if lenient:
        before, after = try_casts(before, target), try_casts(after, target)
    return events.select(
        *feed.columns,
        before.alias("before"),
        after.alias("after"),
        F.col("payload.source").alias("source"),
        op.alias("op"),
        F.col("payload.ts_ms").alias("ts_ms"),
        reason.alias("reason"),
    )


def decode(feed: DataFrame, image: T.StructType | str, lenient: bool = False) -> DataFrame:
    """The readable events of a feed. Null values, blanks and malformed texts are dropped."""
    return parse(feed, image, lenient).filter(F.col("reason") == OK).drop("value", "reason")


def image_of(op: Column, before: Column, after: Column) -> Column:
    """The row an event is about: the old one for a delete, else the new one."""
    return F.when(op.isin(*DELETE_OPS), before).otherwise(after)


def with_routing_reason(parsed: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """Refine ``reason`` of parsed events: unknown operations, and images that miss a ``required`` column."""
    op = F.col("op")
    image = image_of(op, F.col("before"), F.col("after"))
    complete = F.lit(True)
    for column in required:
        complete = complete & image[column].isNotNull()
    return parsed.withColumn(
        "reason",
        F.when(F.col("reason") != OK, F.col("reason"))
        .when(~op.isin(*UPSERT_OPS, *DELETE_OPS), UNKNOWN_OP)
        .when(~complete, NULL_KEY)
        .otherwise(OK),
    )


def quarantine(
    feed: DataFrame, image: T.StructType | str, required: tuple[str, ...] = (), lenient: bool = False
) -> DataFrame:
    """The refused rows of a feed with their raw text and the reason."""
    parsed = with_routing_reason(parse(feed, image, lenient), required)
    return parsed.filter(F.col("reason") != OK).select(*feed.columns, "reason")


def reject_counts(
    feed: DataFrame, image: T.StructType | str, required: tuple[str, ...] = (), lenient: bool = False
) -> DataFrame:
    """``reason, events``: how many rows of a feed are refused, and why."""
    return quarantine(feed, image, required, lenient).groupBy("reason").agg(F.count(F.lit(1)).alias("events"))


def observe_rejects(parsed: DataFrame, observation: Observation | str) -> DataFrame:
    """Count refused events while the plan runs, with no second pass. A name is needed for streams.

    Only ``with_routing_reason`` tells unknown operations and missing keys; apply it first to have them counted.
    """
    metrics = [
        F.count_if(F.col("reason") == name).alias(name)
        for name in (TOMBSTONE, BLANK, MALFORMED, NO_OP, UNKNOWN_OP, NULL_KEY)
    ]
    return parsed.observe(observation, F.count(F.lit(1)).alias("events"), *metrics)
