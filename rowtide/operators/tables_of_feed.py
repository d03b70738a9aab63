"""Feeds that carry the changes of several source tables, and images learned from a feed.

A text is read once, to a variant. Where the events of a table are, and what they look like, is looked up in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.operators import decode as d
from rowtide.spec import TableSpec

# Why an event belongs to no known table.
UNKNOWN_TABLE = "unknown_table"

_EVENT = "__event"
_SOURCE = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in d.SOURCE_SCHEMA.fields)
# Whole numbers and what holds more, narrow first.
_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())


def read_events(feed: DataFrame) -> DataFrame:
    """Every feed row with the variant of its text (null if it is none), in one parse."""
    # a generator keeps later projections from parsing again
    return feed.select("*", F.inline(F.array(F.struct(F.try_parse_json("value").alias(_EVENT)))))


def _at(path: str, kind: str) -> Column:
    return F.try_variant_get(F.col(_EVENT), f"$.payload.{path}", kind)


def _variant_type(schema: T.StructType) -> str:
    return "struct<" + ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in schema.fields) + ">"


def _image(which: str, image: T.StructType) -> Column:
    """An image as text where it is scalar; the values are cast afterwards, so that a bad one can be told from none."""
    return _at(which, _variant_type(d.scalars_as_text(image)))


def route_tables(feed: DataFrame, tables: dict[str, TableSpec]) -> DataFrame:
    """Every feed row with ``table, source, op, ts_ms, reason`` and per known table a struct ``before, after`` of its images.

    ``tables`` has the specs by ``db.table``; their images are columns named ``t0``, ``t1``, ... in its order. ``table`` is
    null where the event names none. An event of a table that is not in it has the reason ``unknown_table``, others the
    reasons of ``decode``. Scalars written as text are accepted if the cast keeps them, as with ``decode.parse(lenient=True)``;
    text after a JSON value makes an event malformed here.
    """
    events = read_events(feed)
    source = _at("source", f"struct<{_SOURCE}>")
    events = events.withColumns({
        "source": source, "op": _at("op", "string"), "ts_ms": _at("ts_ms", "bigint"),
        **{f"__{which}{n}": _image(which, spec.image) for n, spec in enumerate(tables.values()) for which in ("before", "after")},
    })
    named = F.concat_ws(".", "source.db", "source.table")
    table = F.when(F.col("source.db").isNotNull() & F.col("source.table").isNotNull(), named)
    own, lost, complete = [], F.lit(False), F.lit(True)
    for number, (name, spec) in enumerate(tables.items()):
        here = F.coalesce(table == name, F.lit(False))
        before, after = F.col(f"__before{number}"), F.col(f"__after{number}")
        lost = lost | (here & (d.lost(before, spec.image) | d.lost(after, spec.image)))
        images = [F.when(here, d.try_casts(c, spec.image)).alias(w) for c, w in ((before, "before"), (after, "after"))]
        own.append(F.struct(*images).alias(f"t{number}"))
        image = d.image_of(F.col("op"), before, after)
        for column in spec.scope:
            complete = complete & (~here | image[column].isNotNull())
    value, op = F.col("value"), F.col("op")
    reason = (
        F.when(value.isNull(), d.TOMBSTONE)
        .when(F.trim(value) == "", d.BLANK)
        .when(F.col(_EVENT).isNull(), d.MALFORMED)
        .when(table.isNull() | ~table.isin(*tables), UNKNOWN_TABLE)
        .when(lost, d.MALFORMED)
        .when(op.isNull(), d.NO_OP)
        .when(~op.isin(*d.UPSERT_OPS, *d.DELETE_OPS), d.UNKNOWN_OP)
        .when(~complete, d.NULL_KEY)
        .otherwise(d.OK)
    )
    return events.select(*feed.columns, table.alias("table"), "source", "op", "ts_ms", reason.alias("reason"), *own)


def events_of(routed: DataFrame, tables: dict[str, TableSpec], name: str) -> DataFrame:
    """The readable events of one table, as ``route.to_records`` takes them."""
    number = list(tables).index(name)
    routing = {"table", "reason", *(f"t{n}" for n in range(len(tables)))}
    rest = [c for c in routed.columns if c not in routing]
    chosen = routed.filter((F.col("table") == name) & (F.col("reason") == d.OK))
    return chosen.select(*rest, F.col(f"t{number}.before").alias("before"), F.col(f"t{number}.after").alias("after"))


def quarantined(routed: DataFrame, feed: DataFrame) -> DataFrame:
    """The refused rows with their raw text, the table they name and the reason."""
    return routed.filter(F.col("reason") != d.OK).select(*feed.columns, "table", "reason")


# --- images learned from a feed


def image_columns(feed: DataFrame, known: T.StructType | None = None, table: str | None = None) -> DataFrame:
    """``column, type, images``: the columns that the images of a feed have, their types, and in how many images each has
    a value.

    Types are those of JSON, the widest where values differ. A column of ``known`` keeps its type if all values fit it,
    else it is widened: whole numbers to ``bigint``, then to ``double``, anything to ``string``. Columns of ``known`` that
    no image has stay, with 0 images. ``table`` (``db.table``) looks at its events only. Two aggregations over the feed;
    the rows of the result are columns, so they pass through the driver.
    """
    spark = feed.sparkSession
    events = read_events(feed)
    if table is not None:
        events = events.filter(F.concat_ws(".", _at("source.db", "string"), _at("source.table", "string")) == table)
    images = events.select(F.explode(F.array(_at("before", "variant"), _at("after", "variant"))).alias("image"))
    images = images.filter(F.col("image").isNotNull() & ~F.is_variant_null("image"))
    found = images.agg(F.schema_of_variant_agg("image")).first()[0] or "VOID"
    found = _read_type(found) if found.startswith("OBJECT<") else T.StructType()
    wanted = {f.name: f.dataType for f in (known or T.StructType()).fields}
    names = list(wanted) + [f.name for f in found.fields if f.name not in wanted]
    measures = []
    for number, name in enumerate(names):
        place = "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"
        value = F.try_variant_get("image", place, "variant")
        there = value.isNotNull() & ~F.is_variant_null(value)
        kept = F.lit(True)
        if name in wanted:
            kept = d.scalar(F.try_variant_get("image", place, "string"), wanted[name]).isNotNull() if _plain(wanted[name]) else (
                F.try_variant_get("image", place, wanted[name].simpleString()).isNotNull())
        measures += [F.count_if(there).alias(f"n{number}"), F.count_if(there & ~kept).alias(f"lost{number}")]
    counted = images.agg(*measures).first() if measures else ()
    given = {f.name: f.dataType for f in found.fields}
    rows = []
    for number, name in enumerate(names):
        kind = given.get(name, T.NullType())
        if name in wanted:
            kind = wanted[name] if not counted[f"lost{number}"] else _wider(wanted[name], kind)
        rows.append((name, _stored_type(kind).simpleString(), int(counted[f"n{number}"])))
    return spark.createDataFrame(rows, "column string, type string, images long")


def image_of_feed(feed: DataFrame, known: T.StructType | None = None, table: str | None = None) -> T.StructType:
    """The image that reads a feed: ``known`` with the columns that the feed has more, and types as wide as it needs."""
    columns = image_columns(feed, known, table).collect()
    return T.StructType([T.StructField(r["column"], T.DataType.fromDDL(r["type"])) for r in columns])


def _plain(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.StructType, T.ArrayType, T.MapType, T.VariantType))


def _read_type(text: str) -> T.StructType:
    return T.DataType.fromDDL(text.replace("OBJECT<", "STRUCT<"))


def _wider(known: T.DataType, found: T.DataType) -> T.DataType:
    """The narrowest of bigint, double and string that holds both."""
    numbers = (T.FloatType, T.DoubleType, T.DecimalType)
    if known in _WHOLE and found in _WHOLE:
        return T.LongType()
    if (known in _WHOLE or isinstance(known, numbers)) and (found in _WHOLE or isinstance(found, numbers)):
        return T.DoubleType()
    return T.StringType()


def _stored_type(kind: T.DataType) -> T.DataType:
    """What a column of values without one type, or without any value, is kept as."""
    return T.StringType() if isinstance(kind, (T.NullType, T.VariantType)) else kind
