"""A change feed derived from the ``events`` table, as JSON text.

Every event becomes one change of a user row. The before image is the user's previous event. Some events are damaged,
late or of an unknown kind, and some move the user to another country, so that each rule of the package is exercised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.functions.epoch import ntz_epoch_seconds
from rowtide.functions.instants import instant_from_millis
from rowtide.functions.ordered import dense_index, previous_row
from rowtide.operators.decode import parse
from rowtide.operators.route import to_records
from rowtide.spec import TableSpec, image_of_types

USERS = TableSpec(
    image=image_of_types(username="string", password="string", enabled="integer", ts="long", country="string"),
    record_key=("username",),
    partition=("country",),
    order_by="ts",
)

FEED_PARTITIONS = 4

# Rows per bucket when looking for the previous event or numbering a feed partition.
SPAN = 1 << 20


NUMBERED_USERS = TableSpec(
    image=T.StructType([*USERS.image.fields, T.StructField("number", T.IntegerType())]),
    record_key=USERS.record_key,
    partition=USERS.partition,
    order_by=USERS.order_by,
)

# The source table gets its ``number`` column at 2024-01-16.
NUMBER_SINCE = 1_705_363_200


def _image(event_id: str, epoch: str, number_since: int | None) -> str:
    """SQL of the user row an event leaves behind."""
    number = ""
    if number_since is not None:
        # JSON leaves a null field out, as a source without the column does
        number = f", if({epoch} >= {number_since}, cast({event_id} % 100 as int), null) as number"
    return f"""struct(
        concat('user', user_id) as username,
        concat('pw', {event_id}) as password,
        cast({event_id} % 2 as int) as enabled,
        {epoch} - if({event_id} % 11 = 0, 432000, 0) as ts,
        decode((user_id + if({event_id} % 7 = 0, 1, 0)) % 3, 0, 'SG', 1, 'ID', 'MY') as country
        {number})"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, user_id, event_type, epoch`` of the events table."""
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    return table.select("event_id", "user_id", "event_type", ntz_epoch_seconds(F.col("ts")).alias("epoch"))


def change_feed(
    spark: SparkSession, sf_dir: str, span: int = SPAN, number_since: int | None = None
) -> DataFrame:
    """``value, timestamp``: the feed. From ``number_since`` on, images have one more column, ``number``."""
    rows = previous_row(events(spark, sf_dir), ["user_id"], "event_id", span, ["event_id", "epoch"])
    changes = rows.selectExpr(
        "event_id",
        "epoch",
        """case when event_id % 97 = 0 then 't' when event_type = 'signup' then 'c' when event_type = 'view' then 'r'
           when event_type = 'error' then 'd' else 'u' end as op""",
        f"{_image('event_id', 'epoch', number_since)} as own",
        # the first event of a user stands in for its own past
        f"{_image('coalesce(prev_event_id, event_id)', 'coalesce(prev_epoch, epoch)', number_since)} as past",
    )
    return changes.selectExpr(
        """case
             when event_id % 101 = 0 then concat('{broken ', event_id)
             when event_id % 103 = 0 then null
             else to_json(struct(struct(
               if(op in ('c', 'r'), null, past) as before,
               if(op = 'd', null, own) as after,
               struct('auth' as db, 'users' as `table`, 'log.000001' as file, event_id as pos, 0 as row,
                 epoch * 1000 as ts_ms) as source,
               op,
               epoch * 1000 as ts_ms) as payload))
           end as value""",
        "epoch as timestamp",
    )


def day_of_feed() -> Column:
    """The commit of an event: the start of its day."""
    seconds = F.col("timestamp")
    return instant_from_millis((seconds - F.pmod(seconds, F.lit(86_400))) * 1000)


def parsed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse(change_feed(spark, sf_dir), USERS.image)


def user_records(spark: SparkSession, sf_dir: str, follow_moves: bool = False) -> DataFrame:
    return to_records(parsed_feed(spark, sf_dir), USERS, day_of_feed(), follow_moves)


def evolved_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a source that gained a column. The wider image reads the older events too: what they lack is null."""
    feed = change_feed(spark, sf_dir, number_since=NUMBER_SINCE)
    return to_records(parse(feed, NUMBERED_USERS.image), NUMBERED_USERS, day_of_feed())


def positioned_feed(spark: SparkSession, sf_dir: str, span: int = SPAN) -> DataFrame:
    """``event_id, partition, offset, timestamp``: the feed as a message queue with four partitions holds it."""
    rows = events(spark, sf_dir).select(
        "event_id", (F.col("user_id") % FEED_PARTITIONS).cast("int").alias("partition"), F.col("epoch").alias("timestamp")
    )
    bucket = F.floor(F.col("event_id") / F.lit(span)).cast("long")
    return dense_index(rows, ["partition"], bucket, [F.col("event_id").asc()], "offset")


AUTHORITIES = TableSpec(
    image=image_of_types(username="string", authority="string", ts="long"),
    record_key=("username", "authority"),
    order_by="ts",
)
TABLES = {"auth.users": USERS, "auth.authorities": AUTHORITIES}


def two_table_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value, timestamp``: changes of users and of their authorities in one feed, and of a table nobody knows.

    Every fifth event is of ``authorities``, every 89th of ``audit``; every 101st is damaged.
    """
    rows = events(spark, sf_dir).selectExpr(
        "event_id", "event_type", "epoch",
        "case when event_id % 89 = 0 then 'audit' when event_id % 5 = 0 then 'authorities' else 'users' end as name",
        f"{_image('event_id', 'epoch', None)} as user",
        "struct(concat('user', user_id) as username, event_type as authority, epoch as ts) as right",
    )
    return rows.selectExpr(
        """case when event_id % 101 = 0 then concat('{broken ', event_id) else concat('{"payload":{"',
             if(event_type = 'error', 'before', 'after'), '":', if(name = 'users', to_json(user), to_json(right)),
             ',"source":', to_json(struct('auth' as db, name as `table`, 'log.000001' as file, event_id as pos, 0 as row)),
             ',"op":"', if(event_type = 'error', 'd', 'u'), '","ts_ms":', epoch * 1000, '}}') end as value""",
        "epoch as timestamp",
    )
