"""Every query by name, with the SQL that gives the same rows straight from the base tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.functions.epoch import normalize_epoch
from rowtide.operators import decode, merge, meta, offsets, route, tables_of_feed
from rowtide.plans import business_tables as business
from rowtide.plans import events_feed as ef
from rowtide.plans import reads
from rowtide.sources.follow import Commits
from rowtide.sources.json_rows import read_json_rows, write_json_rows
from rowtide.sources.landed import bounded_landed, land, project_feed, stream_landed
from rowtide.spec import COMMIT, DELETED, REFUSED_REASON, REFUSED_VALUE, SRC_POS
from rowtide.streaming.ingest import live_view, start_changelog, stream_records
from rowtide.tables import catalog
from rowtide.tables.changelog import ChangelogTable
from rowtide.tables.folders import shared_folder

USERS = ef.USERS

# Instants and times the queries use.
MID_MONTH = "20240115000000000"
LATE_MONTH = "20240125000000000"
WINDOW_START, WINDOW_END = 1_704_844_800, 1_705_708_800
KEPT_COMMITS = 3
# Fixed value: the size of a file that the demonstration asks for.
FILE_BYTES = 30_000
CATALOG_NAME = "rowtide_current_users"
MICRO_BATCHES = 3
# Events in a file of a feed that is streamed, about; what a task has of a feed does not grow with it.
FEED_FILE_ROWS = 1 << 18

ROW = (*USERS.columns, COMMIT)
RECORD = (*USERS.columns, DELETED, COMMIT, SRC_POS)


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ef.user_records(spark, sf_dir)


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.decode(ef.change_feed(spark, sf_dir), USERS.image)


def _image(which: str, prefix: str = "") -> list:
    return [F.col(f"{which}.{c}").alias(f"{prefix}{c}") for c in USERS.columns]


def _image_as_text(which: str, prefix: str) -> list:
    """Numbers as text: a client may turn a numeric column with nulls into floating point."""
    return [F.col(f"{which}.{c}").cast("string").alias(f"{prefix}{c}") for c in USERS.columns]


# --- feed ------------------------------------------------------------------------------------------------------------


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbered feed as it lies in files; its texts are the event ids."""
    path = shared_folder(spark, "feed")
    land(ef.positioned_feed(spark, sf_dir).withColumn("value", F.col("event_id").cast("string")), path)
    return bounded_landed(spark, path)


def feed_scan_bounded(spark, sf_dir):
    return _positions(offsets.replay_window(_landed(spark, sf_dir), offsets.EARLIEST, WINDOW_END))


def feed_replay_window(spark, sf_dir):
    return _positions(offsets.replay_window(_landed(spark, sf_dir), WINDOW_START, WINDOW_END))


def feed_projection(spark, sf_dir):
    """Messages as a queue hands them out, bytes with a time stamp, as a feed."""
    messages = ef.positioned_feed(spark, sf_dir).select(
        F.encode(F.col("event_id").cast("string"), "UTF-8").alias("value"),
        F.timestamp_millis(F.col("timestamp") * 1000 + 789).alias("timestamp"),
        F.lit("users").alias("topic"),
        "partition",
        "offset",
    )
    return _positions(project_feed(messages))


def feed_sentinels(spark, sf_dir):
    """How many messages a replay has, by the arguments of its start and its end."""
    feed = _landed(spark, sf_dir)
    windows = [(offsets.EARLIEST, 0), (offsets.LATEST, 0), (7, offsets.LATEST), (WINDOW_START, offsets.EARLIEST), (0, WINDOW_END)]
    counted = [
        offsets.replay_window(feed, *w).agg(F.lit(f"{w[0]} to {w[1]}").alias("arguments"), F.count(F.lit(1)).alias("rows"))
        for w in windows
    ]
    return reduce(DataFrame.unionByName, counted)


def _positions(feed: DataFrame) -> DataFrame:
    return feed.select(
        F.col("value").cast("long").alias("event_id"),
        F.col("partition").alias("feed_partition"),
        F.col("offset").alias("feed_offset"),
        "timestamp",
    )


def feed_offsets_for_time(spark, sf_dir):
    bounds = offsets.offsets_for(ef.positioned_feed(spark, sf_dir), WINDOW_START, WINDOW_END)
    return bounds.withColumnRenamed("partition", "feed_partition")


def feed_offsets_json(spark, sf_dir):
    feed = ef.positioned_feed(spark, sf_dir).withColumn("topic", F.lit("users"))
    return offsets.offsets_json(feed, WINDOW_START)


def feed_decode(spark, sf_dir):
    return _decoded(spark, sf_dir).select(
        F.col("source.pos").alias(SRC_POS),
        "op",
        "ts_ms",
        *_image_as_text("before", "before_"),
        *_image_as_text("after", "after_"),
    )


def feed_malformed(spark, sf_dir):
    return decode.reject_counts(ef.change_feed(spark, sf_dir), USERS.image, USERS.scope)


def feed_decode_lenient(spark, sf_dir):
    """Events by what becomes of them, when every third second writes a number as text and every seventh a bad one."""
    given = F.regexp_replace("value", '"enabled":([01])', '"enabled":"$1"')
    bad = F.regexp_replace("value", '"enabled":([01])', '"enabled":"x$1"')
    text = F.when(F.col("timestamp") % 7 == 0, bad).when(F.col("timestamp") % 3 == 0, given).otherwise(F.col("value"))
    parsed = decode.parse(ef.change_feed(spark, sf_dir).withColumn("value", text), USERS.image, lenient=True)
    reasons = decode.with_routing_reason(parsed, USERS.scope).groupBy("reason")
    kept = F.count_if(F.coalesce("after.enabled", "before.enabled").isNotNull())
    return reasons.agg(F.count(F.lit(1)).alias("events"), kept.alias("with_number"))


def feed_two_tables(spark, sf_dir):
    """The events of a feed of two tables, each with its own image, and how those of neither are marked."""
    routed = tables_of_feed.route_tables(ef.two_table_feed(spark, sf_dir), ef.TABLES)
    image = {n: F.coalesce(f"t{n}.after", f"t{n}.before") for n in range(2)}
    return routed.select(
        "table",
        "reason",
        "op",
        F.col("source.pos").alias(SRC_POS),
        F.coalesce(image[0]["username"], image[1]["username"]).alias("username"),
        image[0]["password"].alias("password"),
        image[1]["authority"].alias("authority"),
    ).filter(F.col(SRC_POS).isNotNull())


def feed_two_tables_fold(spark, sf_dir):
    """The current authorities, out of the feed of two tables."""
    routed = tables_of_feed.route_tables(ef.two_table_feed(spark, sf_dir), ef.TABLES)
    events = tables_of_feed.events_of(routed, ef.TABLES, "auth.authorities")
    records = route.to_records(events, ef.AUTHORITIES, ef.day_of_feed())
    return merge.fold(records, ef.AUTHORITIES).select("username", "authority", "ts", COMMIT)


def feed_schema_inferred(spark, sf_dir):
    """The columns that the images of the evolved feed turn out to have; it gained one that the known image lacks."""
    feed = ef.change_feed(spark, sf_dir, number_since=ef.NUMBER_SINCE)
    return tables_of_feed.image_columns(feed, USERS.image)


def normalize_epochs(spark, sf_dir):
    rows = ef.events(spark, sf_dir)
    given = F.when(F.col("event_type") == "view", F.col("epoch") * 1000).otherwise(F.col("epoch"))
    return rows.select("event_id", given.alias("given"), normalize_epoch(given).alias("millis"))


def json_rows_inferred(spark, sf_dir):
    path = shared_folder(spark, "orders-json")
    write_json_rows(spark.read.parquet(f"{sf_dir}/orders.parquet"), path)
    rows = read_json_rows(spark, path)
    return rows.withColumn("o_orderdate", F.substring("o_orderdate", 1, 10))


# --- routing ---------------------------------------------------------------------------------------------------------


def route_upserts(spark, sf_dir):
    rows = route.upserts(_decoded(spark, sf_dir))
    return rows.select(F.col("source.pos").alias(SRC_POS), "op", *_image("after"))


def route_deletes(spark, sf_dir):
    rows = route.deletes(_decoded(spark, sf_dir))
    return rows.select(F.col("source.pos").alias(SRC_POS), "op", *_image("before"))


def route_records(spark, sf_dir):
    return _records(spark, sf_dir).select(*RECORD)


def partition_moves(spark, sf_dir):
    moves = route.partition_moves(_decoded(spark, sf_dir), USERS)
    return moves.select(
        F.col("source.pos").alias(SRC_POS),
        F.col("after.username").alias("username"),
        F.col("before.country").alias("from_country"),
        F.col("after.country").alias("to_country"),
    )


# --- folds -----------------------------------------------------------------------------------------------------------


def combine_batch(spark, sf_dir):
    return merge.combine(_records(spark, sf_dir), USERS).select(*RECORD)


def upsert_fold(spark, sf_dir):
    return merge.fold(_records(spark, sf_dir), USERS, keep_deletes=True).select(*RECORD)


def upsert_fold_offsets(spark, sf_dir):
    """The fold of a feed whose events have no ``source`` block: their place in the feed decides ties."""
    place = F.get_json_object("value", "$.payload.source.pos").cast("long")
    feed = ef.change_feed(spark, sf_dir).select(
        F.regexp_replace("value", r'"source":\{[^}]*\},', "").alias("value"),
        "timestamp",
        F.lit(0).alias("partition"),
        place.alias("offset"),
    )
    records = route.to_records(decode.parse(feed, USERS.image), USERS, ef.day_of_feed())
    return merge.fold(records, USERS, keep_deletes=True).select(*RECORD)


def upsert_fold_event_time(spark, sf_dir):
    return merge.fold(_records(spark, sf_dir), USERS, policy="event").select(*ROW)


def upsert_fold_global(spark, sf_dir):
    return merge.fold(_records(spark, sf_dir), USERS, by_partition=False).select(*ROW)


def upsert_fold_moves(spark, sf_dir):
    return merge.fold(ef.user_records(spark, sf_dir, follow_moves=True), USERS).select(*ROW)


def delete_apply(spark, sf_dir):
    current = merge.fold(_records(spark, sf_dir), USERS, keep_deletes=True)
    return current.filter(DELETED).select("country", "username", COMMIT)


def live_keyed_view(spark, sf_dir):
    return live_view(_records(spark, sf_dir), USERS).filter(f"not {DELETED}").select(*ROW)


def schema_evolution(spark, sf_dir):
    rows = merge.fold(ef.evolved_records(spark, sf_dir), ef.NUMBERED_USERS)
    return rows.select(*ROW, F.col("number").cast("string"))


# --- reads -----------------------------------------------------------------------------------------------------------


def snapshot(spark, sf_dir):
    return reads.read(_records(spark, sf_dir), USERS).select(*ROW)


def incremental(spark, sf_dir):
    return reads.read(_records(spark, sf_dir), USERS, begin=LATE_MONTH).select(*ROW)


def time_travel(spark, sf_dir):
    return reads.read(_records(spark, sf_dir), USERS, instant=MID_MONTH).select(*ROW)


def time_travel_prefix(spark, sf_dir):
    return reads.read(_records(spark, sf_dir), USERS, instant=MID_MONTH[:14]).select(*ROW)


def full_range_read(spark, sf_dir):
    """What changed since the first instant is all there is."""
    return reads.incremental(_records(spark, sf_dir), USERS).select(*ROW)


def table_count(spark, sf_dir):
    return reads.snapshot(_records(spark, sf_dir), USERS).agg(F.count(F.lit(1)).alias("rows"))


def partition_counts(spark, sf_dir):
    return meta.rows_per_partition(reads.snapshot(_records(spark, sf_dir), USERS), USERS)


def meta_columns(spark, sf_dir):
    combined = merge.combine(_records(spark, sf_dir), USERS)
    return meta.with_meta(combined, USERS).drop("_src_file", "_src_row")


def commit_timeline(spark, sf_dir):
    return meta.commits(_records(spark, sf_dir))


# --- stored tables ---------------------------------------------------------------------------------------------------


def compact_equivalence(spark, sf_dir):
    table = ChangelogTable(spark, shared_folder(spark, "users"), USERS)
    table.append_history(_records(spark, sf_dir))
    table.compact(MID_MONTH)
    return table.snapshot().select(*ROW)


def compact_slices(spark, sf_dir):
    """The fold from a base that was compacted twice, the second time only where the log has records."""
    table = ChangelogTable(spark, shared_folder(spark, "users-slices"), USERS, buckets=4)
    table.append_history(_records(spark, sf_dir))
    table.compact(MID_MONTH)
    table.compact(LATE_MONTH)
    return table.snapshot().select(*ROW)


def joined_files(spark, sf_dir):
    """The fold of a log whose thirty commits were joined into files of a byte size, read after a base was made in between."""
    table = ChangelogTable(spark, shared_folder(spark, "users-joined"), USERS, buckets=2)
    table.append_history(_records(spark, sf_dir))
    table.join_files(FILE_BYTES)
    table.compact(MID_MONTH)
    return table.snapshot().select(*ROW)


def catalog_current(spark, sf_dir):
    """The rows of a table by its name in the catalog."""
    table = ChangelogTable(spark, shared_folder(spark, "users-named"), USERS, buckets=2)
    table.append_history(_records(spark, sf_dir))
    catalog.register_current(table, CATALOG_NAME)
    return catalog.live_rows(spark, CATALOG_NAME).select(*ROW)


def version_changes(spark, sf_dir):
    """Rows inserted, updated and removed between two instants, with what they were and are."""
    table = ChangelogTable(spark, shared_folder(spark, "users-changes"), USERS, buckets=2)
    table.append_history(_records(spark, sf_dir))
    table.compact(MID_MONTH)
    changed = table.changes(MID_MONTH, LATE_MONTH)
    return changed.select(
        "change",
        F.coalesce("after.country", "before.country").alias("country"),
        F.coalesce("after.username", "before.username").alias("username"),
        F.col("before.password").alias("before_password"),
        F.col("after.password").alias("after_password"),
        F.col(f"before.{COMMIT}").alias("before_commit"),
        F.col(f"after.{COMMIT}").alias("after_commit"),
    )


def changelog_global_moves(spark, sf_dir):
    """A user is one row in the whole table: the stored table finds the row a user left behind without a before image."""
    table = ChangelogTable(spark, shared_folder(spark, "users-global"), USERS, buckets=4, global_key=True)
    table.append_history(_records(spark, sf_dir))
    table.compact(MID_MONTH)
    return table.snapshot().select(*ROW)


def rewrite_global_moves(spark, sf_dir):
    return business.moving_users(spark, sf_dir).snapshot().select(*ROW)


def rewrite_changes(spark, sf_dir):
    """Customers that a commit changed or removed, with their balance before and after."""
    changed = business.stored_customers(spark, sf_dir).changes(business.LOADED, business.UPDATED)
    return changed.select(
        "change",
        F.coalesce("after.c_custkey", "before.c_custkey").alias("c_custkey"),
        F.col("before.c_acctbal").alias("before_acctbal"),
        F.col("after.c_acctbal").alias("after_acctbal"),
    )


def retention(spark, sf_dir):
    records = _records(spark, sf_dir)
    kept = merge.changelog_until(records, USERS, meta.oldest_of_last(records, KEPT_COMMITS))
    return kept.select(*RECORD)


def retention_stored(spark, sf_dir):
    table = ChangelogTable(spark, shared_folder(spark, "users-kept"), USERS)
    table.append_history(_records(spark, sf_dir))
    table.retain(KEPT_COMMITS)
    return table.records().select(*RECORD)


def snapshot_meta(spark, sf_dir):
    table = ChangelogTable(spark, shared_folder(spark, "users-meta"), USERS)
    table.append_history(_records(spark, sf_dir))
    return table.snapshot(meta=True).select(COMMIT, meta.SEQNO, meta.RECORD_KEY, meta.PARTITION_PATH, *USERS.columns)


def _files_per_batch(spark: SparkSession, sf_dir: str, batches: int = 1) -> int:
    """Files that each of ``batches`` micro-batches of the feed has, if none holds more than ``FEED_FILE_ROWS``."""
    return max(1, -(-ef.events(spark, sf_dir).count() // (batches * FEED_FILE_ROWS)))


def _streamed(spark: SparkSession, sf_dir: str, policy: str, commit=None) -> ChangelogTable:
    """The feed landed as files and streamed into a table in several micro-batches."""
    folder = shared_folder(spark, "users-stream")
    files = _files_per_batch(spark, sf_dir, MICRO_BATCHES)
    land(ef.change_feed(spark, sf_dir).repartition(MICRO_BATCHES * files), f"{folder}/feed")
    feed = stream_landed(spark, f"{folder}/feed", max_files_per_trigger=files)
    records = stream_records(feed, USERS, commit)
    query = start_changelog(
        records, USERS, f"{folder}/table", f"{folder}/checkpoint", interval=None, files_per_partition=files
    )
    query.awaitTermination()
    return ChangelogTable(spark, f"{folder}/table", USERS, policy=policy, streamed=True)


def stream_upsert_fold(spark, sf_dir):
    return _streamed(spark, sf_dir, "event").snapshot().select(*USERS.columns)


def stream_redelivered(spark, sf_dir):
    """A feed that was delivered twice: every change is stored once."""
    folder = shared_folder(spark, "users-twice")
    feed = ef.change_feed(spark, sf_dir)
    files = _files_per_batch(spark, sf_dir)
    for _ in range(2):
        land(feed.repartition(files), f"{folder}/feed")
    # a delivery is one micro-batch: were it several, its oldest events could come late
    stream = stream_landed(spark, f"{folder}/feed", max_files_per_trigger=files)
    records = stream_records(stream, USERS, ef.day_of_feed(), redelivered_within="400 days")
    query = start_changelog(
        records, USERS, f"{folder}/table", f"{folder}/checkpoint", interval=None, files_per_partition=files
    )
    query.awaitTermination()
    return ChangelogTable(spark, f"{folder}/table", USERS, streamed=True).records().select(*RECORD)


def stream_refused(spark, sf_dir):
    """What a stream did not take, by reason, stored beside its records."""
    folder = shared_folder(spark, "users-refused")
    files = _files_per_batch(spark, sf_dir, 2)
    land(ef.change_feed(spark, sf_dir).repartition(2 * files), f"{folder}/feed")
    stream = stream_landed(spark, f"{folder}/feed", max_files_per_trigger=files)
    records = stream_records(stream, USERS, keep_refused=True)
    query = start_changelog(
        records, USERS, f"{folder}/table", f"{folder}/checkpoint", interval=None, files_per_partition=files
    )
    query.awaitTermination()
    refused = ChangelogTable(spark, f"{folder}/table", USERS, streamed=True).refused()
    return refused.groupBy(F.col(REFUSED_REASON).alias("reason")).agg(
        F.count(F.lit(1)).alias("events"), F.count(REFUSED_VALUE).alias("with_text")
    )


def stream_commits(spark, sf_dir):
    """The commits of a stored changelog after an instant, followed as a stream."""
    folder = shared_folder(spark, "users-followed")
    table = ChangelogTable(spark, f"{folder}/table", USERS)
    table.append_history(_records(spark, sf_dir))
    spark.dataSource.register(Commits)
    followed = spark.readStream.format(Commits.name()).schema(USERS.record_schema)
    followed = followed.option("path", table.path).option("after", MID_MONTH).load()
    writer = followed.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint")
    writer.trigger(availableNow=True).start(f"{folder}/out").awaitTermination()
    return spark.read.schema(USERS.record_schema).parquet(f"{folder}/out").select(*RECORD)


def stream_retention(spark, sf_dir):
    table = _streamed(spark, sf_dir, "commit", ef.day_of_feed())
    table.retain(KEPT_COMMITS)
    return merge.combine(table.records(), USERS).select(*RECORD)


def quickstart_roundtrip(spark, sf_dir):
    return business.round_trip(spark, sf_dir)


def limit_update(spark, sf_dir):
    rows = business.limited_update(spark, sf_dir)
    return rows.select("o_orderkey", "o_orderstatus", "o_totalprice", COMMIT)


def rewrite_versions(spark, sf_dir):
    return business.customer_versions(spark, sf_dir)


def rewrite_retained(spark, sf_dir):
    return business.retained_orders(spark, sf_dir)


def rewrite_incremental(spark, sf_dir):
    changed = business.stored_customers(spark, sf_dir).incremental(business.LOADED)
    return changed.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", COMMIT)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "feed_scan_bounded": feed_scan_bounded,
    "feed_decode": feed_decode,
    "feed_decode_lenient": feed_decode_lenient,
    "feed_malformed": feed_malformed,
    "feed_projection": feed_projection,
    "feed_sentinels": feed_sentinels,
    "feed_offsets_for_time": feed_offsets_for_time,
    "feed_offsets_json": feed_offsets_json,
    "feed_replay_window": feed_replay_window,
    "feed_two_tables": feed_two_tables,
    "feed_two_tables_fold": feed_two_tables_fold,
    "feed_schema_inferred": feed_schema_inferred,
    "normalize_epoch": normalize_epochs,
    "json_rows_inferred": json_rows_inferred,
    "route_upserts": route_upserts,
    "route_deletes": route_deletes,
    "route_records": route_records,
    "combine_batch": combine_batch,
    "upsert_fold": upsert_fold,
    "upsert_fold_event_time": upsert_fold_event_time,
    "upsert_fold_offsets": upsert_fold_offsets,
    "upsert_fold_global": upsert_fold_global,
    "upsert_fold_moves": upsert_fold_moves,
    "delete_apply": delete_apply,
    "partition_moves": partition_moves,
    "partition_counts": partition_counts,
    "meta_columns": meta_columns,
    "commit_timeline": commit_timeline,
    "quickstart_roundtrip": quickstart_roundtrip,
    "limit_update": limit_update,
    "full_range_read": full_range_read,
    "table_count": table_count,
    "compact_equivalence": compact_equivalence,
    "compact_slices": compact_slices,
    "joined_files": joined_files,
    "catalog_current": catalog_current,
    "version_changes": version_changes,
    "changelog_global_moves": changelog_global_moves,
    "retention": retention,
    "retention_stored": retention_stored,
    "schema_evolution": schema_evolution,
    "snapshot": snapshot,
    "incremental": incremental,
    "time_travel": time_travel,
    "time_travel_prefix": time_travel_prefix,
    "live_view": live_keyed_view,
    "stream_upsert_fold": stream_upsert_fold,
    "snapshot_meta": snapshot_meta,
    "stream_retention": stream_retention,
    "stream_redelivered": stream_redelivered,
    "stream_refused": stream_refused,
    "stream_commits": stream_commits,
    "rewrite_versions": rewrite_versions,
    "rewrite_retained": rewrite_retained,
    "rewrite_incremental": rewrite_incremental,
    "rewrite_global_moves": rewrite_global_moves,
    "rewrite_changes": rewrite_changes,
}
