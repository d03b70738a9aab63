"""Round trips of business tables through stored keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.functions.epoch import ntz_epoch_seconds
from rowtide.operators.merge import fold
from rowtide.plans import events_feed
from rowtide.spec import COMMIT, DELETED, SRC_FILE, SRC_POS, SRC_ROW, TableSpec, image_of_types
from rowtide.tables.folders import shared_folder
from rowtide.tables.rewrite import RewriteTable

ORDERS = TableSpec(
    image=image_of_types(o_orderkey="long", o_orderstatus="string", o_totalprice="double", ts="long"),
    record_key=("o_orderkey",),
    partition=("o_orderstatus",),
)
CUSTOMERS = TableSpec(
    image=image_of_types(c_custkey="long", c_name="string", c_acctbal="double", c_mktsegment="string", ts="long"),
    record_key=("c_custkey",),
    partition=("c_mktsegment",),
)

LOADED, INSERTED, UPDATED = "20240101000000000", "20240102000000000", "20240103000000000"


def as_records(rows: DataFrame, spec: TableSpec, position: Column | str, deleted: bool = False) -> DataFrame:
    """Plain rows as records: each an upsert, or a delete, at a source position."""
    position = F.col(position) if isinstance(position, str) else position
    return rows.select(
        *spec.columns,
        F.lit(deleted).alias(DELETED),
        F.lit(None).cast("string").alias(SRC_FILE),
        position.cast("long").alias(SRC_POS),
        F.lit(None).cast("int").alias(SRC_ROW),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return table.select(
        "o_orderkey", "o_orderstatus", "o_totalprice", ntz_epoch_seconds(F.col("o_orderdate")).alias("ts")
    )


def stored_orders(spark: SparkSession, sf_dir: str) -> RewriteTable:
    """All orders in a table of three commits: those up to 1997, the later ones, then a new price for all of 1997."""
    rows = orders(spark, sf_dir)
    first_of = {"1997": 852_076_800, "1998": 883_612_800}
    in_1997 = F.col("ts").between(first_of["1997"], first_of["1998"] - 1)
    table = RewriteTable(spark, shared_folder(spark, "orders"), ORDERS, buckets=4)
    table.apply(as_records(rows.filter(F.col("ts") < first_of["1998"]), ORDERS, "o_orderkey"), LOADED, overwrite=True)
    table.apply(as_records(rows.filter(F.col("ts") >= first_of["1998"]), ORDERS, "o_orderkey"), INSERTED)
    raised = rows.filter(in_1997).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    table.apply(as_records(raised, ORDERS, "o_orderkey"), UPDATED)
    return table


def round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rows, commits, updated``: an update changes rows and adds a commit, but no row."""
    table = stored_orders(spark, sf_dir)
    rows = table.snapshot().agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(COMMIT) == UPDATED).alias("updated")
    )
    commits = table.commits().agg(F.count(F.lit(1)))
    return rows.select("rows", commits.scalar().alias("commits"), "updated")


def retained_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both versions that are left of the orders after the oldest commit was given up, marked by ``version``."""
    table = stored_orders(spark, sf_dir)
    table.retain(2)
    kept = [table.as_of(c).withColumn("version", F.lit(c)) for c in (INSERTED, UPDATED)]
    return kept[0].unionByName(kept[1]).select("version", "o_orderkey", "o_totalprice", COMMIT)


def limited_update(spark: SparkSession, sf_dir: str, limit: int = 10) -> DataFrame:
    """All orders, after an update of the ``limit`` lowest keys."""
    rows = orders(spark, sf_dir)
    lowest = rows.orderBy("o_orderkey").limit(limit).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    commits = [(rows, LOADED), (lowest, UPDATED)]
    loaded, updated = (as_records(r, ORDERS, "o_orderkey").withColumn(COMMIT, F.lit(c)) for r, c in commits)
    return fold(loaded.unionByName(updated), ORDERS)


def stored_customers(spark: SparkSession, sf_dir: str) -> RewriteTable:
    """All customers; then debts are written off and the furniture segment is removed."""
    table_rows = spark.read.parquet(f"{sf_dir}/customer.parquet")
    rows = table_rows.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", F.lit(0).cast("long").alias("ts"))
    table = RewriteTable(spark, shared_folder(spark, "customers"), CUSTOMERS, buckets=4)
    table.apply(as_records(rows, CUSTOMERS, "c_custkey"), LOADED, overwrite=True)
    cleared = rows.filter("c_acctbal < 0").withColumn("c_acctbal", F.lit(0.0))
    gone = rows.filter("c_mktsegment = 'FURNITURE'")
    # the removal comes after the write-off in the source, so it wins where a customer has both
    removed = as_records(gone, CUSTOMERS, F.col("c_custkey") + F.lit(1 << 40), deleted=True)
    table.apply(as_records(cleared, CUSTOMERS, "c_custkey").unionByName(removed), UPDATED)
    return table


def moving_users(spark: SparkSession, sf_dir: str) -> RewriteTable:
    """The users of the change feed, one row each wherever they are: three commits of ten days of events."""
    records = events_feed.user_records(spark, sf_dir)
    path = shared_folder(spark, "users-moving")
    table = RewriteTable(spark, path, events_feed.USERS, buckets=4, global_key=True)
    day = F.col(COMMIT).substr(7, 2).cast("int")
    for number, commit in enumerate((LOADED, INSERTED, UPDATED)):
        table.apply(records.filter(F.least(F.floor((day - 1) / 10), F.lit(2)) == number), commit)
    return table


def customer_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers before and after the second commit, marked by ``version``."""
    table = stored_customers(spark, sf_dir)
    before = table.as_of(LOADED).withColumn("version", F.lit("before"))
    after = table.snapshot().withColumn("version", F.lit("after"))
    return before.unionByName(after).select("version", "c_custkey", "c_acctbal", "c_mktsegment", COMMIT)
