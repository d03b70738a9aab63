import json
import os
import re
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from rowtide.operators import merge
from rowtide.operators.decode import parse
from rowtide.operators.route import to_records
from rowtide.plans import events_feed as ef
from rowtide.sources import landed
from rowtide.streaming import ingest
from rowtide.tables import ChangelogTable, RewriteTable, catalog
from tests.helpers import USERS, event, feed, plan, records, rows, user

SF = "/root/testdata/sf0.001"
WAIT = 120


def finish(query):
    assert query.awaitTermination(WAIT), "the stream did not end"
    assert query.exception() is None


def land_in_files(spark, source, path, files):
    """Land a feed as several files, oldest first."""
    for part in range(files):
        slice_ = source.filter(F.col("number") % files == part)
        landed.land(slice_.coalesce(1), path)
        time.sleep(0.05)


@pytest.fixture(scope="module")
def landed_feed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landed") / "feed")
    source = ef.change_feed(spark, SF).withColumn("number", F.pmod(F.hash("value"), F.lit(3))).persist()
    land_in_files(spark, source, path, 3)
    yield path
    source.unpersist()


def test_stream_fold_is_batch_fold(spark, landed_feed, tmp_path):
    def run():
        stream = landed.stream_landed(spark, landed_feed, max_files_per_trigger=1)
        rows_ = ingest.stream_records(stream, ef.USERS)
        finish(ingest.start_changelog(rows_, ef.USERS, str(tmp_path / "t"), str(tmp_path / "c"), interval=None))

    run()
    table = ChangelogTable(spark, str(tmp_path / "t"), ef.USERS, policy="event", streamed=True)
    want = merge.fold(ef.user_records(spark, SF), ef.USERS, policy="event").drop("_commit_time")
    got = table.snapshot().drop("_commit_time").select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

    # one commit per micro-batch, in the form of an instant
    commits = [r[0] for r in table.commits().collect()]
    files = [f for _, _, names in os.walk(table.log_path) for f in names if f.endswith(".parquet")]
    assert len(files) <= 3 * 3  # micro-batches times partition values
    assert len(commits) == 3 and all(len(c) == 17 and c.isdigit() for c in commits)

    # a restart goes on from the checkpoint: nothing is added, new files are
    before = spark.read.schema(ef.USERS.record_schema).parquet(table.log_path).count()
    run()
    assert spark.read.schema(ef.USERS.record_schema).parquet(table.log_path).count() == before

    table.compact(max(commits))
    again = table.snapshot().drop("_commit_time").select(*want.columns)
    assert again.exceptAll(want).count() == 0 and want.exceptAll(again).count() == 0


def test_later_files_and_replayed_batch(spark, tmp_path):
    path, checkpoint, target = (str(tmp_path / n) for n in ("feed", "checkpoint", "table"))

    def run():
        stream = ingest.stream_records(landed.stream_landed(spark, path), USERS)
        finish(ingest.start_changelog(stream, USERS, target, checkpoint, interval=None))

    landed.land(feed(spark, event("c", after=user("a"), pos=1)), path)
    run()
    landed.land(feed(spark, event("u", after=user("a", "p2"), pos=2), None, "{broken"), path)
    run()
    table = ChangelogTable(spark, target, USERS, streamed=True)
    assert rows(table.snapshot(), "username", "password") == [("a", "p2")]
    commits = sorted(r[0] for r in table.commits().collect())

    # the batch was written but its completion was not noted: it runs again under the same commit, and once
    for name in ("1", ".1.crc"):
        marker = os.path.join(checkpoint, "commits", name)
        if os.path.exists(marker):
            os.unlink(marker)
    time.sleep(1.1)
    run()
    assert sorted(r[0] for r in table.commits().collect()) == commits
    assert spark.read.schema(USERS.record_schema).parquet(table.log_path).count() == 2


def test_streamed_feed_from_text_files(spark, tmp_path):
    folder = tmp_path / "text"
    folder.mkdir()
    (folder / "one.txt").write_text(event("c", after=user("a")) + "\n\n{oops\n")
    stream = ingest.stream_records(landed.stream_text(spark, str(folder), max_files_per_trigger=1), USERS)
    finish(ingest.start_changelog(stream, USERS, str(tmp_path / "t"), str(tmp_path / "c"), interval=None))
    assert ChangelogTable(spark, str(tmp_path / "t"), USERS, streamed=True).snapshot().count() == 1


def test_writing_a_stream_does_not_shuffle(spark, landed_feed):
    batch = to_records(parse(spark.read.schema(landed.LANDED_SCHEMA).parquet(landed_feed), USERS.image), USERS)
    assert "Exchange" not in plan(batch) and plan(batch).count("from_json") == 1


def test_processing_time_and_refresh(spark, landed_feed, tmp_path):
    started = []

    def start():
        stream = ingest.stream_records(landed.stream_landed(spark, landed_feed), ef.USERS)
        query = ingest.start_changelog(
            stream, ef.USERS, str(tmp_path / "t"), str(tmp_path / "c"), interval="200 milliseconds"
        )
        started.append(query)
        if len(started) == 1:
            query.processAllAvailable()
        return query

    ingest.run_refreshing(start, seconds=0.5, rounds=2)
    assert len(started) == 2 and not any(q.isActive for q in started)
    assert started[0].id == started[1].id and started[0].runId != started[1].runId
    table = ChangelogTable(spark, str(tmp_path / "t"), ef.USERS, policy="event", streamed=True)
    assert table.snapshot().count() == 26 and table.commits().count() == 1


def test_rejects_are_counted_per_batch(spark, landed_feed, tmp_path):
    stream = ingest.stream_records(landed.stream_landed(spark, landed_feed), ef.USERS, rejects="rejects")
    query = ingest.start_changelog(stream, ef.USERS, str(tmp_path / "t"), str(tmp_path / "c"), interval=None)
    finish(query)
    seen = [json.loads(p.json)["observedMetrics"]["rejects"] for p in query.recentProgress]
    total = {k: sum(int(s[k]) for s in seen) for k in ("events", "malformed", "tombstone", "unknown_op")}
    assert total == {"events": 1000, "malformed": 10, "tombstone": 9, "unknown_op": 10}


def test_live_view_in_complete_mode(spark, landed_feed):
    stream = ingest.stream_records(landed.stream_landed(spark, landed_feed, max_files_per_trigger=1), ef.USERS)
    view = ingest.live_view(stream, ef.USERS).filter("not is_deleted")
    query = view.writeStream.format("memory").queryName("live").outputMode("complete").trigger(availableNow=True).start()
    finish(query)
    want = merge.fold(ef.user_records(spark, SF), ef.USERS, policy="event")
    assert rows(spark.table("live"), *ef.USERS.columns) == rows(want, *ef.USERS.columns)


CONSOLE = """
import sys
from pyspark.sql import SparkSession
from rowtide.plans import events_feed as ef
from rowtide.sources import landed
from rowtide.streaming import ingest

spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
records = ingest.stream_records(landed.stream_landed(spark, sys.argv[1]), ef.USERS)
ingest.start_console(records, interval=None, rows=3).awaitTermination(100)
spark.stop()
"""


def test_console(landed_feed):
    """In a process of its own: the sink prints from the virtual machine."""
    done = subprocess.run(
        [sys.executable, "-c", CONSOLE, landed_feed], capture_output=True, text=True, timeout=WAIT, cwd=os.path.dirname(os.path.dirname(__file__))
    )
    assert "Batch: 0" in done.stdout and "only showing top 3 rows" in done.stdout
    header = next(line for line in done.stdout.splitlines() if line.startswith("|"))
    assert [c.strip() for c in header.strip("|").split("|")][:5] == ef.USERS.columns
    assert len([line for line in done.stdout.splitlines() if re.match(r"\|user\d", line)]) == 3


def test_streamed_table_is_compacted_and_trimmed(spark, landed_feed, tmp_path):
    path = str(tmp_path / "t")
    stream = landed.stream_landed(spark, landed_feed, max_files_per_trigger=1)
    records_ = ingest.stream_records(stream, ef.USERS, ef.day_of_feed())
    finish(ingest.start_changelog(records_, ef.USERS, path, str(tmp_path / "c"), interval=None))
    table = ChangelogTable(spark, path, ef.USERS, streamed=True)
    want = rows(merge.fold(ef.user_records(spark, SF), ef.USERS), *ef.USERS.columns)
    assert rows(table.snapshot(), *ef.USERS.columns) == want
    days = {n for n in os.listdir(table.log_path) if n.startswith("_commit_day=")}
    assert len(days) == 30 and catalog.register_current(table, "streamed_users") == table.compact("99991231235959")
    assert rows(spark.table("streamed_users"), *ef.USERS.columns) == want
    spark.sql("drop table streamed_users")
    text = plan(table.snapshot())
    assert "PartitionFilters: [isnotnull(_commit_day" in text and ">= 20240130" in text
    assert table.retain(3) == "20240128000000000"
    assert {n for n in os.listdir(table.log_path) if n.startswith("_commit_day=")} == {f"_commit_day=202401{d}" for d in (28, 29, 30)}
    assert rows(table.snapshot(), *ef.USERS.columns) == want and table.commits().count() == 3
    with pytest.raises(ValueError, match="were removed"):
        table.as_of("20240120000000")


def test_tolerant_stream(spark, tmp_path):
    path = str(tmp_path / "feed")
    landed.land(feed(spark, event("c", after=user("a", enabled="1")), event("c", after=user("b", enabled="x"))), path)
    for lenient, found in ((True, [("a", 1)]), (False, [])):
        stream = ingest.stream_records(landed.stream_landed(spark, path), USERS, lenient=lenient)
        target = str(tmp_path / f"t{lenient}")
        finish(ingest.start_changelog(stream, USERS, target, f"{target}-c", interval=None, files_per_partition=0))
        assert rows(ChangelogTable(spark, target, USERS, streamed=True).snapshot(), "username", "enabled") == found


@pytest.mark.parametrize("kind", [RewriteTable, ChangelogTable])
def test_batches_into_a_stored_table(spark, tmp_path, kind):
    """The function a stream calls per micro-batch; starting the stream itself would open a callback port."""
    table = kind(spark, str(tmp_path / "t"), USERS)
    first = records(spark, ("20240101000000000", [event("c", after=user("a"), pos=1)]))
    second = records(spark, ("20240102000000000", [event("u", after=user("a", "p2"), pos=2)]))
    for number, batch in enumerate((first, second, second, first.limit(0))):
        ingest.apply_batch(table, batch, number)
    assert rows(table.snapshot(), "username", "password") == [("a", "p2")]
    assert table.commits().count() == 2
    with pytest.raises(ValueError, match="one commit"):
        ingest.apply_batch(table, first.unionByName(second), 9)
