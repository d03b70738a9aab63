"""Streams: redelivered events, views that forget, refused events beside records, late commits, the sink's log."""

import json
import os
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rowtide.operators import decode
from rowtide.sources import landed
from rowtide.streaming import ingest
from rowtide.tables import ChangelogTable
from rowtide.tables.changelog import LateCommit
from tests.helpers import USERS, event, feed, records, rows, user

WAIT = 120


def finish(query):
    assert query.awaitTermination(WAIT), "the stream did not end"
    assert query.exception() is None
    return query


def land(spark, path, *timed):
    """``(seconds, text)`` pairs as one more file of a landed feed."""
    rows_ = spark.createDataFrame([(t, s) for s, t in timed], "value string, timestamp long")
    landed.land(rows_.coalesce(1), path)
    time.sleep(0.05)


# --- redelivery


def start(spark, tmp_path, **options):
    stream = ingest.stream_records(landed.stream_landed(spark, str(tmp_path / "feed"), 1), USERS, **options)
    return finish(ingest.start_changelog(stream, USERS, str(tmp_path / "t"), str(tmp_path / "c"), interval=None, files_per_partition=0))


def test_a_feed_delivered_twice_gives_each_record_once(spark, tmp_path):
    path = str(tmp_path / "feed")
    first = [(100 + i, event("c", after=user(f"u{i}"), pos=i)) for i in range(6)]
    second = [(106 + i, event("u", after=user(f"u{i}", "p2"), pos=50 + i)) for i in range(6)]
    land(spark, path, *first)
    land(spark, path, *first, *second, (110, "{broken"), (110, "{broken"))
    land(spark, path, *second[3:], *first[:2])
    start(spark, tmp_path, redelivered_within="10 minutes", keep_refused=True)
    # after a restart as well
    land(spark, path, *second)
    start(spark, tmp_path, redelivered_within="10 minutes", keep_refused=True)
    table = ChangelogTable(spark, str(tmp_path / "t"), USERS, streamed=True)
    assert rows(table.records(), "username", "password") == sorted((f"u{i}", p) for i in range(6) for p in ("p", "p2"))
    assert [r["_refused_value"] for r in table.refused().collect()] == ["{broken"]


def test_state_of_redelivery_is_bounded_and_late_events_are_counted(spark, tmp_path):
    path = str(tmp_path / "feed")
    for step in range(4):
        land(spark, path, *((10_000 * (step + 1) + i, event("c", after=user(f"u{step}-{i}"), pos=100 * step + i)) for i in range(20)))
    land(spark, path, (5, event("c", after=user("too late"), pos=9999)))
    query = start(spark, tmp_path, redelivered_within="60 seconds")
    progress = [json.loads(p.json) for p in query.recentProgress]
    held = [s["numRowsTotal"] for p in progress for s in p["stateOperators"]]
    assert max(held) <= 40 and held[-1] <= 20
    assert ingest.late_events(query) == 1
    table = ChangelogTable(spark, str(tmp_path / "t"), USERS, streamed=True)
    assert table.snapshot().count() == 80 and table.snapshot().filter("username = 'too late'").count() == 0


def test_batches_are_compared_as_a_whole(spark):
    text = event("c", after=user("a"), pos=7)
    parsed = decode.parse(feed(spark, text, text, "x", "x", None, event("c", after=user("a"), pos=8)), USERS.image)
    assert ingest.drop_redelivered(parsed, "1 hour").count() == 4


# --- a view that forgets


def view_function(**options):
    return ingest.NewestRecord(USERS, [*USERS.columns, "is_deleted", "_src_file", "_src_pos", "_src_row", "_commit_time"],
                               {"enabled", "ts", "_src_pos", "_src_row"}, **options)


class State:
    """What the function sees of a key's state."""

    def __init__(self):
        self.value, self.until, self.hasTimedOut = None, None, False

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value, self.until = value, None

    def remove(self):
        self.value = None

    def setTimeoutTimestamp(self, at):
        self.until = at

    def getCurrentWatermarkMs(self):
        return 0


def test_function_of_a_key():
    run, state = view_function(forget_deleted=1000, forget_idle=None), State()

    def put(millis, *changes):
        frame = pd.DataFrame([
            {**user("a", password, ts=ts), "is_deleted": gone, "_src_file": file, "_src_pos": 1, "_src_row": None,
             "_commit_time": "c", "__millis": millis} for password, ts, gone, file in changes])
        return [r for out in run(("SG", "a"), iter([frame]), state) for r in out.to_dict("records")]

    assert [r["password"] for r in put(5, ("p1", 1, False, "log.9"), ("p0", None, False, "log.99"))] == ["p1"]
    assert state.until is None
    # the number of the log file decides, not its text; an older record puts nothing out
    assert [r["password"] for r in put(6, ("p2", 1, False, "log.10"))] == ["p2"] and put(7, ("old", 1, False, "log.8")) == []
    assert put(20, ("p2", 3, True, "log.11"))[0]["is_deleted"] and state.until == 1020
    # a late record does not revive it, and keeps it marked
    assert put(30, ("late", 2, False, "log.7")) == [] and state.exists and state.until == 1030
    state.hasTimedOut = True
    assert list(run(("SG", "a"), iter([]), state)) == [] and not state.exists


def test_expired_keys_leave_the_state(spark, tmp_path):
    path = str(tmp_path / "feed")
    land(spark, path, *((100, event("c", after=user(f"u{i}", ts=100), pos=i)) for i in range(10)))
    land(spark, path, *((110, event("d", before=user(f"u{i}", ts=110), pos=20 + i)) for i in range(6)))
    land(spark, path, (5_000, event("u", after=user("u9", "p2", ts=5_000), pos=90)))
    land(spark, path, (9_000, event("u", after=user("u9", "p3", ts=9_000), pos=91)))
    stream = ingest.stream_records(landed.stream_landed(spark, path, 1), USERS)
    view = ingest.expiring_view(stream, USERS, F.timestamp_seconds("ts"), "10 seconds", forget_deleted=60_000)
    query = finish(view.writeStream.format("memory").queryName("forgetting").outputMode("update")
                   .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    held = [json.loads(p.json)["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p.stateOperators]
    # ten keys, six of them deleted: these go, the four live ones stay
    assert max(held) == 10 and held[-1] == 4
    last = {}
    for r in spark.table("forgetting").collect():
        if last.get(r["username"]) is None or r["ts"] >= last[r["username"]]["ts"]:
            last[r["username"]] = r
    assert sorted((n, r["password"]) for n, r in last.items() if not r["is_deleted"]) == [("u6", "p"), ("u7", "p"), ("u8", "p"), ("u9", "p3")]
    assert last["u9"]["enabled"] == 1 and sum(r["is_deleted"] for r in last.values()) == 6


# --- refused events


def test_refused_events_are_stored_once(spark, tmp_path):
    path = str(tmp_path / "feed")
    land(spark, path, (100, event("c", after=user("a"), pos=1)), (100, "{broken"), (101, None))
    land(spark, path, (200, event("t", after=user("a"))), (200, event("u", after=user("a", "p2"), pos=2)))

    def run():
        stream = ingest.stream_records(landed.stream_landed(spark, path, 1), USERS, keep_refused=True)
        finish(ingest.start_changelog(stream, USERS, str(tmp_path / "t"), str(tmp_path / "c"), interval=None))

    run()
    table = ChangelogTable(spark, str(tmp_path / "t"), USERS, streamed=True)
    want = [("malformed", "{broken"), ("tombstone", None), ("unknown_op", event("t", after=user("a")))]

    def found():
        return sorted(((r["_refused_reason"], r["_refused_value"]) for r in table.refused().collect()), key=str)

    assert found() == want
    # the last batch was stored but not noted as done, so it runs again
    for name in ("1", ".1.crc"):
        if os.path.exists(marker := str(tmp_path / "c" / "commits" / name)):
            os.unlink(marker)
    run()
    assert found() == want and rows(table.snapshot(), "username", "password") == [("a", "p2")]
    assert table.commits().count() == 2
    table.compact("99991231235959")
    assert found() == want and rows(table.snapshot(), "username", "password") == [("a", "p2")]


def test_a_table_without_refused_events(spark, tmp_path):
    assert ChangelogTable(spark, str(tmp_path / "t"), USERS, streamed=True).refused().count() == 0


# --- late commits


def day_of(seconds):
    return seconds * 86_400


def streamed(spark, tmp_path, policy="commit"):
    commit = F.concat(F.lit("202401"), F.lpad((F.col("timestamp") / 86_400).cast("int").cast("string"), 2, "0"), F.lit("000000000"))
    stream = ingest.stream_records(landed.stream_landed(spark, str(tmp_path / "feed"), 1), USERS, commit)
    finish(ingest.start_changelog(stream, USERS, str(tmp_path / "t"), str(tmp_path / "c"), interval=None, files_per_partition=0))
    return ChangelogTable(spark, str(tmp_path / "t"), USERS, policy=policy, streamed=True)


@pytest.mark.parametrize("policy", ["commit", "event"])
def test_late_commits_do_not_vanish(spark, tmp_path, policy):
    path = str(tmp_path / "feed")
    land(spark, path, (day_of(3), event("c", after=user("a", ts=3), pos=1)), (day_of(5), event("c", after=user("c", ts=5), pos=2)))
    table = streamed(spark, tmp_path, policy)
    table.compact("99991231235959")
    land(spark, path, (day_of(6), event("c", after=user("d", ts=6), pos=3)))
    streamed(spark, tmp_path, policy)
    assert rows(table.snapshot(), "username") == [("a",), ("c",), ("d",)]
    land(spark, path, (day_of(4), event("c", after=user("b", ts=4), pos=4)))
    streamed(spark, tmp_path, policy)
    if policy == "event":
        assert rows(table.snapshot(), "username") == [("a",), ("b",), ("c",), ("d",)]
    else:
        for read in (table.snapshot, lambda: table.compact("99991231235959")):
            with pytest.raises(LateCommit, match="1 records from commit 20240104000000000"):
                read()
        table.reopen("20240104000000000")
        assert rows(table.snapshot(), "username") == [("a",), ("b",), ("c",), ("d",)]
    table.compact("99991231235959")
    assert rows(table.snapshot(), "username") == [("a",), ("b",), ("c",), ("d",)]
    assert table.retain(1) == "20240106000000000" and rows(table.snapshot(), "username") == [("a",), ("b",), ("c",), ("d",)]
    with pytest.raises(LateCommit, match="cannot be folded in"):
        table.reopen("20240104000000000")


def test_commits_are_found_without_a_scan_of_the_log(spark, tmp_path, monkeypatch):
    for day in range(1, 10):
        land(spark, str(tmp_path / "feed"), (day_of(day), event("c", after=user(f"u{day}", ts=day), pos=day)))
    table = streamed(spark, tmp_path)
    opened = []
    real = ChangelogTable._streamed_log
    monkeypatch.setattr(ChangelogTable, "_streamed_log", lambda self, first, last, *a, **k: (opened.append((first[:8], last[:8])), real(self, first, last, *a, **k))[1])
    assert table._last_instants(table.timeline.entries(), 1) == ["20240109000000000"] and opened == [("20240109", "20240109")]
    del opened[:]
    assert table._last_instants(table.timeline.entries(), 3) == [f"2024010{d}000000000" for d in (7, 8, 9)]
    assert opened == [("20240109", "20240109"), ("20240107", "20240108")]
    assert table._last_instants(table.timeline.entries(), 2, "20240104000000") == ["20240103000000000", "20240104000000000"]
    assert table.compact_after(10) is False and table.compact_after(9) is True


# --- the sink's own log


def test_the_sink_forgets_old_files(spark, tmp_path):
    path, conf = str(tmp_path / "feed"), "spark.sql.streaming.fileSink.log.compactInterval"
    spark.conf.set(conf, "2")
    try:
        for day in range(1, 5):
            land(spark, path, (day_of(day), event("c", after=user(f"u{day}", ts=day), pos=day)))
        stream = ingest.stream_records(landed.stream_landed(spark, path, 1), USERS)
        finish(ingest.start_changelog(stream, USERS, str(tmp_path / "t"), str(tmp_path / "c"), interval=None, sink_log_retention="1ms"))
    finally:
        spark.conf.unset(conf)
    log = tmp_path / "t" / "log" / "_spark_metadata"
    (last,) = [n for n in os.listdir(log) if n == "3.compact"]
    assert sum(line.startswith("{") for line in (log / last).read_text().splitlines()) <= 1
