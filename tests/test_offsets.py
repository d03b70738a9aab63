import random

import pytest
from pyspark.sql import functions as F

from rowtide.operators import offsets as o
from rowtide.sources import landed
from tests.helpers import plan, rows

FEED = "topic string, partition int, offset long, timestamp long"


@pytest.fixture(scope="module")
def queue(spark):
    """Partition 0 holds most of the feed and is not ordered by time; partition 2 ends before every time asked for."""
    rnd = random.Random(3)
    messages = [("t", 0, i, 1000 + i + rnd.randrange(-20, 20)) for i in range(500)]
    messages += [("t", 1, i, 1200 + 2 * i) for i in range(100)] + [("t", 2, i, 900) for i in range(7)]
    return messages, spark.createDataFrame(messages, FEED)


@pytest.mark.parametrize(
    "argument, start, end",
    [
        (-1, ("latest", None), ("latest", None)),
        (-2, ("earliest", None), ("latest", None)),
        (0, ("latest", None), ("latest", None)),
        (-7, ("latest", None), ("latest", None)),
        (1_700_000_000, ("time", 1_700_000_000_000), ("time", 1_700_000_000_000)),
        (1_700_000_000_123, ("time", 1_700_000_000_123), ("time", 1_700_000_000_123)),
    ],
)
def test_arguments(argument, start, end):
    assert (o.start_position(argument).kind, o.start_position(argument).millis) == start
    assert (o.end_position(argument).kind, o.end_position(argument).millis) == end


@pytest.mark.parametrize(
    "start, end, bounded",
    [(-1, -1, False), (-2, -1, False), (-2, 1, True), (5, 5, False), (5, 6, True), (6, 5, False), (0, 0, False)],
)
def test_is_bounded(start, end, bounded):
    assert o.is_bounded(start, end) == bounded


def _expected(messages, start, end):
    bounds = {}
    for p in {m[1] for m in messages}:
        mine = [m for m in messages if m[1] == p]
        last = max(m[2] for m in mine) + 1

        def at(t):
            return {-1: last, -2: 0}.get(t) if t < 0 else min((m[2] for m in mine if m[3] >= t), default=last)

        bounds[p] = (at(start), at(end))
    return bounds


@pytest.mark.parametrize("start, end", [(-2, -1), (1100, 1300), (-2, 1250), (1300, -1), (-1, -1), (9999, -1)])
@pytest.mark.parametrize("short", [100_000, 2])
def test_replay_window(queue, start, end, short, monkeypatch):
    monkeypatch.setattr(o, "SHORT_LIST", short)
    messages, feed = queue
    want = _expected(messages, start, end)
    assert {r.partition: (r.lo, r.hi) for r in o.offsets_for(feed, start, end).collect()} == want
    got = o.replay_window(feed, start, end)
    assert got.columns == feed.columns
    inside = sorted(m for m in messages if want[m[1]][0] <= m[2] < want[m[1]][1])
    assert sorted(tuple(r) for r in got.collect()) == inside


def test_seconds_and_milliseconds_are_the_same_time(queue):
    _, feed = queue
    in_millis = feed.withColumn("timestamp", (F.col("timestamp") + 1_700_000_000) * 1000)
    in_seconds = feed.withColumn("timestamp", F.col("timestamp") + 1_700_000_000)
    want = rows(o.offsets_for(in_seconds, 1_700_001_100, 1_700_001_300), "partition", "lo", "hi")
    assert rows(o.offsets_for(in_millis, 1_700_001_100_000, 1_700_001_300), "partition", "lo", "hi") == want


def test_offsets_json(queue):
    messages, feed = queue
    want = {p: lo for p, (lo, _) in _expected(messages, 1250, -1).items()}
    want[2] = -1
    text = "{" + ",".join(f'"{p}":{want[p]}' for p in (0, 1, 2)) + "}"
    assert rows(o.offsets_json(feed, 1250), "topic", "offsets") == [("t", text)]


def test_topics_are_kept_apart(queue):
    messages, feed = queue
    both = feed.unionByName(feed.filter("partition = 1").withColumn("topic", F.lit("u")))
    got = o.replay_window(both, 1250, -1).groupBy("topic").count()
    assert rows(got, "topic")[1] == ("u",)
    assert o.offsets_for(both, 1250, -1).count() == 4


def test_window_filters_the_scan_of_a_landed_feed(spark, tmp_path, queue):
    path = str(tmp_path / "landed")
    queue[1].write.parquet(path)
    text = plan(o.replay_window(spark.read.parquet(path), 1100, 1300))
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text
    assert "GreaterThanOrEqual(offset" in text and "LessThan(offset" in text


def test_feed_without_topic_or_partition(spark, tmp_path):
    path = str(tmp_path / "landed")
    messages = spark.createDataFrame([("a", i, 1000 + i) for i in range(10)], "value string, offset long, timestamp long")
    landed.land(messages, path)
    feed = landed.bounded_landed(spark, path)
    assert o.replay_window(feed, -2, -1).count() == 10
    assert rows(o.replay_window(feed, 1004, 1006), "offset") == [(4,), (5,)]


def test_half_a_second_of_a_feed_in_seconds(spark):
    """A message of 2.7 s is landed as 2, so a window from 2.5 s has to have it."""
    base = 1_700_000_000
    in_seconds = spark.createDataFrame([("t", 0, i, base + i) for i in range(5)], FEED)
    exact = spark.createDataFrame([("t", 0, i, (base + i) * 1000 + 700) for i in range(5)], FEED)
    for feed in (in_seconds, exact):
        assert rows(o.offsets_for(feed, base * 1000 + 2500, -1), "lo", "hi") == [(2, 5)]
    assert o.replay_window(in_seconds, base * 1000 + 9000, -1).count() == 0
