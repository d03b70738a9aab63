"""Streamed queries over a feed of many events: what a task writes and reads of it has a bound."""

import datetime

import pytest

from rowtide.plans import registry


@pytest.fixture()
def events(spark, tmp_path):
    kinds = ["signup", "view", "error", "purchase"]
    start = datetime.datetime(2024, 1, 1)
    rows = [(i, start + datetime.timedelta(minutes=37 * i), i % 13, kinds[i % 4]) for i in range(1, 801)]
    made = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string")
    made.write.parquet(str(tmp_path / "sf/events.parquet"))
    return str(tmp_path / "sf")


@pytest.mark.parametrize("name", ["stream_redelivered", "stream_upsert_fold", "stream_retention", "stream_refused"])
def test_files_and_their_tasks_are_bounded(spark, events, monkeypatch, name):
    def whole():
        return sorted(map(str, registry.QUERIES[name](spark, events).collect()))

    wanted, folders = whole(), set()
    land = registry.land

    def noted(feed, path):
        folders.add(path)
        land(feed, path)

    monkeypatch.setattr(registry, "land", noted)
    monkeypatch.setattr(registry, "FEED_FILE_ROWS", 100)
    assert whole() == wanted
    (feed,) = folders
    sizes = [r["count"] for r in spark.read.parquet(feed).groupBy("_metadata.file_path").count().collect()]
    assert sum(sizes) == 800 * (2 if name == "stream_redelivered" else 1) and max(sizes) <= 120
