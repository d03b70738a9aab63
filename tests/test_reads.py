import pytest

from rowtide.functions.instants import FIRST_INSTANT, LAST_INSTANT
from rowtide.plans import events_feed as ef
from rowtide.plans import reads
from tests.helpers import USERS, event, plan, records, rows, user

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def three_commits(spark):
    """user1 and user2 at first; then user3 with password4; then user3 with password6."""
    seeds = [event("r", after=user("user1"), pos=1), event("r", after=user("user2", country="ID"), pos=2)]
    return records(
        spark,
        ("20230802091152340", seeds),
        ("20230802091305165", [event("c", after=user("user3", "password4"), pos=3)]),
        ("20230802092010136", [event("u", user("user3", "password4"), user("user3", "password6"), pos=4)]),
    )


def test_three_reads(three_commits):
    columns = ("username", "password")
    assert rows(reads.snapshot(three_commits, USERS), *columns) == [
        ("user1", "p"), ("user2", "p"), ("user3", "password6"),
    ]
    assert rows(reads.incremental(three_commits, USERS, "20230802091305165"), *columns) == [("user3", "password6")]
    assert rows(reads.as_of(three_commits, USERS, "20230802091305165"), *columns) == [
        ("user1", "p"), ("user2", "p"), ("user3", "password4"),
    ]


def test_bounds(three_commits):
    def at(instant):
        return reads.as_of(three_commits, USERS, instant).count()

    # inclusive; 14 digits stand for the whole second
    assert (at("20230802091152339"), at("20230802091152340"), at("20230802091152"), at("20230802091151")) == (0, 2, 2, 0)

    def since(begin):
        return reads.incremental(three_commits, USERS, begin).count()

    # exclusive; 14 digits are before every instant of their second
    assert (since("20230802092010136"), since("20230802092010135"), since("20230802092010")) == (0, 1, 1)


def test_only_the_current_version_is_incremental(three_commits):
    assert rows(reads.incremental(three_commits, USERS, "20230802091200000"), "password") == [("password6",)]


def test_removed_rows_are_not_incremental(spark):
    df = records(
        spark,
        ("20240101000000", [event("c", after=user("a"), pos=1)]),
        ("20240102000000", [event("d", before=user("a"), pos=2)]),
    )
    assert reads.incremental(df, USERS, "20240101000000").count() == 0


def test_dispatch(three_commits):
    assert reads.read(three_commits, USERS).count() == 3
    assert reads.read(three_commits, USERS, begin="20230802091305165").count() == 1
    assert reads.read(three_commits, USERS, instant="20230802091152340").count() == 2
    with pytest.raises(ValueError):
        reads.read(three_commits, USERS, begin=FIRST_INSTANT, instant=LAST_INSTANT)
    with pytest.raises(ValueError):
        reads.read(three_commits, USERS, instant="yesterday")


@pytest.mark.parametrize("policy", ["commit", "event"])
def test_full_ranges_are_the_snapshot(spark, policy):
    df = ef.user_records(spark, SF)
    whole = reads.snapshot(df, ef.USERS, policy=policy).cache()
    for other in (
        reads.incremental(df, ef.USERS, policy=policy),
        reads.as_of(df, ef.USERS, policy=policy),
        reads.as_of(df, ef.USERS, "20240130000000", policy=policy),
    ):
        assert other.exceptAll(whole).count() == 0 and whole.exceptAll(other).count() == 0


@pytest.mark.parametrize("begin", ["20240110000000", "20240125000000000"])
def test_early_filter_of_incremental_changes_nothing(spark, begin):
    df = ef.user_records(spark, SF)
    late_filter = reads.snapshot(df, ef.USERS).filter(f"_commit_time > '{begin}'")
    got = reads.incremental(df, ef.USERS, begin)
    assert got.exceptAll(late_filter).count() == 0 and late_filter.exceptAll(got).count() == 0


def test_bounds_reach_the_scan(spark, tmp_path, three_commits):
    path = str(tmp_path / "records")
    three_commits.write.parquet(path)
    stored = spark.read.parquet(path)
    assert "LessThanOrEqual(_commit_time" in plan(reads.as_of(stored, USERS, "20230802091152"))
    assert "GreaterThan(_commit_time" in plan(reads.incremental(stored, USERS, "20230802091152"))
    # an older commit may hold the current row of an event-ordered table
    assert "GreaterThan(_commit_time" not in plan(reads.incremental(stored, USERS, "20230802091152", policy="event"))


def test_feed_does_not_depend_on_the_bucket_span(spark):
    whole, narrow = ef.change_feed(spark, SF), ef.change_feed(spark, SF, span=16)
    assert whole.exceptAll(narrow).count() == 0 and narrow.exceptAll(whole).count() == 0
    a, b = ef.positioned_feed(spark, SF), ef.positioned_feed(spark, SF, span=16)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
