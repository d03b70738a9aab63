"""Sliced bases, merged reads, changes between versions, global keys."""

import os

import pytest
from pyspark.sql import functions as F

from rowtide.functions import lists
from rowtide.operators import merge
from rowtide.plans import events_feed as ef
from rowtide.plans import reads
from rowtide.tables import ChangelogTable, RewriteTable, folders, slices
from tests.helpers import C1, C2, C3, USERS, event, plan, records, rows, user

SF = "/root/testdata/sf0.001"
C4 = "20240104000000000"


def changes_of(commit, *, up=(), down=(), start=0):
    events = [event("u", after=u, pos=start + i) for i, u in enumerate(up)]
    return commit, events + [event("d", before=u, pos=start + 500 + i) for i, u in enumerate(down)]


def put(spark, table, commit, up=(), down=(), start=0):
    write = table.append if isinstance(table, ChangelogTable) else table.apply
    write(records(spark, changes_of(commit, up=up, down=down, start=start)), commit)


def state(df):
    return rows(df, "country", "username", "password")


def base_files(table):
    return {f for f in table.snapshot().inputFiles() if "/base/" in f}


def everyone(count=200):
    return [user(f"u{i}", country=("SG", "ID", "MY")[i % 3]) for i in range(count)]


@pytest.mark.parametrize("policy", ["commit", "event"])
def test_compaction_touches_only_changed_slices(spark, tmp_path, policy):
    table = ChangelogTable(spark, str(tmp_path / "t"), USERS, policy=policy, buckets=4)
    put(spark, table, C1, everyone())
    table.compact(C1)
    before = base_files(table)
    put(spark, table, C2, [user("u3", "new", ts=2)])
    table.compact(C2)
    after = base_files(table)
    assert len(before) == 12 and len(before - after) == 1 and len(after - before) == 1
    want = sorted((u["country"], u["username"], "new" if u["username"] == "u3" else "p") for u in everyone())
    assert state(table.snapshot()) == want and state(table.as_of(C1)) == sorted((c, u, "p") for c, u, _ in want)
    # the slice written holds its share of the table, not all of it
    (attempt,) = {f.split("_attempt=")[1].split("/")[0] for f in after - before}
    assert 0 < spark.read.parquet(f"{table.base_path}/_attempt={attempt}").count() < 40
    with pytest.raises(ValueError, match="has 4 buckets"):
        ChangelogTable(spark, table.path, USERS, buckets=5)


def test_emptied_slices_stay_empty(spark, tmp_path):
    table = ChangelogTable(spark, str(tmp_path / "t"), USERS, buckets=2)
    put(spark, table, C1, [user("a"), user("b", country="ID")])
    table.compact(C1)
    put(spark, table, C2, down=[user("a")])
    table.compact(C2)
    assert state(table.snapshot()) == [("ID", "b", "p")]
    put(spark, table, C3, down=[user("b", country="ID")])
    table.compact(C3)
    assert table.snapshot().count() == 0 and state(table.as_of(C2)) == [("ID", "b", "p")]
    put(spark, table, C4, [user("a", "again")])
    assert state(table.snapshot()) == [("SG", "a", "again")] and table.retain(1) == C4
    assert state(table.snapshot()) == [("SG", "a", "again")]


def above_base_scan(df):
    """The nodes of the plan from the root down to the scan of the base."""
    found = []

    def walk(node, path):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan(), path)
        if kind.endswith("QueryStageExec"):
            return walk(node.plan(), path)
        if kind == "FileSourceScanExec" and "/base/" in node.relation().location().rootPaths().toString():
            found.append(path)
        for i in range(node.children().size()):
            walk(node.children().apply(i), [*path, kind])

    walk(df._jdf.queryExecution().executedPlan(), [])
    return found


@pytest.mark.parametrize("short", [True, False])
@pytest.mark.parametrize("policy", ["commit", "event"])
def test_reads_merge_base_and_log(spark, tmp_path, monkeypatch, policy, short):
    history = ef.user_records(spark, SF).persist()
    table = ChangelogTable(spark, str(tmp_path / "t"), ef.USERS, policy=policy, buckets=2)
    table.append_history(history)
    table.compact("20240110000000")
    table.compact("20240115000000")
    if not short:
        monkeypatch.setattr(lists, "SHORT_LIST", 0)
    columns = ["username", "country", "password", "enabled", "ts", "_commit_time"]
    for instant in ("20240112000000", "20240115000000", "20240116000000", "20240130000000"):
        want = reads.as_of(history, ef.USERS, instant, policy=policy)
        assert rows(table.as_of(instant), *columns) == rows(want, *columns)
    want = reads.incremental(history, ef.USERS, "20240105000000", policy=policy)
    assert rows(table.incremental("20240105000000"), *columns) == rows(want, *columns)
    if short:
        scans = above_base_scan(table.snapshot())
        # with event order the few rows of the log's keys are folded; all others pass without an exchange
        passing = [s for s in scans if not any("Exchange" in k and k != "BroadcastExchangeExec" for k in s)]
        assert scans and len(passing) == len(scans) - (policy == "event")
    history.unpersist()


def test_a_log_of_many_keys_folds_only_its_slices(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lists, "SHORT_LIST", 0)
    table = ChangelogTable(spark, str(tmp_path / "t"), USERS, buckets=4)
    put(spark, table, C1, everyone())
    table.compact(C1)
    put(spark, table, C2, [user("u3", "new", ts=2), user("u6", "new", ts=2)])
    scans = above_base_scan(table.snapshot())
    shuffled = [any("ShuffleExchange" in k for k in s) for s in scans]
    assert sorted(shuffled) == [False, True]
    assert [r for r in state(table.snapshot()) if r[2] == "new"] == [("SG", "u3", "new"), ("SG", "u6", "new")]


def test_unpartitioned_and_many_slices(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(slices, "MOST_PATHS", 1)
    spec = type(USERS)(USERS.image, ("username",))
    table = ChangelogTable(spark, str(tmp_path / "t"), spec, buckets=5)
    for commit, password in ((C1, "p"), (C2, "q")):
        users = [user(f"u{i}", password) for i in range(30 if commit == C1 else 3)]
        table.append(records(spark, changes_of(commit, up=users), spec=spec), commit)
        table.compact(commit)
    want = sorted((f"u{i}", "q" if i < 3 else "p") for i in range(30))
    assert rows(table.snapshot(), "username", "password") == want
    assert table.retain(1) == C2 and rows(table.snapshot(), "username", "password") == want


# --- changes between versions


@pytest.fixture(params=["changelog", "compacted", "rewrite"])
def table(request, spark, tmp_path):
    if request.param == "rewrite":
        return RewriteTable(spark, str(tmp_path / "t"), USERS, buckets=3)
    return ChangelogTable(spark, str(tmp_path / "t"), USERS, buckets=2)


def changed(df):
    return sorted(
        (r.change, r.before and (r.before.country, r.before.username, r.before.password),
         r.after and (r.after.country, r.after.username, r.after.password)) for r in df.collect()
    )


def test_changes_between_versions(spark, table, request):
    put(spark, table, C1, [user("a"), user("b"), user("c", country="ID")])
    if "compacted" in request.node.name:
        table.compact(C1)
    put(spark, table, C2, [user("a", "p2"), user("d")], down=[user("b")])
    put(spark, table, C3, [user("b", "back")], down=[user("d"), user("c", country="ID")], start=20)
    if "compacted" in request.node.name:
        table.compact(C2)
    first = [("delete", ("SG", "b", "p"), None), ("insert", None, ("SG", "d", "p")), ("update", ("SG", "a", "p"), ("SG", "a", "p2"))]
    both = [("delete", ("ID", "c", "p"), None), ("update", ("SG", "a", "p"), ("SG", "a", "p2")), ("update", ("SG", "b", "p"), ("SG", "b", "back"))]
    assert changed(table.changes(C1, C2)) == first
    assert changed(table.changes(C1)) == changed(table.changes(C1[:14], C3)) == both
    assert changed(table.changes(C3)) == changed(table.changes(C2, C2)) == []
    assert [c[0] for c in changed(table.changes("20230101000000", C1))] == ["insert"] * 3
    assert table.retain(2) == C2
    assert [c[0] for c in changed(table.changes(C2))] == ["delete", "delete", "insert"]
    with pytest.raises(ValueError, match="were removed"):
        table.changes(C1)


def test_changes_open_only_rewritten_slices(spark, tmp_path):
    table = RewriteTable(spark, str(tmp_path / "t"), USERS, buckets=4)
    put(spark, table, C1, everyone())
    put(spark, table, C2, [user("u3", "new", ts=2)])
    files = table.changes(C1).inputFiles()
    assert len(files) == 2 and changed(table.changes(C1)) == [("update", ("SG", "u3", "p"), ("SG", "u3", "new"))]


# --- global keys


@pytest.mark.parametrize("kind", [ChangelogTable, RewriteTable])
def test_global_key_finds_the_row_anywhere(spark, tmp_path, kind):
    table = kind(spark, str(tmp_path / "t"), USERS, buckets=3, global_key=True)
    put(spark, table, C1, [user(n, country=c) for n, c in (("a", "SG"), ("b", "ID"), ("c", "MY"))])
    if kind is ChangelogTable:
        table.compact(C1)
    # no before image says where the rows were
    put(spark, table, C2, [user("a", "moved", country="ID"), user("b", "same", country="ID")])
    assert state(table.snapshot()) == [("ID", "a", "moved"), ("ID", "b", "same"), ("MY", "c", "p")]
    assert changed(table.changes(C1))[0] == ("update", ("ID", "b", "p"), ("ID", "b", "same"))
    assert ("update", ("SG", "a", "p"), ("ID", "a", "moved")) in changed(table.changes(C1))
    if kind is ChangelogTable:
        table.compact(C2)
    put(spark, table, C3, down=[user("a", country="nowhere"), user("c", country="MY")])
    assert state(table.snapshot()) == [("ID", "b", "same")] and table.as_of(C1).count() == 3
    assert table.retain(1) == C3 and state(table.snapshot()) == [("ID", "b", "same")]


def test_stored_moves_are_the_global_fold(spark, tmp_path):
    history = ef.user_records(spark, SF)
    table = ChangelogTable(spark, str(tmp_path / "t"), ef.USERS, buckets=3, global_key=True)
    table.append_history(history)
    table.compact("20240110000000")
    want = merge.fold(history, ef.USERS, by_partition=False)
    assert rows(table.snapshot(), "username", "country", "password") == rows(want, "username", "country", "password")


# --- jobs and listings


class Listings:
    def __init__(self, monkeypatch):
        self.paths = []
        real = folders.children
        monkeypatch.setattr(folders, "children", lambda spark, path: (self.paths.append(path), real(spark, path))[1])

    def of(self, end):
        return sum(p.endswith(end) for p in self.paths)


def test_history_lists_the_timeline_once(spark, tmp_path, monkeypatch):
    table = ChangelogTable(spark, str(tmp_path / "t"), ef.USERS)
    history = ef.user_records(spark, SF)
    seen = Listings(monkeypatch)
    table.append_history(history)
    # once to check the commits, once to enter them
    assert table.commits().count() == 30 and seen.of("/timeline") == 3


def test_history_with_a_commit_below_the_base_is_refused_whole(spark, tmp_path):
    table = ChangelogTable(spark, str(tmp_path / "t"), USERS)
    put(spark, table, C3, [user("a")])
    table.compact(C3)
    both = records(spark, changes_of(C2, up=[user("b")]), changes_of(C4, up=[user("c")]))
    with pytest.raises(ValueError, match="before the last commit"):
        table.append_history(both)
    assert rows(table.commits(), "_commit_time") == [(C3,)] and state(table.snapshot()) == [("SG", "a", "p")]


def jobs(spark, run):
    """How many jobs a call starts."""
    tracker, group = spark.sparkContext.statusTracker(), f"count-{os.urandom(4).hex()}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(tracker.getJobIdsForGroup(group))


def test_a_commit_is_few_jobs(spark, tmp_path):
    table = RewriteTable(spark, str(tmp_path / "t"), USERS, buckets=2)
    loaded = records(spark, changes_of(C1, up=everyone())).persist()
    loaded.count()
    first = jobs(spark, lambda: table.apply(loaded, C1))
    later = jobs(spark, lambda: table.apply(records(spark, changes_of(C2, up=[user("u3", "new")])), C2))
    assert first <= 6 and later <= 12
    assert "Join" not in plan(table.snapshot())
    assert table.snapshot().filter(F.col("_commit_time") == C2).count() == 1
    loaded.unpersist()
