import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide import TableSpec
from rowtide.functions import lists
from rowtide.plans import events_feed as ef
from rowtide.plans import reads
from rowtide.plans.business_tables import as_records
from rowtide.tables import ChangelogTable, RewriteTable, catalog, changelog, folders, slices
from tests.helpers import C1, C2, C3, USERS, event, plan, records, rows, user

SF = "/root/testdata/sf0.001"
C4 = "20240104000000000"


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def upserts(spark, *users, start=0, commit=C1):
    return records(spark, (commit, [event("u", after=u, pos=start + i) for i, u in enumerate(users)]))


def removal(spark, *users, start=100):
    return records(spark, (C1, [event("d", before=u, pos=start + i) for i, u in enumerate(users)]))


@pytest.fixture(params=["changelog", "rewrite"])
def table(request, spark, tmp_path):
    if request.param == "changelog":
        made = ChangelogTable(spark, str(tmp_path / "t"), USERS)
        made.put = made.append
    else:
        made = RewriteTable(spark, str(tmp_path / "t"), USERS, buckets=3)
        made.put = made.apply
    return made


def state(df):
    return rows(df, "country", "username", "password")


def test_versions(spark, table):
    table.put(upserts(spark, user("a"), user("b", country="ID")), C1)
    table.put(upserts(spark, user("a", "p2"), user("c")), C2)
    table.put(removal(spark, user("a"), user("b", country="ID")), C3)
    first = [("ID", "b", "p"), ("SG", "a", "p")]
    second = [("ID", "b", "p"), ("SG", "a", "p2"), ("SG", "c", "p")]
    third = [("SG", "c", "p")]
    assert [state(table.as_of(c)) for c in (C1, C2, C3)] == [first, second, third]
    assert state(table.as_of(C2[:14])) == second and state(table.as_of("20231231000000")) == []
    assert state(table.snapshot()) == third
    assert state(table.incremental(C1)) == third and state(table.incremental(C2)) == []
    assert rows(table.commits(), "_commit_time") == [(C1,), (C2,), (C3,)]


def test_repeating_a_commit_changes_nothing(spark, table):
    table.put(upserts(spark, user("a"), user("b")), C1)
    for _ in range(2):
        table.put(upserts(spark, user("a", "p2")), C2)
        assert state(table.snapshot()) == [("SG", "a", "p2"), ("SG", "b", "p")]
        assert state(table.as_of(C1)) == [("SG", "a", "p"), ("SG", "b", "p")]
    assert table.commits().count() == 2


def test_commits_do_not_go_back(spark, table):
    table.put(upserts(spark, user("a")), C2)
    with pytest.raises(ValueError, match="before the last commit"):
        table.put(upserts(spark, user("a")), C1)


def test_delete_on_an_empty_table_and_emptied_partition(spark, table):
    table.put(removal(spark, user("a")), C1)
    assert state(table.snapshot()) == []
    table.put(upserts(spark, user("a"), user("b", country="ID")), C2)
    table.put(removal(spark, user("a")), C3)
    table.put(upserts(spark, user("b", "p2", country="ID")), C4)
    assert state(table.snapshot()) == [("ID", "b", "p2")]


@pytest.mark.parametrize("bad", [{"country": ""}, {"country": None}, {"name": None}])
def test_records_without_key_fail_the_commit(spark, table, bad):
    table.put(upserts(spark, user("a")), C1)
    broken = upserts(spark, user("b")).withColumns(
        {"username" if k == "name" else k: F.lit(v).cast("string") for k, v in bad.items()}
    )
    with pytest.raises(Exception, match="record without"):
        table.put(broken, C2)
    assert state(table.snapshot()) == [("SG", "a", "p")]


def test_odd_partition_values(spark, table):
    odd = ["a/b=c", "x y", "%", "Ж", "1", "null"]
    table.put(upserts(spark, *(user("u", country=c) for c in odd)), C1)
    table.put(upserts(spark, *(user("u", "p2", country=c) for c in odd)), C2)
    assert state(table.snapshot()) == sorted((c, "u", "p2") for c in odd)
    assert state(table.as_of(C1)) == sorted((c, "u", "p") for c in odd)


@pytest.mark.parametrize("kind", [ChangelogTable, RewriteTable])
def test_unpartitioned_table(spark, tmp_path, kind):
    spec = TableSpec(USERS.image, ("username",))
    table = kind(spark, str(tmp_path / "t"), spec)
    put = table.append if kind is ChangelogTable else table.apply
    put(records(spark, (C1, [event("c", after=user("a")), event("c", after=user("b"))]), spec=spec), C1)
    put(records(spark, (C2, [event("u", after=user("a", country="ID"), pos=1)]), spec=spec), C2)
    assert state(table.snapshot()) == [("ID", "a", "p"), ("SG", "b", "p")]
    assert state(table.as_of(C1)) == [("SG", "a", "p"), ("SG", "b", "p")]
    assert table.retain(1) == C2
    assert state(table.snapshot()) == [("ID", "a", "p"), ("SG", "b", "p")]


def test_new_table_is_empty(spark, table):
    assert table.snapshot().count() == 0 and table.commits().count() == 0


def test_half_written_commits_are_not_seen(spark, table):
    table.put(upserts(spark, user("a")), C1)
    table.put(upserts(spark, user("a", "p2")), C2)
    # as if the job had died before entering the second commit
    table.timeline.forget([e for e in table.timeline.entries() if e.instant != C2])
    assert state(table.snapshot()) == [("SG", "a", "p")]
    table.put(upserts(spark, user("a", "p3")), C3)
    assert state(table.snapshot()) == [("SG", "a", "p3")]


def test_retention(spark, table):
    for number, commit in enumerate((C1, C2, C3, C4)):
        table.put(upserts(spark, user("a", f"p{number}"), user(f"u{number}", country="ID")), commit)
    want = {c: state(table.as_of(c)) for c in (C3, C4)}
    before = _data_folders(table)
    assert table.retain(2) == C3
    assert {c: state(table.as_of(c)) for c in (C3, C4)} == want
    assert state(table.snapshot()) == want[C4]
    with pytest.raises(ValueError, match="were removed"):
        table.as_of(C2)
    assert not before <= _data_folders(table)
    assert rows(table.commits(), "_commit_time") == [(C3,), (C4,)]
    table.put(upserts(spark, user("a", "p9")), "20240105000000000")
    assert ("SG", "a", "p9") in state(table.snapshot())


def test_long_lists_are_not_broadcast(spark, tmp_path, monkeypatch):
    table = RewriteTable(spark, str(tmp_path / "t"), USERS, buckets=3)
    table.put = table.apply
    monkeypatch.setattr(slices, "MOST_PATHS", 0)
    monkeypatch.setattr(lists, "SHORT_LIST", 0)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table.put(upserts(spark, user("a"), user("b", country="ID")), C1)
        table.put(upserts(spark, user("a", "p2")), C2)
        assert state(table.snapshot()) == [("ID", "b", "p"), ("SG", "a", "p2")]
        assert "BroadcastHashJoin" not in plan(table.snapshot())
        monkeypatch.setattr(lists, "SHORT_LIST", 10)
        assert "BroadcastHashJoin" in plan(table.snapshot())
        assert state(table.snapshot()) == [("ID", "b", "p"), ("SG", "a", "p2")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_retention_waits_for_enough_commits(spark, table):
    """Of more than three commits, the last two are kept."""
    kept = []
    for commit in (C1, C2, C3, C4, "20240105000000000"):
        table.put(upserts(spark, user("a", commit)), commit)
        kept.append(table.retain(2, above=3))
    assert kept == [None, None, None, C3, None]
    assert state(table.as_of(C3)) == [("SG", "a", C3)]


def test_incremental_from_any_commit(spark, table):
    for number, commit in enumerate((C1, C2, C3)):
        table.put(upserts(spark, user(f"u{number}"), user("all", commit), country_user(number)), commit)
    if isinstance(table, ChangelogTable):
        table.compact(C2)
    whole = table.snapshot()
    for begin in ("19700101000000", C1, C2, C3):
        assert same(table.incremental(begin), whole.filter(F.col("_commit_time") > begin))
    if isinstance(table, ChangelogTable):
        assert any("/base/" in f for f in table.incremental(C1).inputFiles())
        assert not any("/base/" in f for f in table.incremental(C2).inputFiles())


def country_user(number):
    return user("mover", country=f"C{number}")


def _data_folders(table):
    parent = table.log_path if isinstance(table, ChangelogTable) else table.data_path
    return set(os.listdir(parent))


# --- changelog only --------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("policy", ["commit", "event"])
def test_compaction_is_invisible(spark, tmp_path, policy):
    history = ef.user_records(spark, SF).persist()
    table = ChangelogTable(spark, str(tmp_path / "t"), ef.USERS, policy=policy)
    table.append_history(history)
    instants = ("20240105000000", "20240115000000", "20240130000000")
    want = [reads.as_of(history, ef.USERS, i, policy=policy).select("username", "country", "password").cache() for i in instants]
    for compacted in (None, "20240110000000", "20240120000000"):
        if compacted:
            table.compact(compacted)
        for instant, expected in zip(instants, want):
            assert same(table.as_of(instant).select(*expected.columns), expected)
    assert same(table.snapshot().select(*want[-1].columns), want[-1])
    assert same(table.incremental("20240125000000").drop("country"), reads.incremental(history, ef.USERS, "20240125000000", policy=policy).drop("country"))
    assert table.commits().count() == 30


def test_reads_after_compaction_leave_the_old_log_alone(spark, tmp_path):
    table = ChangelogTable(spark, str(tmp_path / "t"), USERS)
    for commit in (C1, C2, C3):
        table.append(upserts(spark, user("a", commit)), commit)
    table.compact(C2)
    files = table.snapshot().inputFiles()
    assert len(files) == 2 and sum("/base/" in f for f in files) == 1 and sum(f"/log/_slice={C3}." in f for f in files) == 1
    assert all(f"/log/_slice={C1}." in f for f in table.as_of(C1).inputFiles())


def test_compaction_after_every_second_commit(spark, tmp_path):
    table = ChangelogTable(spark, str(tmp_path / "t"), USERS)
    done = []
    for commit in (C1, C2, C3, C4):
        table.append(upserts(spark, user("a", commit)), commit)
        done.append(table.compact_after(2))
    assert done == [False, True, False, True]
    assert [e.instant for e in table.timeline.entries() if e.action == "compacted"] == [C2, C4]
    assert state(table.as_of(C3)) == [("SG", "a", C3)] and state(table.snapshot()) == [("SG", "a", C4)]


def test_compacted_commits_are_final(spark, tmp_path):
    table = ChangelogTable(spark, str(tmp_path / "t"), USERS)
    for commit in (C1, C2):
        table.append(upserts(spark, user("a", commit)), commit)
    table.compact(C2)
    table.compact(C2)
    with pytest.raises(ValueError, match="already compacted"):
        table.append(upserts(spark, user("a", "other")), C2)
    assert table.retain(1) == C2
    assert state(table.snapshot()) == [("SG", "a", C2)]


def test_uncombined_log_reads_the_same(spark, tmp_path):
    batch = upserts(spark, user("a", "p1", ts=1), user("a", "p3", ts=3), user("a", "p2", ts=2), user("b"))
    tables = [ChangelogTable(spark, str(tmp_path / name), USERS) for name in ("x", "y")]
    for table, combine_first in zip(tables, (True, False)):
        table.append(batch, C1, combine_first=combine_first)
    assert [t.records().count() for t in tables] == [2, 4]
    assert state(tables[0].snapshot()) == state(tables[1].snapshot()) == [("SG", "a", "p3"), ("SG", "b", "p")]


def test_compaction_between_commits_of_one_second(spark, tmp_path):
    table = ChangelogTable(spark, str(tmp_path / "t"), USERS)
    table.append(upserts(spark, user("a")), "20240101000000100")
    table.compact("20240101000000")
    table.append(upserts(spark, user("a", "later")), "20240101000000500")
    assert state(table.snapshot()) == [("SG", "a", "later")]


def test_files_are_capped(spark, tmp_path):
    table = ChangelogTable(spark, str(tmp_path / "t"), USERS)
    table.append(upserts(spark, *(user(f"u{i}") for i in range(100))), C1, max_records_per_file=10)
    assert table.snapshot().count() == 100
    assert sum(len([f for f in fs if f.endswith(".parquet")]) for _, _, fs in os.walk(table.log_path)) >= 10


def test_layout_and_file_names(spark, tmp_path):
    table = ChangelogTable(spark, str(tmp_path / "t"), USERS)
    table.append(upserts(spark, user("a"), user("b", country="ID")), C1)
    (entry,) = table.timeline.entries()
    written = f"{table.log_path}/_slice={C1}.{entry.attempt}"
    assert sorted(f for f in os.listdir(written) if "=" in f) == ["country=ID", "country=SG"]
    table.compact(C1)
    table.append(upserts(spark, user("a", "p2")), C2)
    named = ChangelogTable(spark, table.path, USERS, file_names=True).snapshot()
    assert named.filter("_file_name like 'part-%.parquet'").count() == 2
    assert named.select("_file_name").distinct().count() == 2


def test_added_column(spark, tmp_path):
    wider = TableSpec(T.StructType([*USERS.image.fields, T.StructField("number", T.IntegerType())]), ("username",), ("country",))
    path = str(tmp_path / "t")
    ChangelogTable(spark, path, USERS).append(upserts(spark, user("user1")), C1)
    table = ChangelogTable(spark, path, wider)
    table.append(records(spark, (C2, [event("c", after=user("user3", number=50))]), spec=wider), C2)
    assert rows(table.snapshot(), "username", "number") == [("user1", None), ("user3", 50)]


def test_streamed_log_refuses_batches(spark, tmp_path):
    table = ChangelogTable(spark, str(tmp_path / "t"), USERS, streamed=True)
    for refused in (lambda: table.append(upserts(spark, user("a")), C1), lambda: table.append_history(upserts(spark, user("a")))):
        with pytest.raises(ValueError):
            refused()


def test_catalog(spark, tmp_path):
    table = ChangelogTable(spark, str(tmp_path / "it's t"), USERS)
    table.append(upserts(spark, user("a"), user("b", country="ID")), C1)
    catalog.register_view(table.snapshot(), "users_now")
    assert spark.sql("select count(*) from users_now where country = 'ID'").first()[0] == 1
    assert catalog.register_current(table, "users_stored") == table.compact(C1)
    table.append(upserts(spark, user("a", "p2")), C2)
    table.append(removal(spark, user("b", country="ID")), C3)
    assert rows(spark.sql("select * from users_stored"), "username", "password") == [("a", "p"), ("b", "p")]
    catalog.register_current(table, "users_stored")
    assert rows(spark.sql("select * from users_stored where country = 'SG'"), "username", "password") == [("a", "p2")]
    assert catalog.live_rows(spark, "users_stored").count() == 1
    spark.sql("drop table users_stored")
    assert catalog.register_current(ChangelogTable(spark, str(tmp_path / "none"), USERS), "nothing") is None


# --- rewrite only ----------------------------------------------------------------------------------------------------


def test_untouched_slices_keep_their_files(spark, tmp_path):
    table = RewriteTable(spark, str(tmp_path / "t"), USERS, buckets=8, file_names=True)
    table.apply(upserts(spark, *(user(f"u{i}", country=c) for i in range(60) for c in ("SG", "ID"))), C1)
    before = _files(table)
    table.apply(upserts(spark, user("u7", "new")), C2)
    after = _files(table)
    changed = {k for k in after if after[k] != before[k]}
    assert len(before) == 120 and set(after) == set(before)
    assert ("SG", "u7") in changed and all(country == "SG" for country, _ in changed)
    assert 0 < len(changed) < 30
    assert table.snapshot().filter(F.col("_commit_time") == C2).count() == 1


def _files(table):
    return {(r.country, r.username): r._file_name for r in table.snapshot().collect()}


def test_only_live_folders_are_scanned(spark, tmp_path):
    table = RewriteTable(spark, str(tmp_path / "t"), USERS, buckets=2)
    everyone = [user(f"u{i}", country=c) for i in range(40) for c in ("SG", "ID", "MY")]
    table.apply(upserts(spark, *everyone), C1)
    for commit, country in ((C2, "SG"), (C3, "ID"), (C4, "SG")):
        table.apply(upserts(spark, user("u1", commit, country=country)), commit)
    assert scanned(table.snapshot()) == (120, 120)
    assert scanned(table.as_of(C1)) == (120, 120)
    assert table.retain(1) == C4
    assert scanned(table.snapshot()) == (120, 120)
    # what is stored is what is read
    assert spark.read.parquet(table.data_path).count() == 120


def scanned(df):
    """Rows of the result, and rows its scans of data files put out."""
    count = len(df.collect())

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        below = [walk(node.children().apply(i)) for i in range(node.children().size())]
        own = 0
        if kind == "FileSourceScanExec" and "_slice" in node.metadata().toString() and "PartitionFilters" in node.toString():
            if "/data" in node.relation().location().rootPaths().toString():
                own = node.metrics().apply("numOutputRows").value()
        return own + sum(below)

    return count, walk(df._jdf.queryExecution().executedPlan())


def test_bucket_count_is_stored(spark, tmp_path):
    path = str(tmp_path / "t")
    RewriteTable(spark, path, USERS, buckets=2).apply(upserts(spark, *(user(f"u{i}") for i in range(20))), C1)
    with pytest.raises(ValueError, match="has 2 buckets"):
        RewriteTable(spark, path, USERS, buckets=64)
    again = RewriteTable(spark, path, USERS)
    again.apply(upserts(spark, *(user(f"u{i}", "p2") for i in range(5))), C2)
    assert again.buckets == 2 and again.snapshot().count() == 20


@pytest.mark.parametrize("combine_first", [True, False])
def test_failed_repeat_leaves_the_commit(spark, table, combine_first):
    options = {"combine_first": combine_first} if isinstance(table, ChangelogTable) else {}
    table.put(upserts(spark, *(user(f"u{i}") for i in range(20))), C1, **options)
    want = state(table.snapshot())
    broken = upserts(spark, *(user(f"u{i}", "new") for i in range(20))).withColumn(
        "password", F.when(F.col("username") == "u7", F.raise_error(F.lit("boom"))).otherwise(F.col("password"))
    )
    with pytest.raises(Exception, match="boom"):
        table.put(broken, C1, **options)
    assert len(want) == 20 and state(table.snapshot()) == want


def test_history_twice_is_history_once(spark, tmp_path):
    table = ChangelogTable(spark, str(tmp_path / "t"), USERS)
    history = upserts(spark, user("a"), user("b")).unionByName(upserts(spark, user("a", "p2")).withColumn("_commit_time", F.lit(C2)))
    for _ in range(2):
        table.append_history(history)
        assert table.records().count() == 3 and state(table.snapshot()) == [("SG", "a", "p2"), ("SG", "b", "p")]
    table.append_history(history.limit(0))
    assert rows(table.commits(), "_commit_time") == [(C1,), (C2,)]


def test_meta_columns_of_reads(spark, table):
    table.put(upserts(spark, user("a"), user("b", country="ID")), C1)
    table.put(upserts(spark, user("a", "p2")), C2)
    for read in (table.snapshot(meta=True), table.as_of(C2, meta=True)):
        assert read.columns[:5] == ["_commit_time", "_commit_seqno", "_record_key", "_partition_path", "_file_name"]
        assert rows(read, "_commit_time", "_record_key", "_partition_path") == [(C1, "b", "country=ID"), (C2, "a", "country=SG")]
        assert read.select("_commit_seqno").distinct().count() == 2 and read.filter("_file_name like 'part-%'").count() == 2
    assert rows(table.incremental(C1, meta=True), "_record_key") == [("a",)]


def test_overwrite_from_the_table_itself(spark, tmp_path):
    table = RewriteTable(spark, str(tmp_path / "t"), USERS, buckets=2)
    table.apply(upserts(spark, user("a"), user("b")), C2)
    table.apply(table.snapshot().withColumn("password", F.lit("again")), C1, overwrite=True)
    assert state(table.snapshot()) == [("SG", "a", "again"), ("SG", "b", "again")]
    assert rows(table.commits(), "_commit_time") == [(C1,)]
    assert spark.read.parquet(table.data_path).count() == 2
    with pytest.raises(Exception, match="record without"):
        table.apply(table.snapshot().withColumn("country", F.lit("")), C3, overwrite=True)
    assert table.snapshot().count() == 2


def test_overwrite_starts_anew(spark, tmp_path):
    table = RewriteTable(spark, str(tmp_path / "t"), USERS)
    table.apply(upserts(spark, user("a")), C2)
    table.apply(upserts(spark, user("b")), C1, overwrite=True)
    assert state(table.snapshot()) == [("SG", "b", "p")]


def test_round_trip_of_two_hundred_keys(spark, tmp_path):
    """100 keys, 100 more, ten of them updated: 200 rows in three commits."""
    spec = TableSpec(ef.USERS.image, ("username",), ("country",))
    table = RewriteTable(spark, str(tmp_path / "t"), spec, buckets=2)
    keys = spark.range(200).selectExpr(
        "id", "concat('k', id) username", "'old' password", "1 enabled", "id ts", "if(id % 2 = 0, 'SG', 'ID') country"
    )
    table.apply(as_records(keys.filter("id < 100"), spec, "id"), C1, overwrite=True)
    table.apply(as_records(keys.filter("id >= 100"), spec, "id"), C2)
    ten = keys.orderBy("id").limit(10).withColumn("password", F.lit("new"))
    table.apply(as_records(ten, spec, "id"), C3)
    assert (table.snapshot().count(), table.commits().count()) == (200, 3)
    assert table.snapshot().filter("password = 'new'").count() == 10


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = folders.shared_folder(spark, "x"), folders.shared_folder(spark, "x")
    assert one.startswith(root) and one != two
