"""Files of a byte size, and logs joined into such files."""

import os

import pytest

from rowtide import TableSpec
from rowtide.plans import events_feed as ef
from rowtide.tables import ChangelogTable, RewriteTable, sizing
from tests.helpers import C1, C2, C3, USERS, event, records, rows, user

TARGET = 30_000
C4 = "20240104000000000"


def users(spark, count, commit=C1, start=0):
    """Rows that hardly compress, a third of them in one partition value."""
    return spark.range(start, start + count).selectExpr(
        "concat('u', id) username", "sha2(cast(id as string), 256) password", "cast(id % 2 as int) enabled", "id as ts",
        "case when id % 3 = 0 then 'SG' when id % 7 = 0 then 'ID' else 'MY' end country", "false is_deleted",
        "'log.1' _src_file", "id as _src_pos", "0 as _src_row", f"'{commit}' _commit_time")


def sizes(folder):
    """Bytes of the files per partition value."""
    found = {}
    for where, _, names in os.walk(folder):
        for name in names:
            if name.endswith(".parquet"):
                value = next(p for p in where.split("/") if p.startswith("country="))
                found.setdefault(value, []).append(os.path.getsize(os.path.join(where, name)))
    return found


def check(found, target=TARGET):
    for value, files in found.items():
        small = [s for s in files if not 0.5 * target <= s <= 1.5 * target]
        assert len(small) <= 1 and (not small or small[0] < target), (value, files)


@pytest.mark.parametrize("combine_first", [True, False])
def test_log_files_have_the_size(spark, tmp_path, combine_first):
    table = ChangelogTable(spark, str(tmp_path / "t"), USERS)
    table.append(users(spark, 6000), C1, combine_first=combine_first, file_bytes=TARGET)
    found = sizes(table.log_path)
    check(found)
    assert sum(map(len, found.values())) > 12 and table.snapshot().count() == 6000
    assert not os.path.exists(f"{table.path}/pending") or os.listdir(f"{table.path}/pending") == []


def test_slices_have_the_size(spark, tmp_path):
    table = RewriteTable(spark, str(tmp_path / "t"), USERS)
    table.apply(users(spark, 6000), C1, file_bytes=TARGET)
    check(sizes(table.data_path))
    table.apply(users(spark, 3, C2), C2, file_bytes=TARGET)
    check({k: v for k, v in sizes(table.data_path).items() if k != "country=SG"})
    assert table.snapshot().count() == 6000


def small_commits(spark, path, count=12, each=400):
    table = ChangelogTable(spark, path, USERS)
    commits = [f"202401{d:02}000000000" for d in range(1, count + 1)]
    for n, commit in enumerate(commits):
        # half of the keys are those of the commit before
        table.append(users(spark, each, commit, start=n * each // 2), commit)
    return table, commits


def test_joined_files_read_the_same(spark, tmp_path):
    table, commits = small_commits(spark, str(tmp_path / "t"))
    columns = ["username", "password", "country", "_commit_time"]
    before = {c: rows(table.as_of(c), *columns) for c in (commits[0], commits[4], commits[-1])}
    later = rows(table.incremental(commits[6]), *columns)
    running = table.snapshot()
    path = table.join_files(TARGET)
    check(sizes(path))
    small, large = (sum(map(len, sizes(p).values())) for p in (table.log_path, path))
    assert large < (small - large) / 2
    # a read that was planned before, and new ones
    assert rows(running, *columns) == before[commits[-1]]
    assert {c: rows(table.as_of(c), *columns) for c in before} == before and rows(table.incremental(commits[6]), *columns) == later
    assert all(path.rsplit("/", 1)[1] in f for f in table.snapshot().inputFiles()) and table.commits().count() == 12

    # more commits, a second join, a base in between, retention
    table.append(users(spark, 10, C1, start=9000), "20240120000000000")
    assert table.snapshot().count() == len(before[commits[-1]]) + 10
    table.compact(commits[4])
    assert rows(table.as_of(commits[-1]), *columns) == before[commits[-1]]
    assert table.join_files(TARGET) != path
    assert {c: rows(table.as_of(c), *columns) for c in before} == before
    assert table.retain(3) == commits[-2]
    assert rows(table.as_of(commits[-1]), *columns) == before[commits[-1]] and len(os.listdir(table.log_path)) <= 2
    with pytest.raises(ValueError, match="already"):
        table.append(users(spark, 1, "20240120000000000"), "20240120000000000")


def test_nothing_to_join(spark, tmp_path):
    table = ChangelogTable(spark, str(tmp_path / "t"), USERS)
    assert table.join_files(TARGET) is None
    table.append(users(spark, 5), C1)
    assert table.join_files(TARGET) is None
    table.append(records(spark, (C2, [event("d", before=user("u1", country="MY"), pos=9)])), C2)
    assert table.join_files(TARGET) and table.snapshot().count() == 4


def test_empty_and_unpartitioned(spark, tmp_path):
    spec = TableSpec(USERS.image, ("username",))
    table = ChangelogTable(spark, str(tmp_path / "t"), spec)
    table.append(users(spark, 0), C1, file_bytes=TARGET)
    table.append(users(spark, 3000), C2, file_bytes=TARGET)
    files = [os.path.getsize(os.path.join(w, n)) for w, _, ns in os.walk(table.log_path) for n in ns if n.endswith(".parquet")]
    big = [f for f in files if f > 4000]
    assert all(0.5 * TARGET <= f <= 1.5 * TARGET for f in big) and len(big) > 5
    assert table.snapshot().count() == 3000
    table.append(records(spark, (C3, [event("u", after=user("u1", "p2"), pos=9)]), spec=spec), C3, file_bytes=TARGET)
    assert table.snapshot().filter("password = 'p2'").count() == 1


def test_many_folders_are_dealt_by_hash(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sizing, "SHORT_LIST", 1)
    table = ChangelogTable(spark, str(tmp_path / "t"), USERS)
    table.append(users(spark, 600), C1, file_bytes=TARGET)
    assert table.snapshot().count() == 600 and ef.USERS.scope == USERS.scope
