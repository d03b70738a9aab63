"""Columns about a row's place in the table, the commit timeline, and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowtide.spec import COMMIT, TableSpec

SEQNO, RECORD_KEY, PARTITION_PATH = "_commit_seqno", "_record_key", "_partition_path"
FILE_NAME = "_file_name"

# Hex digits of the key digest that make a numbering group: the rows of a commit are numbered in 65,536 groups.
_DIGEST_DIGITS = 4


def record_key(spec: TableSpec) -> Column:
    if len(spec.record_key) == 1:
        return F.col(spec.record_key[0]).cast("string")
    return F.concat_ws(",", *(F.concat(F.lit(f"{k}:"), F.col(k).cast("string")) for k in spec.record_key))


def partition_path(spec: TableSpec) -> Column:
    return F.concat_ws("/", *(F.concat(F.lit(f"{p}="), F.col(p).cast("string")) for p in spec.partition))


def with_meta(combined: DataFrame, spec: TableSpec) -> DataFrame:
    """Combined records with ``_commit_time, _commit_seqno, _record_key, _partition_path`` in front.

    ``_commit_seqno`` is ``commit_group_number``, unique in a table and the same on every run. The group is the front
    of the key's digest, so the rows of a large commit or of a hot partition are numbered in many tasks.
    """
    rows = combined.withColumns({RECORD_KEY: record_key(spec), PARTITION_PATH: partition_path(spec)})
    rows = rows.withColumn("__digest", F.md5(F.col(RECORD_KEY).cast("binary")))
    rows = rows.withColumn("__group", F.conv(F.substring("__digest", 1, _DIGEST_DIGITS), 16, 10))
    in_group = Window.partitionBy(COMMIT, "__group").orderBy("__digest", RECORD_KEY, PARTITION_PATH)
    seqno = F.concat_ws("_", COMMIT, "__group", F.row_number().over(in_group) - 1)
    rest = [c for c in combined.columns if c != COMMIT]
    return rows.withColumn(SEQNO, seqno).select(COMMIT, SEQNO, RECORD_KEY, PARTITION_PATH, *rest)


def with_read_meta(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows read from a stored table with the columns about them in front, and ``_file_name`` if it was read.

    ``_commit_seqno`` is the commit and the front of the digest of key and partition: it says which change a row is, is
    the same in every read, and needs no numbering, hence no shuffle.
    """
    place = F.concat_ws("/", partition_path(spec), record_key(spec))
    digest = F.substring(F.md5(place.cast("binary")), 1, 16)
    front = [F.col(FILE_NAME)] if FILE_NAME in rows.columns else []
    return rows.select(
        COMMIT,
        F.concat_ws("_", COMMIT, digest).alias(SEQNO),
        record_key(spec).alias(RECORD_KEY),
        partition_path(spec).alias(PARTITION_PATH),
        *front,
        *(c for c in rows.columns if c not in (COMMIT, FILE_NAME)),
    )


def with_file_name(stored: DataFrame) -> DataFrame:
    """Add ``_file_name``, the file each row of a stored table comes from."""
    return stored.withColumn(FILE_NAME, F.col("_metadata.file_name"))


def commits(records: DataFrame) -> DataFrame:
    """The distinct commits. Aggregates before the shuffle, so one row per commit and task moves."""
    return records.select(COMMIT).distinct()


def oldest_of_last(records: DataFrame, keep: int) -> Column:
    """Scalar column: the oldest of the last ``keep`` commits."""
    if keep < 1:
        raise ValueError("at least one commit is kept")
    last = commits(records).orderBy(F.col(COMMIT).desc()).limit(keep)
    return last.agg(F.min(COMMIT)).scalar()


def rows_per_partition(rows: DataFrame, spec: TableSpec) -> DataFrame:
    return rows.groupBy(*spec.partition).agg(F.count(F.lit(1)).alias("rows"))
