"""Files of a byte size.

How many bytes a row takes is measured on rows that are written once, as many as a file should hold. Rows are then dealt to
as many partitions per folder as make files of that size, each partition to one file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.functions.lists import SHORT_LIST
from rowtide.tables import folders

# Rows of the first trial file, and of any: what is measured is bounded.
FIRST_TRIAL, LARGEST_TRIAL = 1000, 200_000


def bytes_per_row(rows: DataFrame, target: int, scratch: str) -> float:
    """What a row takes in a Parquet file of about ``target`` bytes, 0 if there is none. ``scratch`` is removed again."""
    spark, wanted, found = rows.sparkSession, FIRST_TRIAL, 0.0
    for trial in range(2):
        path = f"{scratch}/{trial}"
        some = rows.limit(wanted)
        some.coalesce(1).write.parquet(path)
        count = spark.read.schema(some.schema).parquet(path).count()
        size = folders.file_bytes(spark, path)
        folders.remove(spark, path)
        if not count:
            return 0.0
        found = size / count
        wanted = max(1, min(LARGEST_TRIAL, int(target / found)))
        if count < FIRST_TRIAL or wanted <= count:
            break
    return found


def deal(rows: DataFrame, by: Sequence[str], key: Sequence[str], target: int, scratch: str) -> DataFrame:
    """The rows dealt so that each partition is a file of about ``target`` bytes of one folder, whose columns are ``by``.

    A folder's rows are split evenly by a hash of ``key`` into ``round(size / target)`` files, one at least: all are between
    two thirds and three halves of the target, but for a folder that has less than that. The driver sees a row per folder;
    beyond ``SHORT_LIST`` folders every folder is one partition's share, by hash.
    """
    size = bytes_per_row(rows, target, scratch)
    counted = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("__rows")) if by else rows.agg(F.count(F.lit(1)).alias("__rows"))
    held = counted.limit(SHORT_LIST + 1).collect()
    if len(held) > SHORT_LIST:
        return rows.repartition(*by)
    packs, first = [], 0
    for row in held:
        count = max(1, round(row["__rows"] * size / target))
        packs.append((*(row[c] for c in by), first, count))
        first += count
    if not packs:
        return rows
    schema = ", ".join([*(f"`__{c}` {rows.schema[c].dataType.simpleString()}" for c in by), "__first int", "__count int"])
    known = F.broadcast(rows.sparkSession.createDataFrame(packs, schema))
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    dealt = rows.join(known, same) if by else rows.crossJoin(known)
    place = F.col("__first") + F.pmod(F.xxhash64(*key), F.col("__count")).cast("int")
    return dealt.repartitionById(first, place).select(*rows.columns)
