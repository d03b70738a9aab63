"""What changed between two versions of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.spec import COMMIT, TableSpec

INSERTED, UPDATED, REMOVED = "insert", "update", "delete"


def between(old: DataFrame, new: DataFrame, spec: TableSpec, by_partition: bool = True) -> DataFrame:
    """``change, before, after`` per key that differs: the images of both versions, null where there is none.

    Give the rows that may differ; a row that is the same commit's in both is left out. An update is a row written again,
    also with equal values. Keys are (partition, record key), or the record key alone: then a row that moved to another
    partition is one update.
    """
    key = spec.scope if by_partition else spec.record_key
    row = F.struct(*spec.columns, COMMIT)
    a = old.select(*(F.col(k).alias(f"a_{k}") for k in key), row.alias("before"))
    b = new.select(*(F.col(k).alias(f"b_{k}") for k in key), row.alias("after"))
    same = F.lit(True)
    for k in key:
        same = same & (F.col(f"a_{k}") == F.col(f"b_{k}"))
    change = F.when(F.col("before").isNull(), INSERTED).when(F.col("after").isNull(), REMOVED).otherwise(UPDATED)
    both = a.join(b, same, "full").filter(~F.col(f"before.{COMMIT}").eqNullSafe(F.col(f"after.{COMMIT}")))
    return both.select(change.alias("change"), "before", "after")
