"""Row order inside groups of any size.

``row_number`` or ``lag`` over a group puts the whole group into one task, which fails when one key holds a third of
the rows. Both helpers here split a group into order-preserving buckets. A small summary per bucket, aggregated before
it is shuffled, is carried from bucket to bucket and fed back as one seed row per bucket, so that a single window per
(group, bucket) gives the same result as a window over the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_BUCKET, _SEED = "__bucket", "__seed"


def dense_index(
    df: DataFrame, group: Sequence[str], bucket: Column, order: Sequence[Column], name: str = "index"
) -> DataFrame:
    """Add the 0-based rank of each row inside its group.

    ``bucket`` must not decrease along ``order``, and ``order`` must be total inside a bucket.
    """
    rows = df.withColumn(_BUCKET, bucket)
    before = Window.partitionBy(*group).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    seeds = (
        rows.groupBy(*group, _BUCKET)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select(*group, _BUCKET, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias(_SEED))
    )
    inside = Window.partitionBy(*group, _BUCKET).orderBy(F.col(_SEED).asc_nulls_last(), *order)
    start = F.first(_SEED).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        rows.withColumn(_SEED, F.lit(None).cast("long"))
        .unionByName(seeds, allowMissingColumns=True)
        # the seed row itself is number 1, hence the 2
        .withColumn(name, (start + F.row_number().over(inside) - 2).cast("long"))
        .filter(F.col(_SEED).isNull())
        .drop(_BUCKET, _SEED)
    )


def previous_row(
    df: DataFrame, group: Sequence[str], order: str, span: int, columns: Sequence[str], prefix: str = "prev_"
) -> DataFrame:
    """Add ``prefix + column`` with the value of the row before in the group, null on the first row.

    ``order`` is an integer column, unique inside a group. A bucket covers ``span`` of its values, so no window holds
    more than ``span + 1`` rows. Fixed-width ``columns`` let the summary run as a hash aggregation.
    """
    bucket = F.floor(F.col(order) / F.lit(span)).cast("long")
    rows = df.withColumn(_BUCKET, bucket)
    carried = [c for c in columns if c != order]
    last = rows.groupBy(*group, _BUCKET).agg(
        F.max(order).alias("__order"), *(F.max_by(c, order).alias(f"__{c}") for c in carried)
    )
    following = F.lead(_BUCKET).over(Window.partitionBy(*group).orderBy(_BUCKET))
    seeds = (
        last.withColumn(_BUCKET, following)
        .filter(F.col(_BUCKET).isNotNull())
        .select(
            *group,
            _BUCKET,
            F.col("__order").alias(order),
            *(F.col(f"__{c}").alias(c) for c in carried),
            F.lit(True).alias(_SEED),
        )
    )
    inside = Window.partitionBy(*group, _BUCKET).orderBy(order)
    return (
        rows.withColumn(_SEED, F.lit(False))
        .unionByName(seeds, allowMissingColumns=True)
        .withColumns({f"{prefix}{c}": F.lag(c).over(inside) for c in columns})
        .filter(~F.col(_SEED))
        .drop(_BUCKET, _SEED)
    )
