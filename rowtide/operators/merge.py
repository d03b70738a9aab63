"""Folds: from records to one row per key.

The pick is ``row_number() = 1``. Spark turns that filter into a group limit that runs on each map task before the
shuffle, so a key with a third of all records sends one row per map task and no task ever holds the whole group.
Across commits the pick orders by (commit, order column, position). That is the same row as combining each commit first
and taking the newest commit afterwards, with one shuffle instead of two.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowtide.spec import COMMIT, DELETED, POSITION, SRC_FILE, TableSpec

POLICIES = ("commit", "event")


def in_order(columns: Sequence[str]) -> list[Column]:
    """What to compare, largest last. Log files count up in their suffix, so ``log.1000000`` comes after ``log.999999``;
    their text breaks ties."""
    number = F.regexp_extract(SRC_FILE, r"\.(\d+)$", 1).try_cast("decimal(38,0)")
    return [c for name in columns for c in ([number, F.col(name)] if name == SRC_FILE else [F.col(name)])]


def _pick_first(records: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    newest_first = Window.partitionBy(*group).orderBy(*(c.desc_nulls_last() for c in in_order(order)))
    return records.withColumn("__rank", F.row_number().over(newest_first)).filter("__rank = 1").drop("__rank")


def combine(records: DataFrame, spec: TableSpec, by_partition: bool = True) -> DataFrame:
    """One record per key and commit: the largest order column, then the last position."""
    key = spec.scope if by_partition else spec.record_key
    return _pick_first(records, (COMMIT, *key), (spec.order_by, *POSITION))


def fold(
    records: DataFrame,
    spec: TableSpec,
    policy: str = "commit",
    by_partition: bool = True,
    keep_deletes: bool = False,
) -> DataFrame:
    """The current row of every key.

    ``policy="commit"``: a later commit wins whatever its order column says. ``policy="event"``: the largest order
    column wins over all commits. ``by_partition=False`` takes the record key alone, so a row that changed its
    partition exists once. Deletes take part in the fold and are dropped after it; dropping them earlier would bring
    an older row back.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, got {policy!r}")
    order = (spec.order_by, *POSITION)
    if policy == "commit":
        order = (COMMIT, *order)
    current = _pick_first(records, spec.scope if by_partition else spec.record_key, order)
    return current if keep_deletes else current.filter(~F.col(DELETED))


def changelog_until(records: DataFrame, spec: TableSpec, floor, policy: str = "commit") -> DataFrame:
    """Retention: the versions needed to read the table as of any commit at or after ``floor``.

    These are all versions after the floor and, per key, the one that was current at the floor. ``floor`` is an
    instant or a scalar column. Commits up to the floor count as one, so a single pick per key and commit gives both.
    Deletes at or before the floor go too, except under ``policy="event"``, where they still hold back late records.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, got {policy!r}")
    floor = F.lit(floor) if isinstance(floor, str) else floor
    order = (spec.order_by, *POSITION)
    if policy == "commit":
        order = (COMMIT, *order)
    split = records.withColumn("__after", F.when(F.col(COMMIT) > floor, F.col(COMMIT)))
    kept = _pick_first(split, (*spec.scope, "__after"), order)
    if policy == "commit":
        kept = kept.filter(F.col("__after").isNotNull() | ~F.col(DELETED))
    return kept.drop("__after")
