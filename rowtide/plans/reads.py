"""Snapshot, incremental and time-travel reads over records.

``records`` is anything with the record columns: routed events, a stored changelog, or a base joined with its log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.functions.instants import FIRST_INSTANT, LAST_INSTANT, pad_instant, validate_instant
from rowtide.operators.merge import fold
from rowtide.spec import COMMIT, TableSpec


def snapshot(records: DataFrame, spec: TableSpec, **options) -> DataFrame:
    """The latest live row of every key."""
    return fold(records, spec, **options)


def as_of(records: DataFrame, spec: TableSpec, instant: str = LAST_INSTANT, **options) -> DataFrame:
    """The table as it was at ``instant``, with that commit. The bound is a filter below the fold, so it prunes."""
    return fold(records.filter(F.col(COMMIT) <= pad_instant(instant)), spec, **options)


def incremental(records: DataFrame, spec: TableSpec, begin: str = FIRST_INSTANT, **options) -> DataFrame:
    """Rows of the current table whose last commit is after ``begin``.

    Under ``policy="commit"`` a row with an older commit can only lose to the rows asked for, so older records are
    dropped before the fold, where the filter reaches the scan. Under ``policy="event"`` an older commit may hold the
    current row and the filter has to wait.
    """
    after = F.col(COMMIT) > validate_instant(begin)
    if options.get("policy", "commit") == "commit":
        return fold(records.filter(after), spec, **options)
    return fold(records, spec, **options).filter(after)


def read(
    records: DataFrame, spec: TableSpec, begin: str | None = None, instant: str | None = None, **options
) -> DataFrame:
    """Time travel if ``instant`` is given, incremental if ``begin`` is, else a snapshot. Both at once is an error."""
    if begin is not None and instant is not None:
        raise ValueError("give either begin (incremental) or instant (time travel)")
    if instant is not None:
        return as_of(records, spec, instant, **options)
    if begin is not None:
        return incremental(records, spec, begin, **options)
    return snapshot(records, spec, **options)
