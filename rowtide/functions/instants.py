"""Commit instants: ``yyyyMMddHHmmss`` or ``yyyyMMddHHmmssSSS`` in UTC, compared as strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The instants that mean "from the start" and "to the end".
FIRST_INSTANT = "19700101000000"
LAST_INSTANT = "99991231235959"


def instant_from_millis(millis: Column) -> Column:
    """17-digit UTC instant of an epoch in milliseconds.

    Built from the date and the time of day by arithmetic: formatting a timestamp would follow the session zone, and
    a zone that sets its clock back would make instants run backwards.
    """
    day = F.floor(millis / 86_400_000).cast("int")
    rest = F.pmod(millis, F.lit(86_400_000))

    def digits(value: Column, width: int) -> Column:
        return F.lpad(value.cast("long").cast("string"), width, "0")

    return F.concat(
        F.translate(F.date_from_unix_date(day).cast("string"), "-", ""),
        digits(F.floor(rest / 3_600_000), 2),
        digits(F.floor(rest / 60_000) % 60, 2),
        digits(F.floor(rest / 1000) % 60, 2),
        digits(rest % 1000, 3),
    )


def current_instant() -> Column:
    """Instant of the running query: one value per batch query and per micro-batch."""
    return instant_from_millis(F.unix_millis(F.current_timestamp()))


def validate_instant(instant: str) -> str:
    if not (isinstance(instant, str) and instant.isascii() and instant.isdigit() and len(instant) in (14, 17)):
        raise ValueError(f"an instant has 14 or 17 digits, got {instant!r}")
    return instant


def pad_instant(instant: str) -> str:
    """Inclusive upper bound of an instant: 14 digits stand for their whole second."""
    validate_instant(instant)
    return instant + "999" if len(instant) == 14 else instant
