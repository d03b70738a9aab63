"""Epoch values, without depending on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: an epoch up to this one is in seconds, a larger one is already in milliseconds.
LARGEST_SECONDS = (1 << 32) - 1


def normalize_epoch(epoch: Column) -> Column:
    """Milliseconds of an epoch that may be in seconds or milliseconds.

    The unit is told by the upper 32 bits, so a negative value (all upper bits set) counts as milliseconds.
    """
    upper_bits = F.shiftrightunsigned(epoch.cast("long"), 32)
    return F.when(upper_bits != 0, epoch.cast("long")).otherwise(epoch.cast("long") * 1000)


def to_millis(epoch: int) -> int:
    """:func:`normalize_epoch` for an argument that lives on the driver."""
    return epoch * 1000 if 0 <= epoch <= LARGEST_SECONDS else epoch


def ntz_epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a zone-less timestamp, read as UTC whatever the session zone is."""
    seconds_of_day = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.floor(F.second(ts))
    return F.unix_date(ts.cast("date")).cast("long") * 86400 + seconds_of_day.cast("long")
