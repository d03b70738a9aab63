"""Joins of a table with a list about it: its commits, its slices, the bounds of a feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a list that may be broadcast; such a row is some 100 bytes.
SHORT_LIST = 100_000


def broadcast_if_short(rows: DataFrame) -> DataFrame:
    """Mark a list for broadcast once a count has shown that it is short.

    Left to file sizes, Spark would shuffle the table itself when the many small files of such a list add up. A longer
    list is joined without the mark.
    """
    short = rows.limit(SHORT_LIST + 1).count() <= SHORT_LIST
    return F.broadcast(rows) if short else rows
