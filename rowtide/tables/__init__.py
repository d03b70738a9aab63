"""Keyed tables as Parquet folders: an appended changelog, and partitions rewritten per commit."""

from rowtide.tables.changelog import ChangelogTable
from rowtide.tables.rewrite import RewriteTable

__all__ = ["ChangelogTable", "RewriteTable"]
