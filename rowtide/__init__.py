"""Keyed, versioned tables from row-level change events, on Spark DataFrames.

A change feed carries JSON events with a before image, an after image and an operation code. This package decodes
and routes such feeds, folds them into keyed tables, stores the tables as Parquet and reads them back as of any commit.
Every function takes and returns DataFrames; the caller owns the session.
"""

from rowtide.spec import TableSpec, image_of_types

__all__ = ["TableSpec", "image_of_types"]
