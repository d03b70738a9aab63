"""What a keyed table looks like: its image columns, its key, its partition column and its ordering column."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Columns a record carries beside the image columns.
COMMIT = "_commit_time"
# The day of a commit: the folder column of a streamed log.
COMMIT_DAY = "_commit_day"
DELETED = "is_deleted"
SRC_FILE, SRC_POS, SRC_ROW = "_src_file", "_src_pos", "_src_row"
# What a refused event keeps beside its commit.
REFUSED_REASON, REFUSED_VALUE = "_refused_reason", "_refused_value"
# In front of the day in the folders of refused events; after all days in text order.
REFUSED_DAY = "refused-"
POSITION = (SRC_FILE, SRC_POS, SRC_ROW)


def image_of_types(**types: str) -> T.StructType:
    """Image schema from column names and simple type names (string, integer, long, double, ...), without a session."""
    schema = T.StructType()
    for name, data_type in types.items():
        schema = schema.add(name, data_type)
    return schema


@dataclass(frozen=True)
class TableSpec:
    """``image`` is the schema of a row; the other fields name columns of it.

    ``record_key`` is unique inside a partition. ``partition`` may be empty for an unpartitioned table. ``order_by``
    ranks the versions of a key inside one commit; null ranks lowest and the source position breaks ties.
    """

    image: T.StructType
    record_key: tuple[str, ...]
    partition: tuple[str, ...] = ()
    order_by: str = "ts"

    def __post_init__(self):
        names = self.columns
        for column in (*self.record_key, *self.partition, self.order_by):
            if column not in names:
                raise ValueError(f"column {column!r} is not in the image schema {names}")
        if not self.record_key:
            raise ValueError("a keyed table needs at least one record key column")

    @property
    def columns(self) -> list[str]:
        return self.image.fieldNames()

    @property
    def scope(self) -> tuple[str, ...]:
        """Key scope of a fold: the same record key in two partitions is two rows."""
        return (*self.partition, *(k for k in self.record_key if k not in self.partition))

    @property
    def record_schema(self) -> T.StructType:
        """Schema of a stored record."""
        return T.StructType(
            [T.StructField(f.name, f.dataType, True) for f in self.image.fields]
            + [
                T.StructField(DELETED, T.BooleanType()),
                T.StructField(SRC_FILE, T.StringType()),
                T.StructField(SRC_POS, T.LongType()),
                T.StructField(SRC_ROW, T.IntegerType()),
                T.StructField(COMMIT, T.StringType()),
            ]
        )
