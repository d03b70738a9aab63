"""Names for stored tables in the session's catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.functions.instants import LAST_INSTANT
from rowtide.spec import DELETED, TableSpec
from rowtide.tables.changelog import ChangelogTable
from rowtide.tables.folders import ATTEMPT, SLICE

PARTITIONS_AT_A_TIME = 500


def register_view(rows: DataFrame, name: str) -> None:
    """Name a read, for instance a snapshot, for use in SQL. The name always stands for that read."""
    rows.createOrReplaceTempView(name)


def register_current(table: ChangelogTable, name: str) -> str | None:
    """Catalog table with the rows of a changelog as of its last commit: the table is compacted, and the slices of its new
    base become the partitions of the name. Call it again to move on. Returns the list of the slices that the compaction
    wrote, None if nothing was committed.

    Under ``policy="event"`` a base keeps deletes, so filter on ``is_deleted``, as the snapshot does.
    """
    listed = table.compact(LAST_INSTANT)
    if listed is None:
        return None
    spark, spec, place = table.spark, table.spec, _quoted_text(table.base_path)
    spark.sql(f"DROP TABLE IF EXISTS {_name(name)}")
    by = [T.StructField(ATTEMPT, T.StringType()), T.StructField(SLICE, T.StringType()), *(spec.image[p] for p in spec.partition)]
    spark.sql(
        f"CREATE TABLE {_name(name)} ({_ddl(spec, by)}) USING parquet PARTITIONED BY "
        f"({', '.join(_quoted(f.name) for f in by)}) LOCATION '{place}'"
    )
    # rows of folders, not of data: one per slice and partition value
    held = table.base_folders()
    adding = []
    for row in held.toLocalIterator():
        values = ", ".join(f"{_quoted(f.name)} = '{_quoted_text(str(row[f.name]))}'" for f in by)
        adding.append(f"PARTITION ({values})")
        if len(adding) == PARTITIONS_AT_A_TIME:
            spark.sql(f"ALTER TABLE {_name(name)} ADD {' '.join(adding)}")
            adding = []
    if adding:
        spark.sql(f"ALTER TABLE {_name(name)} ADD {' '.join(adding)}")
    return listed


def live_rows(spark: SparkSession, name: str) -> DataFrame:
    """The rows of a registered table that are not deleted."""
    return spark.table(_name(name)).filter(~F.col(DELETED))


def register_parquet(spark: SparkSession, name: str, path: str, spec: TableSpec) -> None:
    """External table over a folder of record files partitioned by the table's partition columns."""
    columns = _ddl(spec, [spec.image[p] for p in spec.partition])
    by = f"PARTITIONED BY ({', '.join(map(_quoted, spec.partition))})" if spec.partition else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(name)} ({columns}) USING parquet {by} LOCATION '{_quoted_text(path)}'")
    if spec.partition:
        spark.catalog.recoverPartitions(_name(name))


def _ddl(spec: TableSpec, partition: list[T.StructField]) -> str:
    """The columns of records, those of folders last."""
    last = {f.name for f in partition}
    columns = [*(f for f in spec.record_schema.fields if f.name not in last), *partition]
    return ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in columns)


def _quoted_text(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _quoted(part: str) -> str:
    return "`" + part.replace("`", "``") + "`"


def _name(name: str) -> str:
    """A name with its parts quoted; dots separate them."""
    return ".".join(_quoted(part.strip("`")) for part in name.split("."))
