"""Rows kept as JSON text, with their schema inferred or given."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_json_rows(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines at ``path``. Without a schema every line is read once more to infer one."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def write_json_rows(rows: DataFrame, path: str) -> None:
    rows.write.mode("errorifexists").json(path)
