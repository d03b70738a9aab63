"""What the operators share: stored intermediate tables and batches of texts inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.window import Window

from rowtide.functions.lists import broadcast_if_short
from rowtide.tables.folders import shared_folder

# A slice of a batch that is turned into Python objects at a time.
ROWS_AT_A_TIME = 256
# Rows of an Arrow batch of texts.
BATCH_ROWS = 512


def stored(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a table below the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """Only what an operator reads, so that other columns are neither scanned nor in the way."""
    return small_batches(docs).select(
        docs[id_col].alias("id"), docs[text_col].cast("string").cast("binary").alias("text"), *(docs[c] for c in more)
    )


def carried_row(docs: DataFrame, carry: bool, without: str | None = None) -> list[Column]:
    """The row as one struct column ``row``, so that no column name can clash; or nothing."""
    return [F.struct(*(docs[c] for c in docs.columns if c != without)).alias("row")] if carry else []


def small_batches(docs: DataFrame) -> DataFrame:
    """Send texts to Python in batches of few rows: the size of a batch is memory a task holds several times over. A
    smaller number that the session has is left alone."""
    conf, name = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return docs


def release_memory() -> None:
    """Give what a worker process holds but does not use back to the system: workers are kept from stage to stage, and
    their largest moments would add up."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(
    run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that releases memory before and after it runs."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        yield from run(batches)
        release_memory()

    return tidied


def per_slice(
    work: Callable[[pa.RecordBatch], pa.RecordBatch], rows: int = ROWS_AT_A_TIME
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that applies ``work`` to short slices, which bounds a task's memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                yield work(batch.slice(start, rows))

    return tidy(run)


def ask_blocks(
    held: DataFrame,
    asked: DataFrame,
    by: list[str],
    open_block: Callable[[pa.Table], object],
    answer: Callable[[object, pa.RecordBatch], pa.RecordBatch | None],
    schema: str,
) -> DataFrame:
    """Answers to the rows of ``asked`` from the blocks of ``held``, both dealt by the columns ``by``.

    A task holds one block at a time, opened once, and its questions pass by in batches: neither side is gathered beyond a
    block. A block that nobody asks is dropped, a question to a block without rows is not answered. Both frames may have
    columns of their own.
    """
    both = held.withColumn("asks", F.lit(False)).unionByName(asked.withColumn("asks", F.lit(True)), allowMissingColumns=True)
    sent = both.repartition(*by).sortWithinPartitions(*by, "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, waiting, block = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (*by, "asks")], 1)
            cuts = np.flatnonzero((np.diff(marks, axis=0) != 0).any(1)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(marks)]):
                place, part = tuple(marks[low][:-1]), batch.slice(low, high - low)
                if place != key:
                    key, waiting, block = place, [], None
                if not marks[low][-1]:
                    waiting.append(part)
                    continue
                if block is None and waiting:
                    block, waiting = open_block(pa.Table.from_batches(waiting)), []
                found = answer(block, part) if block is not None else None
                if found is not None and found.num_rows:
                    yield found

    return sent.mapInArrow(tidy(run), schema)


def matrix(column: pa.Array | pa.ChunkedArray, rows: int) -> np.ndarray:
    """A column of lists of equal length as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten()).reshape(rows, -1)


def ddl(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def in_test_fold(id_col: str, folds: int, fold: int):
    """Whether a row belongs to a held-out fold, by the CRC-32 of its id as text."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold


def bounded_sample(rows: DataFrame, id_col: str, by: str, count: int) -> DataFrame:
    """``id_col, by`` of at most ``count`` rows of every value of ``by``, those whose id has the smallest hash.

    A value with more rows is first cut to about twice ``count`` by a bound on the hash, so that no task gathers more.
    """
    named = rows.filter(F.col(by).isNotNull() & F.col(id_col).isNotNull()).select(id_col, by)
    sizes = named.groupBy(by).agg(F.count(F.lit(1)).alias("__size"))
    low = (F.xxhash64(id_col) / F.lit(2.0**64) + 0.5) * F.col("__size") <= 2 * count
    near = named.join(broadcast_if_short(stored(sizes, "sample-sizes")), by).filter(low)
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.xxhash64(id_col), id_col))
    return near.withColumn("__rank", rank).filter(F.col("__rank") <= count).select(id_col, by)
