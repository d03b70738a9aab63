"""Approximate nearest neighbours with an inverted multi-index.

Both halves of the vectors have a codebook of their own; a cell is a pair of centroids and holds the vectors nearest to
them, every vector in one cell. A query goes through the cells in the order of summed centroid distance, which a heap
yields without sorting all pairs, until they hold a given share of the index, and every vector in them is reranked by its
exact distance.

Codebooks are fitted on at most ``SAMPLE`` vectors. On the same sample, held against brute force, the share is chosen:
the smallest that finds ``TARGET`` of the neighbours. Vectors without clusters need a large one. Cells are dealt to blocks
of about ``BLOCK_ROWS`` vectors and larger cells are cut, so a crowded cell is many tasks. A query is sent to the blocks it
visits and each answers with its best candidates only; vectors move once, or once per ``PORTION_QUERIES`` queries.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowtide.llm.common import ask_blocks, matrix, stored

CENTROIDS, ROUNDS = 64, 12
SAMPLE, TRIALS, TARGET = 16384, 256, 0.97
BLOCK_ROWS, PORTION_QUERIES = 4096, 65536


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``row, id, vector`` of the rows that take part; ``row`` tells rows of equal id apart.

    Null ids, null and zero vectors, vectors with a null or non-finite component or of another length than most (ties:
    the longer) take no part.
    """
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector_col].cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = rows.filter("id is not null and vector is not null").filter(finite & F.exists("vector", lambda x: x != 0))
    lengths = good.groupBy(F.size("vector").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    longest = lengths.agg(F.max_by("n", F.struct("rows", "n"))).first()[0]
    same = good.filter(F.size("vector") == F.lit(longest))
    return same.select(F.monotonically_increasing_id().alias("row"), "id", "vector")


def _nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((centroids**2).sum(1) - 2 * points @ centroids.T).argmin(1)


def _k_means(points: np.ndarray, count: int) -> np.ndarray:
    centroids = points[np.random.default_rng(1).choice(len(points), min(count, len(points)), replace=False)].copy()
    for _ in range(ROUNDS):
        code = _nearest(points, centroids)
        size = np.bincount(code, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, code, points)
        centroids[size > 0] = sums[size > 0] / size[size > 0, None]
    return centroids


@dataclass
class Codebooks:
    first: np.ndarray
    second: np.ndarray

    @property
    def cells(self) -> int:
        return len(self.first) * len(self.second)

    def cell(self, points: np.ndarray) -> np.ndarray:
        half = self.first.shape[1]
        return _nearest(points[:, :half], self.first) * len(self.second) + _nearest(points[:, half:], self.second)

    def in_order(self, query: np.ndarray) -> Iterator[int]:
        """Cells by the sum of the squared distances of their two centroids from the query's halves."""
        half = self.first.shape[1]
        a = ((self.first - query[:half]) ** 2).sum(1)
        b = ((self.second - query[half:]) ** 2).sum(1)
        by_a, by_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        a, b, by_a, by_b = a[by_a].tolist(), b[by_b].tolist(), by_a.tolist(), by_b.tolist()
        # one entry per column of the table of sums: a column is opened when its left neighbour's first cell is taken
        front = [(a[0] + b[0], 0, 0)]
        while front:
            _, i, j = heapq.heappop(front)
            yield by_a[i] * len(b) + by_b[j]
            if j + 1 < len(b):
                heapq.heappush(front, (a[i] + b[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(front, (a[i + 1] + b[0], i + 1, 0))

    def visited(self, query: np.ndarray, sizes: np.ndarray, wanted: float) -> np.ndarray:
        """The cells to look into: in order, until they hold ``wanted`` vectors."""
        cells, held = [], 0
        for cell in self.in_order(query):
            if held >= wanted:
                break
            if sizes[cell]:
                cells.append(cell)
                held += int(sizes[cell])
        return np.array(cells, np.int32)


def _share(books: Codebooks, points: np.ndarray, k: int) -> float:
    """The smallest share of the sample that has to be visited to find ``TARGET`` of the ``k`` nearest."""
    code = books.cell(points)
    sizes = np.bincount(code, minlength=books.cells)
    needed = []
    for number in range(0, len(points), max(1, len(points) // TRIALS)):
        distance = ((points - points[number]) ** 2).sum(1)
        distance[number] = np.inf
        nearest = np.argsort(distance, kind="stable")[: min(k, len(points) - 1)]
        order = np.fromiter(books.in_order(points[number]), np.int64)
        before = np.zeros(books.cells)
        before[order] = np.cumsum(sizes[order])
        needed.extend((before[code[nearest]] / len(points)).tolist())
    return float(np.quantile(needed, TARGET)) if needed else 1.0


@dataclass
class Index:
    rows: DataFrame  # row, id, vector, cell
    books: Codebooks
    sizes: np.ndarray  # vectors per cell
    blocks: list[tuple[int, int]]  # per cell: its first block and how many it has
    share: float


def build(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10) -> Index | None:
    """Index every usable row; None if there is none. ``k`` is the number of neighbours the share is chosen for."""
    rows = stored(usable(vectors, id_col, vector_col), "ann-vectors")
    count = rows.count()
    if not count:
        return None
    low = (F.xxhash64("row") / F.lit(2.0**64) + 0.5) * count <= 2 * SAMPLE
    drawn = rows.filter(low).orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("vector").toArrow()
    points = np.array(drawn.column(0).combine_chunks().flatten()).reshape(drawn.num_rows, -1)
    half = points.shape[1] // 2
    books = Codebooks(*(_k_means(np.ascontiguousarray(p), CENTROIDS) for p in (points[:, :half], points[:, half:])))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = books.cell(matrix(batch.column(2), batch.num_rows)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], ["row", "id", "vector", "cell"])

    coded = stored(rows.mapInArrow(encode, "row long, id long, vector array<double>, cell int"), "ann-index")
    sizes = np.zeros(books.cells, np.int64)
    for row in coded.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).toLocalIterator():  # a row per cell
        sizes[row["cell"]] = row["n"]
    blocks, block, filled = [], 0, 0
    for size in sizes.tolist():
        pieces = -(-size // BLOCK_ROWS)
        if filled and filled + size > BLOCK_ROWS:
            block, filled = block + 1, 0
        blocks.append((block, max(1, pieces)))
        if pieces > 1:
            block, filled = block + pieces, 0
        else:
            filled += size
    return Index(coded, books, sizes, blocks, _share(books, points, k))


def search(index: Index, queries: DataFrame, k: int = 10, share: float | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for every query (``row, id, vector`` of the index),
    nearest first, equal distances by smaller id; all there are if fewer. ``score`` is the Euclidean distance in double
    precision. The query's own row is left out; rows that repeat an id are queries and candidates of their own."""
    spark = queries.sparkSession
    shared = spark.sparkContext.broadcast((index.books, index.sizes, index.blocks))
    wanted = max((index.share if share is None else share) * int(index.sizes.sum()), k + 1)
    portions = max(1, -(-queries.count() // PORTION_QUERIES))
    portion = F.pmod(F.xxhash64("row"), F.lit(portions)).cast("int")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, sizes, blocks = shared.value
        first, pieces = np.array(blocks).T
        for batch in batches:
            if not batch.num_rows:
                continue
            for number, query in enumerate(matrix(batch.column(2), batch.num_rows)):
                cells = books.visited(query, sizes, wanted)
                at = np.repeat(first[cells], pieces[cells]) + np.concatenate([np.arange(n) for n in pieces[cells]])
                cells = np.repeat(cells, pieces[cells])
                order = np.argsort(at, kind="stable")
                cut = np.flatnonzero(np.diff(at[order], prepend=-1, append=-1))
                found = [cells[order[a:b]].tobytes() for a, b in zip(cut[:-1], cut[1:])]
                same = pa.array([number] * len(found), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(same) for c in batch.columns), pa.array(at[order][cut[:-1]].astype(np.int32)),
                     pa.array(found, pa.binary())],
                    ["row", "id", "vector", "portion", "block", "cells"],
                )

    def open_block(block: pa.Table) -> tuple:
        row, ids, cell = (block.column(c).to_numpy() for c in ("row", "id", "cell"))
        return row, ids, cell, matrix(block.column("vector"), block.num_rows), np.zeros(index_cells, bool)

    def rerank(block: tuple, asked: pa.RecordBatch) -> pa.RecordBatch:
        row, ids, cell, points, wants = block
        out: list[list] = [[] for _ in range(5)]
        lists = (asked.column(c).to_pylist() for c in ("row", "id", "cells"))
        for point, query, query_id, cells in zip(matrix(asked.column("vector"), asked.num_rows), *lists):
            wants[:] = False
            wants[np.frombuffer(cells, np.int32)] = True
            at = np.flatnonzero(wants[cell] & (row != query))
            distance = np.sqrt(((points[at] - point) ** 2).sum(1))
            if len(at) > k:
                close = distance <= np.partition(distance, k - 1)[k - 1]
                at, distance = at[close], distance[close]
            best = np.lexsort((row[at], ids[at], distance))[:k]
            same = np.full(len(best), query), np.full(len(best), query_id)
            for column, values in zip(out, (*same, row[at[best]], ids[at[best]], distance[best])):
                column.append(values)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["query", "query_id", "row", "vec_id", "score"])

    index_cells = index.books.cells
    bounds = spark.createDataFrame(
        [(cell, block, pieces) for cell, ((block, pieces), n) in enumerate(zip(index.blocks, index.sizes.tolist())) if n],
        "cell int, first int, pieces int",
    )
    # a row per cell that holds something
    placed = index.rows.join(F.broadcast(bounds), "cell")
    piece = F.pmod(F.xxhash64("row"), F.col("pieces")).cast("int")
    placed = placed.select("row", "id", "vector", "cell", (F.col("first") + piece).alias("block"))
    placed = placed.withColumn("portion", F.explode(F.sequence(F.lit(0), F.lit(portions - 1))))
    asked = queries.select("row", "id", "vector", portion.alias("portion")).mapInArrow(
        route, "row long, id long, vector array<double>, portion int, block int, cells binary"
    )
    close = ask_blocks(
        placed, asked, ["block", "portion"], open_block, rerank, "query long, query_id long, row long, vec_id long, score double"
    )
    by_score = Window.partitionBy("query").orderBy("score", "vec_id", "row")
    ranked = close.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def neighbours(
    vectors: DataFrame, every: int = 100, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The ``k`` nearest of every usable vector whose id is divisible by ``every``, as ``search`` returns them."""
    index = build(vectors, id_col, vector_col, k)
    if index is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return search(index, index.rows.filter(F.col("id") % every == 0).select("row", "id", "vector"), k)
