"""Hard-negative mining by angular triangle filtering.

Every row is stored with its norm and its angles to a few reference directions. For a row at the angle ``t`` to a
reference and an anchor at ``a``, the angle between the two lies in ``[|a - t|, a + t]``; the references' intervals of the
cosine are cut with each other and multiplied by both norms into bounds of the score, widened by more than rounding can
take away. Only rows whose bounds overlap a wanted window of scores are scored, in 64-bit integers.

Rows are dealt by the nearest reference and the angle to it into blocks of about ``BLOCK_ROWS``; a block is sorted by that
angle, so one bound cuts a stretch out of it by bisection. A block's ranges of angles and norms bound the scores of all its
rows at once and decide which anchors it sees. Anchors look into their own block first: the ``k``-th best score there is
the bar for all others. They do so twice, for their positives and then, with a window of scores below each positive, for
the negatives. Tasks stream: a block is held, its anchors pass by, so no group is collected; more than ``PORTION_ANCHORS``
anchors are dealt to copies of the blocks. At most ``MOST_BLOCKS`` blocks (and one per bin of the angle) are made, larger
ones as rows grow, which bounds what is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowtide.llm.common import ask_blocks, matrix, stored

REFERENCES, SAMPLE, BINS = 8, 4096, 1024
BLOCK_ROWS, MOST_BLOCKS, PORTION_ANCHORS = 4096, 16384, 65536
# More than angles and cosines lose to rounding: an arc cosine near 1 keeps half the digits of its argument.
SLACK = 1e-6
# No bound on a score, as a 64-bit integer.
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1

_FOUND = "anchor_row long, window int, row long, id long, score long"


def usable(rows: DataFrame, scale: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``row, id, label, vector`` of the rows that take part, their components as whole numbers.

    Null ids, labels and vectors, vectors with a null or non-finite component or of another length than most (ties: the
    longer) take no part. ``row`` tells rows of equal id apart.
    """
    read = rows.select(
        rows[id_col].cast("long").alias("id"),
        rows[label_col].cast("long").alias("label"),
        rows[vector_col].cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = read.filter("id is not null and label is not null and vector is not null").filter(finite)
    lengths = good.groupBy(F.size("vector").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    longest = lengths.agg(F.max_by("n", F.struct("rows", "n"))).first()[0]
    whole = F.transform("vector", lambda x: F.floor(x * scale))
    return good.filter(F.size("vector") == F.lit(longest)).select(
        F.monotonically_increasing_id().alias("row"), "id", "label", whole.alias("vector")
    )


def _norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors.astype(float) ** 2).sum(1))


def choose_references(vectors: np.ndarray, count: int = REFERENCES) -> np.ndarray:
    """Directions far from each other: the mean's, then again and again the vector farthest from those chosen."""
    norms = _norms(vectors)
    units = vectors[norms > 0] / norms[norms > 0, None]
    if not len(units):
        return np.eye(1, vectors.shape[1])
    mean = units.mean(0)
    length = np.sqrt((mean**2).sum())
    chosen = [mean / length if length > 1e-6 else units[0]]
    nearest = units @ chosen[0]
    while len(chosen) < min(count, len(units)):
        chosen.append(units[nearest.argmin()])
        nearest = np.maximum(nearest, units @ chosen[-1])
    return np.array(chosen)


def angles(vectors: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles to the references; a zero vector, whose scores are all zero, is at a right angle."""
    cosines = vectors @ references.T / np.where(norms > 0, norms, 1)[:, None]
    return np.arccos(np.clip(cosines, -1, 1))


def score_bounds(angle: np.ndarray, norm: float, others: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of an anchor's scores with rows of the given angles (a line each) and norms."""
    by_angle = np.cos(others) * np.cos(angle), np.sin(others) * np.sin(angle)
    high = (by_angle[0] + by_angle[1]).min(1) + SLACK
    # beyond a straight angle the sum of two angles says nothing
    low = np.where(others + angle >= np.pi, -1.0, by_angle[0] - by_angle[1]).max(1) - SLACK
    reach = norm * norms
    return reach * low - 1e-6, reach * high + 1e-6


@dataclass
class Summary:
    """Ranges of the blocks' angles and norms."""

    least_angle: np.ndarray
    most_angle: np.ndarray
    least_norm: np.ndarray
    most_norm: np.ndarray

    def bounds(self, angle: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
        apart = np.maximum(0, np.maximum(self.least_angle - angle, angle - self.most_angle))
        high = np.cos(apart).min(1) + SLACK
        low = np.cos(np.minimum(np.pi, self.most_angle + angle)).max(1) - SLACK
        top = norm * np.where(high > 0, self.most_norm, self.least_norm) * high + 1e-6
        bottom = norm * np.where(low > 0, self.least_norm, self.most_norm) * low - 1e-6
        return bottom, top


class Block:
    """Some rows, sorted by the angle to the reference that most of them are nearest to."""

    def __init__(self, table: pa.Table):
        count = table.num_rows
        spread = matrix(table.column("angles"), count)
        self.own = int(np.bincount(spread.argmin(1)).argmax())
        order = np.argsort(spread[:, self.own], kind="stable")
        self.angles = spread[order]
        self.row, self.id, self.label, self.norm = (
            table.column(c).to_numpy()[order] for c in ("row", "id", "label", "norm")
        )
        self.vectors = matrix(table.column("vector"), count)[order]
        self.most_norm = float(self.norm.max())

    def best(self, row, label, norm, angle, vector, lows, highs, bars, k: int, same: bool) -> Iterator[tuple]:
        """Per window its number and the places and scores of its ``k`` best rows, of the anchor's label or of others."""
        wanted = min(max(a, b) for a, b in zip(lows, bars))
        start, end = 0, len(self.row)
        if wanted > 0:
            reach = norm * self.most_norm
            cosine = wanted / reach - SLACK if reach > 0 else 2.0
            if cosine > 1:
                return
            widest = np.arccos(max(-1.0, cosine)) + SLACK
            line = self.angles[:, self.own]
            start = np.searchsorted(line, angle[self.own] - widest, "left")
            end = np.searchsorted(line, angle[self.own] + widest, "right")
        labelled = self.label[start:end] == label
        at = start + np.flatnonzero((labelled if same else ~labelled) & (self.row[start:end] != row))
        if not len(at):
            return
        low, high = score_bounds(angle, norm, self.angles[at], self.norm[at])
        overlaps = np.zeros(len(at), bool)
        for least, most, bar in zip(lows, highs, bars):
            overlaps |= (high >= max(least, bar)) & (low <= most)
        at = at[overlaps]
        scores = self.vectors[at] @ vector
        for number, (least, most, bar) in enumerate(zip(lows, highs, bars)):
            inside = np.flatnonzero((scores >= max(least, bar)) & (scores <= most))
            if len(inside) > k:
                kth = np.partition(scores[inside], len(inside) - k)[len(inside) - k]
                inside = inside[scores[inside] >= kth]
            places = at[inside]
            first = np.lexsort((self.row[places], self.id[places], -scores[inside]))[:k]
            if len(first):
                yield number, places[first], scores[inside][first]


@dataclass
class Index:
    rows: DataFrame  # row, id, label, vector, norm, angles, block
    summary: Summary
    portions: int


def build(rows: DataFrame, every: int) -> Index | None:
    """Index all of ``usable``'s rows; None if there is none."""
    spark = rows.sparkSession
    rows = stored(rows, "negatives-rows")
    count, anchors = rows.agg(F.count(F.lit(1)), F.count_if(F.col("id") % every == 0)).first()
    if not count:
        return None
    near = (F.xxhash64("row") / F.lit(2.0**64) + 0.5) * count <= 2 * SAMPLE
    drawn = rows.filter(near).orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("vector").toArrow()
    references = choose_references(matrix(drawn.column(0), drawn.num_rows))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = matrix(batch.column(3), batch.num_rows)
                norms = _norms(vectors)
                spread = angles(vectors, norms, references)
                own = spread.argmin(1)
                bins = (spread[np.arange(len(own)), own] * (BINS / np.pi)).astype(np.int32).clip(0, BINS - 1)
                listed = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(own) + 1, dtype=np.int32) * len(references)), pa.array(spread.ravel())
                )
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(norms), listed, pa.array(own.astype(np.int32) * BINS + bins)],
                    ["row", "id", "label", "vector", "norm", "angles", "bin"],
                )

    schema = "row long, id long, label long, vector array<bigint>, norm double, angles array<double>, bin int"
    measured = stored(rows.mapInArrow(measure, schema), "negatives-angles")
    # a row per bin, of REFERENCES * BINS at most
    sizes = sorted((r["bin"], r["n"]) for r in measured.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).collect())
    bins = spark.createDataFrame(_deal(sizes, max(BLOCK_ROWS, -(-count // MOST_BLOCKS))), "bin int, first int, pieces int")
    piece = F.pmod(F.xxhash64("row"), F.col("pieces")).cast("int")
    dealt = measured.join(F.broadcast(bins), "bin").withColumn("block", F.col("first") + piece).drop(*bins.columns)
    dealt = stored(dealt, "negatives-index")
    edges = [f(F.col("angles")[r]).alias(f"{f.__name__}{r}") for f in (F.min, F.max) for r in range(len(references))]
    edges = dealt.groupBy("block").agg(*edges, F.min("norm").alias("least"), F.max("norm").alias("most"))
    # a row per block, whose number is bounded above
    ranges = np.array(edges.orderBy("block").collect(), float)
    summary = np.full((int(ranges[-1, 0]) + 1, ranges.shape[1] - 1), np.nan)
    summary[ranges[:, 0].astype(int)] = ranges[:, 1:]
    n = len(references)
    return Index(
        dealt,
        Summary(summary[:, :n], summary[:, n : 2 * n], summary[:, 2 * n], summary[:, 2 * n + 1]),
        max(1, -(-anchors // PORTION_ANCHORS)),
    )


def _deal(sizes: list[tuple[int, int]], rows: int) -> list[tuple[int, int, int]]:
    """``bin, first, pieces``: bins of one reference side by side share a block of about ``rows`` rows; a bin of more is
    cut into several."""
    dealt, block, filled, last = [], 0, 0, None
    for number, size in sizes:
        reference, pieces = number // BINS, -(-size // rows)
        if filled and (filled + size > rows or reference != last):
            block, filled = block + 1, 0
        dealt.append((number, block, pieces))
        if pieces > 1:
            block, filled = block + pieces, 0
        else:
            filled += size
        last = reference
    return dealt


def _visit(index: Index, asked: DataFrame, k: int, same: bool) -> DataFrame:
    """``anchor_row, window, row, id, score``: the best of each block that ``asked`` names with an anchor."""
    portion = F.pmod(F.xxhash64("row"), F.lit(index.portions)).cast("int")
    columns = ["row", "id", "label", "vector", "norm", "angles", "block"]
    windows = ["lows", "highs", "bars"]
    held = index.rows.select(
        *columns, F.explode(F.sequence(F.lit(0), F.lit(index.portions - 1))).alias("portion")
    )
    def answer(block: Block, part: pa.RecordBatch) -> pa.RecordBatch | None:
        vectors, spread = (matrix(part.column(c), part.num_rows) for c in ("vector", "angles"))
        lists = (part.column(c).to_pylist() for c in ("row", "label", "norm", *windows))
        out = []
        for vector, angle, row, label, norm, *limits in zip(vectors, spread, *lists):
            for number, at, scores in block.best(row, label, norm, angle, vector, *limits, k, same):
                out.append((row, number, block.row[at], block.id[at], scores))
        if not out:
            return None
        length = [len(o[2]) for o in out]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([o[0] for o in out], length)),
             pa.array(np.repeat(np.array([o[1] for o in out], np.int32), length)),
             *(pa.array(np.concatenate([o[c] for o in out])) for c in (2, 3, 4))],
            ["anchor_row", "window", "row", "id", "score"],
        )

    asking = asked.select(*columns, portion.alias("portion"), *windows)
    return ask_blocks(held, asking, ["block", "portion"], Block, answer, _FOUND)


def _elsewhere(index: Index, asked: DataFrame) -> DataFrame:
    """A row for each block but the anchor's own whose scores may overlap a window above its bar."""
    shared = index.rows.sparkSession.sparkContext.broadcast(index.summary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            spread = matrix(batch.column("angles"), batch.num_rows)
            lists = (batch.column(c).to_pylist() for c in ("norm", "block", "lows", "highs", "bars"))
            for number, (norm, own, lows, highs, bars) in enumerate(zip(*lists)):
                low, high = summary.bounds(spread[number], norm)
                overlaps = np.zeros(len(low), bool)
                for least, most, bar in zip(lows, highs, bars):
                    overlaps |= (high >= max(least, bar)) & (low <= most)
                overlaps[own] = False
                blocks = np.flatnonzero(overlaps).astype(np.int32)
                if len(blocks):
                    copies = batch.take(pa.array([number] * len(blocks)))
                    yield copies.set_column(batch.schema.names.index("block"), "block", pa.array(blocks))

    return asked.mapInArrow(run, asked.schema)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best_first = Window.partitionBy("anchor_row", "window").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)


def _best(index: Index, asked: DataFrame, k: int, same: bool, name: str) -> DataFrame:
    """The ``k`` best rows of every window of every anchor, over all blocks, with their rank."""
    home = stored(_visit(index, asked, k, same), f"{name}-home")
    full = home.groupBy("anchor_row", "window").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("bar"))
    full = full.filter(F.col("n") >= k).groupBy("anchor_row")
    full = full.agg(F.map_from_entries(F.collect_list(F.struct("window", "bar"))).alias("found"))
    barred = asked.drop("bars").join(full, F.col("row") == F.col("anchor_row"), "left").withColumn(
        "bars", F.expr("transform(lows, (low, i) -> coalesce(try_element_at(found, i), low))")
    )
    there = _visit(index, _elsewhere(index, barred.select(*asked.columns)), k, same)
    return stored(_ranked(home.unionByName(there), k), name)


def mine(
    rows: DataFrame,
    every: int = 100,
    positives: int = 5,
    k: int = 5,
    least: int = 80,
    most: int = 100,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become ``floor(scale * x)``, a score is the inner product of two rows. Anchors are the usable rows whose
    id is divisible by ``every``, their positives the ``positives`` best other rows of their label. For each pair come the
    ``k`` best rows of other labels whose score is from ``least`` to ``most`` hundredths of the positive's. Higher scores
    come first, then smaller ids; fewer rows if there are fewer. Rows that repeat an id are rows of their own, told apart
    by their place in the table. Which rows take part ``usable`` says; other columns are not looked at, an empty table
    gives no rows. A hundred times a score has to
    fit 64 bits.
    """
    spark = rows.sparkSession
    index = build(usable(rows, scale, id_col, vector_col, label_col), every)
    if index is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")

    def one(value: int) -> Column:
        return F.array(F.lit(value).cast("long"))

    anchors = index.rows.filter(F.col("id") % every == 0)
    asked = anchors.withColumns({"lows": one(LOWEST), "highs": one(HIGHEST), "bars": one(LOWEST)})
    near = _best(index, asked, positives, True, "negatives-positives")
    limits = near.select(
        F.col("anchor_row").alias("of"),
        F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
        F.col("rank").alias("place"),
        # least * score <= 100 * other <= most * score, in whole numbers
        F.expr(f"-((-{least} * score - pmod(-{least} * score, 100L)) div 100)").alias("low"),
        F.expr(f"({most} * score - pmod({most} * score, 100L)) div 100").alias("high"),
    ).filter("low <= high")
    windows = limits.groupBy("of").agg(F.sort_array(F.collect_list(F.struct("place", "low", "high"))).alias("w"))
    windows = windows.select("of", F.expr("w.place").alias("places"), F.expr("w.low").alias("lows"), F.expr("w.high").alias("highs"))
    windows = stored(windows, "negatives-windows")
    asked = anchors.join(windows.drop("places"), F.col("row") == F.col("of")).drop("of").withColumn("bars", F.col("lows"))
    found = _best(index, asked, k, False, "negatives-found")
    # the number of a window is the place of its positive among those with a window
    numbered = windows.select("of", F.posexplode("places").alias("number", "place")).join(limits, ["of", "place"])
    pairs = found.join(numbered, (F.col("anchor_row") == F.col("of")) & (F.col("window") == F.col("number")))
    pairs = pairs.join(anchors.select(F.col("row").alias("a"), F.col("id").alias("anchor_id")), F.col("anchor_row") == F.col("a"))
    return pairs.select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
