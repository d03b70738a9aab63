"""Ranked lexical search by exact maximum inner products over sparse ball trees.

A document is the sparse vector of its terms' saturated frequencies, an item the sparse vector of its terms' weights, and
a score their inner product, all in whole numbers. Tasks cut their documents into blocks of about ``BLOCK_DOCS`` and build
a ball tree over each: a node keeps the centroid of its documents and the largest distance from it. No document below a
node can score more than ``q.c + |q| * radius``, with ``q`` cut to the terms that occur below the node. Bounds are doubles
and are widened by more than their rounding can take away. Nodes are opened best-first; those that cannot reach the k-th
best score so far are left out with all that is below them. Leaves are scored in 64-bit integers. What a task has found in
one block is the bar for its next one.

Texts are read once per portion of items. Only the terms of the portion's items are kept of a document; counts and
document frequencies are of all documents. Items come in portions of about ``PORTION_CHARS`` characters and
``PORTION_ITEMS`` items, dealt by hash, so what is broadcast has a bound (a single longer item is a portion's excess).
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowtide.llm.common import ROWS_AT_A_TIME, id_and_text, stored, tidy
from rowtide.tables.folders import shared_folder

TOP = 20
BLOCK_DOCS, BLOCK_TERMS, LEAF_DOCS = 4096, 1 << 20, 32
PORTION_CHARS, PORTION_ITEMS = 4_000_000, 4096
# Bytes of a text whose terms are listed at a time.
STRETCH = 4_000_000
# The part of a bound that covers the rounding of its sums; one more is added for short ones.
SLACK = 1e-9

# What is not a digit, an ASCII letter or beyond ASCII parts terms; only A-Z have another case.
_FOLD = bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalnum() else 0x20 for b in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, a bounded stretch at a time."""
    at = 0
    while at < len(text):
        part = text[at : at + STRETCH].translate(_FOLD)
        at += len(part)
        if at < len(text):
            # the term at the cut belongs to the next stretch, unless it fills this one
            back = part.rfind(b" ") + 1
            if back:
                at -= len(part) - back
                part = part[:back]
            else:
                whole = bytearray(part)
                while at < len(text) and (more := text[at : at + 1].translate(_FOLD)) != b" ":
                    whole += more
                    at += 1
                part = bytes(whole)
        yield part.split()


def weight(count: int, holding: int) -> int:
    """What a term counts that ``holding`` of ``count`` documents have."""
    return math.floor(1000 * math.log((2 * count + 2) / (2 * holding + 1)))


class BallTree:
    """Documents as rows ``start[i]:start[i + 1]`` of ``term`` and ``value``; none without a term, none negative."""

    def __init__(self, start: np.ndarray, term: np.ndarray, value: np.ndarray, width: int):
        self.width = width
        self._start, self._term, self._value = start, term, value
        self._dense = np.zeros(width)
        self._square = np.add.reduceat(value.astype(float) ** 2, start[:-1]) if len(start) > 1 else np.zeros(0)
        self.order = np.arange(len(start) - 1)
        # per node: terms, means and radius of its ball, its rows in the order, and its children
        self.nodes: list[tuple] = []
        if len(self.order):
            self._split(0, len(self.order))
        term, value, start = self._rows(self.order)
        self.term, self.value, self.start = term, value, np.append(start, len(term))

    def _rows(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Terms and values of some rows one after another, and where each row starts."""
        length = self._start[rows + 1] - self._start[rows]
        begin = np.cumsum(length) - length
        at = np.repeat(self._start[rows] - begin, length) + np.arange(length.sum())
        return self._term[at], self._value[at], begin

    def _distances(self, rows: np.ndarray, taken: tuple, one: int) -> np.ndarray:
        """Squared distances of the rows from one of them; near enough to choose a split by."""
        a, b = self._start[one], self._start[one + 1]
        self._dense[self._term[a:b]] = self._value[a:b]
        dots = np.add.reduceat(self._dense[taken[0]] * taken[1], taken[2])
        self._dense[self._term[a:b]] = 0
        return np.maximum(0, self._square[rows] + self._square[one] - 2 * dots)

    def _split(self, low: int, high: int) -> int:
        """The node of ``order[low:high]``. Halves are equal in size, so the tree is shallow whatever the documents."""
        rows = self.order[low:high]
        taken = self._rows(rows)
        term, value, begin = taken
        sums = np.bincount(term, value, minlength=self.width)
        held = np.flatnonzero(sums)
        mean = sums[held] / len(rows)
        # |v - c|^2 = |c|^2 + sum over v's terms of (v - c)^2 - c^2: no large numbers cancel where v is near c
        self._dense[held] = mean
        at = self._dense[term]
        apart = np.add.reduceat((value - at) ** 2 - at**2, begin) + (mean**2).sum()
        self._dense[held] = 0
        # what the sums may have lost
        lost = SLACK * ((mean**2).sum() + self._square[rows].max())
        radius = math.sqrt(max(0.0, float(apart.max())) + lost)
        number = len(self.nodes)
        self.nodes.append(None)
        children = ()
        if len(rows) > LEAF_DOCS:
            far = self._distances(rows, taken, rows[0])
            first = self._distances(rows, taken, rows[far.argmax()])
            if first.max() > 0:
                second = self._distances(rows, taken, rows[first.argmax()])
                self.order[low:high] = rows[np.argsort(first - second, kind="stable")]
                middle = (low + high) // 2
                del taken, term, value, at
                children = self._split(low, middle), self._split(middle, high)
        self.nodes[number] = held, mean, radius, low, high, children
        return number

    def bound(self, number: int, query: np.ndarray) -> float:
        """At least the largest inner product of ``query`` (dense, not negative) with a document of the node."""
        held, mean, radius, *_ = self.nodes[number]
        cut = query[held]
        return (float(cut @ mean) + math.sqrt(float(cut @ cut)) * radius) * (1 + SLACK) + 1

    def search(self, weights: np.ndarray, query: np.ndarray, best: "Best", ids: np.ndarray) -> None:
        """Put what the tree has for a query into ``best``. ``weights`` and ``query`` are the same, as integers and as
        doubles."""
        front = [(-self.bound(0, query), 0)] if self.nodes else []
        while front:
            bound, number = heapq.heappop(front)
            if -bound < best.bar:
                return
            *_, low, high, children = self.nodes[number]
            for child in children:
                reach = self.bound(child, query)
                if reach >= best.bar:
                    heapq.heappush(front, (-reach, child))
            if not children:
                a, b = self.start[low], self.start[high]
                scores = np.add.reduceat(weights[self.term[a:b]] * self.value[a:b], self.start[low:high] - a)
                best.add(scores, ids[self.order[low:high]])


class Best:
    """The ``count`` best scores above zero, equal ones by smaller id."""

    def __init__(self, count: int):
        self.count, self.bar = count, 1
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.bar
        if good.any():
            scores, ids = np.append(self.scores, scores[good]), np.append(self.ids, ids[good])
            kept = np.lexsort((ids, -scores))[: self.count]
            self.scores, self.ids = scores[kept], ids[kept]
            if len(kept) == self.count:
                # an equal score may still have a smaller id
                self.bar = max(1, int(self.scores[-1]))


@dataclass
class Portion:
    """Some items: their ids, the numbers of their terms, and how often an item has each."""

    ids: pa.Array
    numbers: dict[bytes, int]
    asked: list[tuple[np.ndarray, np.ndarray]]


def read_portion(items: pa.Table) -> Portion:
    numbers: dict[bytes, int] = {}
    asked = []
    for text in items.column("text").to_pylist():
        counts = Counter(t for part in terms(text or b"") for t in part)
        at = [numbers.setdefault(t, len(numbers)) for t in counts]
        asked.append((np.array(at, np.int64), np.array(list(counts.values()), np.int64)))
    return Portion(items.column("id").combine_chunks(), numbers, asked)


def _vectors(docs: DataFrame, shared) -> DataFrame:
    """``id, n, terms, tfs``: all terms of a document counted, and those of the items with their frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = shared.value.numbers
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_A_TIME):
                batch = whole.slice(at, ROWS_AT_A_TIME)
                sizes, found, often = [], [], []
                for text in batch.column(1):
                    size, counts = 0, Counter()
                    for part in terms(text.as_py() or b""):
                        size += len(part)
                        counts.update(filter(numbers.__contains__, part))
                    sizes.append(size)
                    found.append([numbers[t] for t in counts])
                    often.append(list(counts.values()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int32())),
                     pa.array(often, pa.list_(pa.int64()))],
                    ["id", "n", "terms", "tfs"],
                )

    return docs.mapInArrow(tidy(run), "id long, n long, terms array<int>, tfs array<bigint>")


def _search(vectors: DataFrame, shared, holding: dict[int, int], count: int, words: int, top: int) -> DataFrame:
    """``number, doc_id, score``: per task the best of every item (its number in the portion)."""
    spark = vectors.sparkSession
    weights = np.array([weight(count, holding.get(n, 0)) for n in range(len(shared.value.numbers))], np.int64)
    weighed = spark.sparkContext.broadcast(weights)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        waiting, rows, size = [], 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_A_TIME):
                part = batch.slice(at, ROWS_AT_A_TIME)
                waiting.append(part)
                rows, size = rows + part.num_rows, size + len(part.column(2).flatten())
                if rows >= BLOCK_DOCS or size >= BLOCK_TERMS:
                    yield pa.Table.from_batches(waiting)
                    waiting, rows, size = [], 0, 0
        if waiting:
            yield pa.Table.from_batches(waiting)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, asked = weighed.value, shared.value.asked
        best = [Best(top) for _ in asked]
        whole, query = np.zeros(len(weights), np.int64), np.zeros(len(weights))
        for block in blocks(batches):
            ids = block.column("id").to_numpy()
            n = block.column("n").to_numpy()
            found = block.column("terms").combine_chunks()
            length = np.asarray(found.value_lengths())
            start = np.append(0, np.cumsum(length))
            term = np.asarray(found.flatten())
            often = np.asarray(block.column("tfs").combine_chunks().flatten())
            m = np.repeat(100 - 25 + 25 * n * count // words, length)
            value = 1_000_000_000 * often // (1000 * often + 12 * m)
            tree = BallTree(start, term, value, len(weights))
            for (at, times), known in zip(asked, best):
                whole[at] = weights[at] * times
                query[at] = whole[at]
                tree.search(whole, query, known, ids)
                whole[at], query[at] = 0, 0
            del tree
        for number, known in enumerate(best):
            if len(known.ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(known.ids), pa.int32()), pa.array(known.ids), pa.array(known.scores)],
                    ["number", "doc_id", "score"],
                )

    return vectors.filter("id is not null and size(terms) > 0").select("id", "n", "terms", "tfs").mapInArrow(
        tidy(run), "number int, doc_id long, score long"
    )


def rank(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``<item_col>, rank, doc_id, score``: the ``top`` best documents of every item with a score above zero, best first,
    equal scores by smaller id; all there are if fewer.

    Ids of documents are whole numbers. Null texts have no terms. Documents without id count in all frequencies but
    cannot be named, so they are not returned; rows that repeat an id are documents of their own. Rows of ``items`` with
    equal id and text are one item, rows that share only the id are items of their own with ranks of their own. Other
    columns are not looked at. An empty table of either kind gives no rows.
    """
    spark = docs.sparkSession
    texts = id_and_text(docs, id_col, text_col).select(F.col("id").cast("long").alias("id"), "text")
    asked = stored(id_and_text(items, item_col, item_text_col).distinct(), "lexical-items")
    rows, chars = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    portions = max(-(-rows // PORTION_ITEMS), -(-chars // PORTION_CHARS))
    portion = F.pmod(F.xxhash64("id", "text"), F.lit(max(1, portions)))
    folder = shared_folder(spark, "lexical-ranked")
    schema = f"{item_col} {asked.schema['id'].dataType.simpleString()}, rank int, doc_id long, score long"
    paths = []
    for number in range(portions):
        # of bounded size, see above
        part = asked.filter(portion == number).orderBy("id", "text").toArrow()
        if not part.num_rows:
            continue
        paths.append(f"{folder}/portion={number}")
        _rank_portion(texts, read_portion(part), top, item_col).write.parquet(paths[-1])
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _rank_portion(texts: DataFrame, portion: Portion, top: int, item_col: str) -> DataFrame:
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(portion)
    vectors = stored(_vectors(texts, shared), "lexical-vectors")
    count, words = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    # a row per term of the portion's items
    holding = {row["term"]: row["n"] for row in held.collect()}
    found = _search(vectors, shared, holding, count, words, top)
    best_first = Window.partitionBy("number").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= top)
    ids = spark.createDataFrame(pa.table({"at": pa.array(range(len(portion.ids)), pa.int32()), item_col: portion.ids}))
    # a row per item of the portion
    return ranked.join(F.broadcast(ids), F.col("number") == F.col("at")).select(item_col, "rank", "doc_id", "score")
