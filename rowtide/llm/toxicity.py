"""Toxicity of texts: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text is the set of its hashed n-grams (lower case, 3 to 5 characters). Every n-gram present is scaled by the log ratio
of its smoothed counts in toxic and other labelled texts, and a logistic regression with an L2 penalty is fitted on the
scaled features. The fit sees at most ``per_class`` labelled texts of each class, chosen by a hash of their id, and at
most ``features_per_class`` features of each (texts that would exceed it are passed over), so it is one task of bounded
size and a scarce class is not crowded out. Scoring reads every whole text once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.functions.lists import broadcast_if_short
from rowtide.llm.common import bounded_sample, ddl, small_batches, stored

ORDERS = (3, 4, 5)
BITS = 17
PER_CLASS = 3000
FEATURES_PER_CLASS = 20_000_000
ROUNDS, STEP, PENALTY = 60, 0.5, 1e-3
# Features of the training texts handled at a time.
BLOCK = 1_000_000
# Characters of a text handled at a time.
STRETCH = 1_000_000


class Features:
    """The distinct hashed n-grams of texts."""

    def __init__(self):
        self._seen = np.zeros(1 << BITS, np.int32)

    def _stretch(self, points: np.ndarray) -> np.ndarray:
        found = []
        value = np.zeros(len(points), np.uint32)
        for order in range(1, ORDERS[-1] + 1):
            value = value[: len(points) - order + 1] * np.uint32(0x01000193) + points[order - 1 :]
            if not len(value):
                break
            if order in ORDERS:
                mixed = (value ^ (value >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + np.uint32(order * 0x9E3779B1 & 0xFFFFFFFF)
                mixed = (mixed ^ (mixed >> np.uint32(12))) * np.uint32(0x297A2D39)
                found.append(mixed >> np.uint32(32 - BITS))
        every = np.concatenate(found) if found else np.zeros(0, np.uint32)
        number = np.arange(1, len(every) + 1, dtype=np.int32)
        self._seen[every] = number
        return every[self._seen[every] == number]

    def of(self, text: str | None) -> np.ndarray:
        points = np.frombuffer((text or "").lower().encode("utf-32-le"), np.uint32)
        if len(points) <= STRETCH:
            return self._stretch(points)
        overlap = ORDERS[-1] - 1
        parts = [self._stretch(points[at : at + STRETCH + overlap]) for at in range(0, len(points), STRETCH)]
        return np.unique(np.concatenate(parts))


@dataclass
class Model:
    """The probability of being toxic is the logistic function of ``bias`` plus the weights of the features present,
    divided by the length of the text's feature vector so that long texts do not run away.

    ``weights`` are regression weight times log-count ratio.
    """

    weights: np.ndarray
    bias: float

    def score(self, present: np.ndarray) -> float:
        margin = self.bias + self.weights[present].sum(dtype=np.float64) * _scale(len(present))
        return float(1 / (1 + np.exp(-np.clip(margin, -50, 50))))


def _scale(features):
    return 10 / np.sqrt(np.maximum(1, features))


def _blocks(features: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``BLOCK`` features."""
    start, total = 0, 0
    for number, found in enumerate(features):
        total += len(found)
        if total >= BLOCK or number == len(features) - 1:
            yield start, number + 1
            start, total = number + 1, 0


def train(features: list[np.ndarray], toxic: np.ndarray) -> Model:
    """Fit on the distinct features of texts and their labels."""
    size = 1 << BITS
    if not len(toxic) or toxic.all() or not toxic.any():
        # nothing to tell apart: the one label there is, else not toxic
        return Model(np.zeros(size, np.float32), 50.0 if len(toxic) and toxic.all() else -50.0)
    length = np.array([len(f) for f in features])
    scale = _scale(length)
    # classes count alike
    balance = np.where(toxic, 0.5 / toxic.mean(), 0.5 / (1 - toxic.mean())) / len(toxic)
    blocks = list(_blocks(features))

    def sums(values: np.ndarray) -> np.ndarray:
        """Per feature, the sum of ``values`` (one per text) over the texts that have it."""
        out = np.zeros(size)
        for a, b in blocks:
            out += np.bincount(np.concatenate(features[a:b]), np.repeat(values[a:b], length[a:b]), minlength=size)
        return out

    def margins(weights: np.ndarray) -> np.ndarray:
        out = np.zeros(len(length))
        for a, b in blocks:
            filled = np.flatnonzero(length[a:b])
            if len(filled):
                first = np.cumsum(length[a:b])[filled] - length[a:b][filled]
                out[a + filled] = np.add.reduceat(weights[np.concatenate(features[a:b])], first)
        return out * scale

    counts = [1.0 + sums((toxic == label).astype(float)) for label in (True, False)]
    ratio = np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())
    # gradient descent with a step per coordinate
    weights, bias = np.zeros(size), 0.0
    past, past_bias = np.full(size, 1e-8), 1e-8
    for _ in range(ROUNDS):
        chance = 1 / (1 + np.exp(-np.clip(margins(weights * ratio) + bias, -50, 50)))
        error = (chance - toxic) * balance
        slope = sums(error * scale) * ratio + PENALTY * weights
        past += slope**2
        past_bias += error.sum() ** 2
        weights -= STEP * slope / np.sqrt(past)
        bias -= STEP * error.sum() / np.sqrt(past_bias)
    return Model((weights * ratio).astype(np.float32), float(bias))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    per_class: int = PER_CLASS,
    features_per_class: int = FEATURES_PER_CLASS,
) -> Model:
    """Learn from the rows of ``labels`` (``id_col``, ``label_col`` 0 or 1) whose document is in ``docs``.

    Rows with a null id or label are left out; of contradicting labels the larger counts. With one label only, that
    label is always the answer; with none, no text is toxic.
    """
    marked = labels.select(id_col, F.col(label_col).cast("int").alias("toxic")).filter("toxic in (0, 1)")
    marked = marked.groupBy(id_col).agg(F.max("toxic").alias("toxic"))
    chosen = stored(bounded_sample(marked, id_col, "toxic", per_class), "toxicity-sample")
    texts = docs.select(id_col, docs[text_col].cast("string").alias("text")).join(broadcast_if_short(chosen), id_col)
    texts = texts.select("toxic", "text", F.xxhash64(id_col, "text").alias("turn"))

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            packed = [features.of(t).astype("<u4").tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary()), batch.column(2)],
                                             ["toxic", "features", "turn"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, toxic, total = [], [], {0: 0, 1: 0}
        for batch in batches:
            for label, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if total[label] + len(packed) // 4 <= features_per_class:
                    total[label] += len(packed) // 4
                    features.append(np.frombuffer(packed, "<u4"))
                    toxic.append(label == 1)
        model = train(features, np.array(toxic, bool))
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.bias])], ["weights", "bias"])

    sets = texts.mapInArrow(present, "toxic int, features binary, turn long")
    # at most 2 x per_class rows
    learned = sets.repartition(1).sortWithinPartitions("turn").mapInArrow(learn, "weights binary, bias double").collect()
    if not learned:
        return train([], np.zeros(0, bool))
    return Model(np.frombuffer(learned[0]["weights"], np.float32), learned[0]["bias"])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, score`` for every row of ``docs``: how likely its text is toxic, 0 to 1.

    A null text counts as empty and gets the score of having no feature. Null ids and repeated rows stay, other columns
    are not looked at, an empty table gives no rows.
    """
    rows = small_batches(docs).select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, known = Features(), shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                scores = [known.score(features.of(t)) for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["id", "score"])

    return rows.mapInArrow(run, f"id {ddl(rows, 'id')}, score double").withColumnRenamed("id", id_col)
