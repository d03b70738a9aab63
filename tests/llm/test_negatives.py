from math import ceil, floor

import numpy as np
import pytest

from rowtide.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, row string"


def brute_force(rows, every, positives=5, k=5, least=80, most=100):
    """``rows``: id, vector, label."""
    used = [(i, [floor(256 * float(np.float32(x))) for x in v], y) for i, v, y in rows]
    out = []
    for a, (anchor, u, label) in enumerate(used):
        if anchor % every:
            continue
        scores = [(-sum(x * y for x, y in zip(u, v)), i, b, y) for b, (i, v, y) in enumerate(used) if b != a]
        for score, positive, *_ in sorted(s for s in scores if s[3] == label)[:positives]:
            inside = sorted(s for s in scores if s[3] != label and least * -score <= 100 * -s[0] <= most * -score)
            out += [(anchor, positive, r, i, -score, -s) for r, (s, i, *_) in enumerate(inside[:k], 1)]
    return sorted(out)


def frame(spark, rows):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], y, 7, "x") for i, v, y in rows]
    return spark.createDataFrame(rows, SCHEMA)


def found(spark, rows, every, **options):
    return sorted(map(tuple, negatives.mine(frame(spark, rows), every, **options).collect()))


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 40)


def clustered(rng, count, size=12):
    centres = rng.normal(size=(6, size))
    vectors = centres[rng.integers(0, 6, count)] + rng.normal(scale=0.4, size=(count, size))
    return [(i, v.astype(np.float32).tolist(), int(y)) for i, (v, y) in enumerate(zip(vectors, rng.integers(0, 4, count)))]


def test_against_brute_force(spark, small_blocks):
    rows = clustered(np.random.default_rng(2), 500)
    # many copies of one vector, an anchor among them, of two labels
    rows += [(10_000 + i, rows[0][1], i % 2) for i in range(150)]
    want = brute_force(rows, 20)
    assert len(want) > 500 and found(spark, rows, 20) == want


def test_other_limits(spark, small_blocks):
    rows = clustered(np.random.default_rng(4), 200)
    assert found(spark, rows, 25, positives=2, k=3, least=50, most=120) == brute_force(rows, 25, 2, 3, 50, 120)


def test_copies_of_blocks_for_portions_of_anchors(spark, small_blocks, monkeypatch):
    rows = clustered(np.random.default_rng(6), 200)
    monkeypatch.setattr(negatives, "PORTION_ANCHORS", 5)
    assert found(spark, rows, 10) == brute_force(rows, 10)


def test_odd_rows(spark):
    good = [(0, [1, 0], 1), (1, [1, 0], 1), (2, [0.9, 0], 2), (2, [0.9, 0.1], 2), (3, [0, 0], 1), (4, [-1, 0], 2), (5, [0, 0], 2),
            (0, [0.5, 0.5], 2), (7, [1, 1], 1)]
    left_out = [(10, None, 1), (20, [None, 1], 1), (30, [float("nan"), 1], 2), (40, [float("inf"), 0], 2), (50, [1, 2], None),
                (None, [1, 0], 2), (60, [1, 0, 0], 1)]
    want = brute_force(good, 10)
    assert want and found(spark, good + left_out, 10) == want
    # a zero anchor, whose scores are all zero
    zeros = [(0, [0, 0], 1), (1, [3, 1], 1), (2, [5, 5], 2), (3, [0, 0], 2)]
    assert found(spark, zeros, 10) == brute_force(zeros, 10) == [(0, 1, 1, 2, 0, 0), (0, 1, 2, 3, 0, 0)]
    for none in ([], left_out[:3], [(0, [1.0], 1)], [(0, [1.0], 1), (1, [-1.0], 1), (2, [-1.0], 2)]):
        assert found(spark, none, 10) == []


def test_bounds_hold():
    rng = np.random.default_rng(8)
    vectors = np.concatenate([rng.integers(-300, 300, (200, 6)), np.zeros((1, 6), int), np.tile([[7, 0, 0, 0, 0, 0]], (3, 1))])
    vectors = np.concatenate([vectors, -vectors[:20], vectors[:20] * 3])
    references = negatives.choose_references(vectors)
    assert np.allclose((references**2).sum(1), 1) and len(references) == negatives.REFERENCES
    norms = negatives._norms(vectors)
    spread = negatives.angles(vectors, norms, references)
    blocks = np.arange(len(vectors)) % 5
    edges = [np.array([f(spread[blocks == b], axis=0) for b in range(5)]) for f in (np.min, np.max)]
    edges += [np.array([f(norms[blocks == b]) for b in range(5)]) for f in (np.min, np.max)]
    summary = negatives.Summary(*edges)
    tight = 0
    for n in range(len(vectors)):
        scores = vectors @ vectors[n]
        low, high = negatives.score_bounds(spread[n], norms[n], spread, norms)
        assert (low <= scores).all() and (scores <= high).all()
        low_block, high_block = summary.bounds(spread[n], norms[n])
        assert all(low_block[b] <= scores[blocks == b].min() and scores[blocks == b].max() <= high_block[b] for b in range(5))
        tight += (high < 0.9 * norms[n] * norms).sum()
    assert tight > 0.3 * len(vectors) ** 2


def test_bins_are_dealt_to_blocks():
    bins = negatives.BINS
    sizes = [(0, 5), (3, 4), (4, 3), (9, 35), (10, 2), (bins + 1, 1)]
    assert negatives._deal(sizes, 10) == [(0, 0, 1), (3, 0, 1), (4, 1, 1), (9, 2, 4), (10, 6, 1), (bins + 1, 7, 1)]


def test_shares_round_inwards(spark):
    """Limits that are no whole numbers."""
    rows = [(0, [1 / 16], 1), (1, [7 / 256], 1), *((10 + n, [n / 256], 2) for n in range(9))]
    got = found(spark, rows, 100, k=20)
    assert [g[5] for g in got] == [16 * n for n in range(8, 0, -1) if ceil(0.8 * 112) <= 16 * n <= 112]
