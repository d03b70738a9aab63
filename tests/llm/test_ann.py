import math

import numpy as np
import pytest

from rowtide.llm import ann


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, None if v is None else [None if x is None else float(x) for x in v], 1, "x") for i, v in rows],
        "vec_id long, embedding array<float>, cell int, id string")


def brute(rows, every, k):
    used = []
    for i, v in rows:
        if i is None or v is None or len(v) != 4 or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        used.append((i, np.array([float(np.float32(x)) for x in v])))
    out = []
    for n, (q, v) in enumerate(used):
        if q % every == 0:
            near = sorted((float(np.sqrt(((w - v) ** 2).sum())), i) for m, (i, w) in enumerate(used) if m != n)
            out += [(q, rank, i, pytest.approx(d)) for rank, (d, i) in enumerate(near[:k], 1)]
    return in_order(out)


def in_order(found):
    """Queries that share an id have ranks of their own."""
    return sorted(found, key=lambda r: (r[0], r[1], round(float(getattr(r[3], "expected", r[3])), 9), r[2]))


def run(spark, rows, every, k):
    return in_order(tuple(r) for r in ann.neighbours(frame(spark, rows), every, k).collect())


def test_all_cells_visited_is_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "TARGET", 1.0)
    for name, value in (("CENTROIDS", 6), ("BLOCK_ROWS", 20), ("PORTION_QUERIES", 7)):
        monkeypatch.setattr(ann, name, value)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(200)] + [(300 + i, [1, 2, 3, 4]) for i in range(60)]
    rows += [(400, None), (410, [0, 0, 0, 0]), (420, [1, None, 0, 0]), (430, [1, math.nan, 0, 0]), (440, [1, math.inf, 0, 0]),
             (450, [1, 2, 3]), (None, [1, 2, 3, 4]), (460, []), (10, [9, 9, 9, 9]), (20, rows[20][1])]
    index = ann.build(frame(spark, rows))
    got = ann.search(index, index.rows.filter("id % 10 = 0").select("row", "id", "vector"), share=1.0).collect()
    assert in_order(map(tuple, got)) == brute(rows, 10, 10)


def test_rows_that_share_an_id(spark):
    rows = [(0, [1, 2, 0, 0]), (0, [1, 1.1, 0, 0]), (1, [1, 2, 0, 0]), (1, [1, 1.1, 0, 0]), (1, [1, 1.1, 0, 0])]
    got = run(spark, rows, 2, 10)
    assert got == brute(rows, 2, 10) and len(got) == 8


def test_questions_move_not_the_vectors(spark, monkeypatch):
    """More queries do not send more vectors: what is dealt is the index and a row per query and block it visits."""
    monkeypatch.setattr(ann, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(9)
    index = ann.build(frame(spark, [(i, rng.normal(size=4).tolist()) for i in range(400)]))
    blocks = max(first + pieces for first, pieces in index.blocks)
    plan = ann.search(index, index.rows.select("row", "id", "vector"), share=0.2)
    sent = plan._jdf.queryExecution().optimizedPlan().toString()
    assert sent.count("RepartitionByExpression") == 1 and "FlatMapCoGroups" not in sent
    assert plan.count() == 4000 and blocks >= 8


def test_few_rows(spark):
    assert run(spark, [], 1, 10) == []
    assert run(spark, [(0, [1, 1, 1, 1])], 1, 10) == []
    rows = [(0, [1, 1, 1, 1]), (1, [1, 1, 1, 2]), (2, [1, 1, 1, 0])]
    assert run(spark, rows, 2, 10) == brute(rows, 2, 10)


def test_cells_come_in_order():
    rng = np.random.default_rng(4)
    books = ann.Codebooks(rng.normal(size=(9, 3)), rng.normal(size=(7, 2)))
    query = rng.normal(size=5)
    sums = ((books.first - query[:3]) ** 2).sum(1)[:, None] + ((books.second - query[3:]) ** 2).sum(1)[None]
    assert list(books.in_order(query)) == np.argsort(sums.ravel()).tolist()


def test_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = {}
    for r in ann.neighbours(vectors).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    rows = vectors.select("vec_id", "embedding").collect()
    ids, points = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    hits = 0
    for q in ids[ids % 100 == 0]:
        distance = ((points - points[ids == q]) ** 2).sum(1)
        hits += len(found[q] & set(ids[np.argsort(distance)[1:11]].tolist()))
    assert hits / (10 * len(found)) > 0.92
