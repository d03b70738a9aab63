import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest

from rowtide.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_force(docs, items, top):
    """Every item's documents by score, then id."""
    counts = [(i, Counter(split(t))) for i, t in docs]
    n = {k: sum(c.values()) for k, (_, c) in enumerate(counts)}
    count, words = sum(v > 0 for v in n.values()), sum(n.values())
    holding = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for k, (doc, c) in enumerate(counts):
            score = 0
            for t in split(text):
                if c[t]:
                    m = 75 + 25 * n[k] * count // words
                    weight = floor(1000 * log((2 * count + 2) / (2 * holding[t] + 1)))
                    score += weight * (1000000000 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0 and doc is not None:
                scores.append((-score, doc))
        out += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def frames(spark, docs, items):
    rows = [(i, t, 1, "x") for i, t in docs]
    return (spark.createDataFrame(rows, "doc_id long, text string, rank int, score string"),
            spark.createDataFrame([(i, t, None) for i, t in items], "item_id int, text string, doc_id string"))


def found(spark, docs, items, **options):
    return sorted(map(tuple, lexical.rank(*frames(spark, docs, items), **options).collect()), key=str)


def words(rng, count, size):
    return " ".join(f"w{n}" for n in (size * rng.random(count) ** 3).astype(int))


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", 300)
    monkeypatch.setattr(lexical, "LEAF_DOCS", 4)


def test_against_brute_force(spark, small_blocks):
    rng = np.random.default_rng(3)
    docs = [(i, words(rng, rng.integers(0, 60), 200)) for i in range(400)]
    # groups of copies, so that scores tie
    docs += [(1000 + i, docs[i % 7][1]) for i in range(200)]
    items = [(i, words(rng, 8, 200)) for i in range(20)]
    assert found(spark, docs, items, top=20) == brute_force(docs, items, 20)


def test_odd_rows(spark):
    docs = [(1, "Ä b B's"), (2, None), (None, "b c"), (3, ""), (4, "b"), (4, "b"), (4, "c"), (5, "x " * 300_000 + "b"),
            (6, "...b\x00c\x7fÄ"), (7, "ä"), (-8, "b")]
    items = [(1, "B b, Ä"), (1, "B b, Ä"), (1, "c"), (2, None), (3, "..."), (None, "c x"), (4, "nowhere")]
    distinct = list(dict.fromkeys(items))
    assert found(spark, docs, items) == brute_force(docs, distinct, 20)
    assert found(spark, docs, [(2, None)]) == [] == found(spark, [], items) == found(spark, docs, [])
    assert found(spark, [(1, None)], items) == []


def test_items_in_portions(spark, monkeypatch):
    rng = np.random.default_rng(5)
    docs = [(i, words(rng, 30, 60)) for i in range(80)]
    items = [(i, words(rng, 6, 60)) for i in range(15)]
    monkeypatch.setattr(lexical, "PORTION_ITEMS", 4)
    assert found(spark, docs, items, top=3) == brute_force(docs, items, 3)


def test_terms_across_stretches(monkeypatch):
    rng = np.random.default_rng(7)
    text = "".join(rng.choice(list("ab -Ä"), 400))
    want = [t.encode() for t in split(text)]
    for size in (1, 2, 3, 7, 50, 1000):
        monkeypatch.setattr(lexical, "STRETCH", size)
        assert [t for part in lexical.terms(text.encode()) for t in part] == want


def tree_of(rng, count, width):
    rows = [np.sort(rng.choice(width, rng.integers(1, 12), replace=False)) for _ in range(count)]
    # clusters: documents of one half use one half of the terms
    rows = [np.unique(r // 2 + (width // 2) * (k % 2)) for k, r in enumerate(rows)]
    start = np.append(0, np.cumsum([len(r) for r in rows]))
    value = rng.integers(1, 1_000_000, start[-1])
    return lexical.BallTree(start, np.concatenate(rows), value, width), rows, start, value


def test_bounds_hold_and_prune(monkeypatch):
    monkeypatch.setattr(lexical, "LEAF_DOCS", 8)
    rng = np.random.default_rng(11)
    tree, rows, start, value = tree_of(rng, 500, 80)
    dense = np.zeros((500, 80))
    for k, r in enumerate(rows):
        dense[k, r] = value[start[k] : start[k + 1]]
    opened = []
    for _ in range(30):
        query = np.zeros(80)
        at = rng.choice(40, 5, replace=False)
        query[at] = rng.integers(1, 9000, 5)
        scores = dense @ query
        for number, (*_, low, high, children) in enumerate(tree.nodes):
            assert tree.bound(number, query) >= scores[tree.order[low:high]].max()
        best = lexical.Best(5)
        leaves = []
        add = best.add
        best.add = lambda s, i: (leaves.append(len(i)), add(s, i))
        tree.search(query.astype(np.int64), query, best, np.arange(500))
        assert best.ids.tolist() == np.lexsort((np.arange(500), -scores))[:5].tolist()
        assert best.scores.tolist() == scores[best.ids].astype(int).tolist()
        opened.append(sum(leaves))
    # the half of the documents without a term of the query is never scored
    assert max(opened) <= 300


def test_equal_documents_make_one_leaf(monkeypatch):
    monkeypatch.setattr(lexical, "LEAF_DOCS", 2)
    tree = lexical.BallTree(np.arange(0, 22, 2), np.tile([0, 3], 10), np.tile([5, 7], 10), 4)
    assert len(tree.nodes) == 1
    best = lexical.Best(3)
    tree.search(np.array([1, 0, 0, 2]), np.array([1.0, 0, 0, 2]), best, np.arange(10)[::-1].copy())
    assert best.ids.tolist() == [0, 1, 2] and best.scores.tolist() == [19] * 3


def test_large_numbers_stay_whole():
    """Sums beyond what doubles hold exactly."""
    value = np.array([999_999_937, 999_999_893])
    tree = lexical.BallTree(np.array([0, 1, 2]), np.array([0, 0]), value, 1)
    best, weight = lexical.Best(1), np.array([9_000_000_001])
    tree.search(weight, weight.astype(float), best, np.array([4, 2]))
    assert best.scores.tolist() == [999_999_937 * 9_000_000_001] and best.ids.tolist() == [4]
