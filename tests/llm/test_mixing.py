from collections import Counter
from math import ceil, floor

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowtide.llm import mixing


def edf(shares, blocks):
    """By brute force: at each slot the released block that is due first, the first source of equal ones."""
    done, slots, t = [0] * len(shares), {}, 0
    while any(n < b for n, b in zip(done, blocks)):
        ready = [(ceil((n + 1) / w - 1e-6), i) for i, (n, w, b) in enumerate(zip(done, shares, blocks)) if n < b and floor(n / w + 1e-6) <= t]
        if ready:
            pick = min(ready)[1]
            slots[pick, done[pick]] = t
            done[pick] += 1
        t += 1
    return slots


def run(spark, rows, **options):
    docs = spark.createDataFrame([(d, s, "t", 1) for d, s in rows], "doc_id long, source string, block string, position int")
    return mixing.mix(docs, **options).collect()


def check(rows, got, block_rows):
    assert Counter(rows) == Counter((r["doc_id"], r["source"]) for r in got)
    assert len({r["position"] for r in got}) == len(got)
    by_source = {}
    for r in sorted(got, key=lambda r: r["position"]):
        assert r["release"] <= r["slot"] < r["deadline"] and r["position"] // block_rows == r["slot"]
        by_source.setdefault(r["source"], []).append(r)
    for of_source in by_source.values():
        assert [r["block"] for r in of_source] == [i // block_rows for i in range(len(of_source))]


def test_random_weights_against_brute_force(spark):
    """Of every weight vector: the slots brute force gives, all windows, and less than one block off at every slot."""
    rng = np.random.default_rng(1)
    wanted, frames = {}, []
    for case in range(200):
        count = int(rng.integers(2, 51))
        w = rng.dirichlet(np.full(count, rng.choice([0.3, 1.0, 10.0])))
        w = np.maximum(w, 1e-4)
        w = w / w.sum()
        if case % 5 == 0:  # weights whose windows end on whole slots
            w = np.full(count, 1 / count)
        horizon = int(rng.integers(100, 400))
        blocks = np.maximum(1, np.floor(horizon * w).astype(int) + 1)
        wanted[case] = w, blocks, horizon
        lanes = [(case, False, f"s{i:02}", float(x), int(b)) for i, (x, b) in enumerate(zip(w, blocks))]
        frames += lanes
    schema = "case int, pooled boolean, lane string, share double, blocks long"
    every = spark.createDataFrame(frames, schema)
    for case, (w, blocks, horizon) in wanted.items():
        slots = edf(w, blocks)
        if case % 20 in (0, 7):
            # the expression; the other vectors test the rule itself
            made = mixing.schedule(every.filter(F.col("case") == case), max(slots.values()) + 1)
            assert {(int(r["lane"][1:]), r["block"]): r["slot"] for r in made.collect()} == slots
        taken = np.full(horizon, -1)
        for (i, n), t in slots.items():
            assert floor(n / w[i] + 1e-6) <= t < ceil((n + 1) / w[i] - 1e-6)
            if t < horizon:
                taken[t] = i
        done = np.zeros(len(w))
        for t, i in enumerate(taken, 1):
            if i >= 0:
                done[i] += 1
            assert (np.abs(done - t * w) < 1).all()


def test_registered_path_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_SLOTS", 1 << 18)
    rows = [(i, "abcd"[min(3, i % 7)]) for i in range(900)] + [(i, None) for i in range(50)] + [(5, "a"), (5, "a"), (None, "b")]
    weights = {"a": 0.5, "b": 0.3, "c": 0.15}
    got = run(spark, rows, weights=weights, block_rows=3)
    check(rows, got, 3)
    # None and d are not named, so they get one slot in 1024 each; the others share the rest
    rest = 1 - 2 / 1024
    share = {None: 1 / 1024, **{s: w / 0.95 * rest for s, w in weights.items()}, "d": 1 / 1024}
    count = Counter(s for _, s in rows)
    slots = edf(list(share.values()), [-(-count[s] // 3) for s in share])
    assert all(r["slot"] == slots[list(share).index(r["source"]), r["block"]] for r in got)


def test_blocks_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_SLOTS", 50)
    rows = [(i, f"s{i % 3 if i % 2 else 0}") for i in range(2000)]
    got = run(spark, rows, block_rows=2)
    count = Counter(s for _, s in rows)
    every = sum(n**0.5 for n in count.values())
    size = ceil(max(n / (n**0.5 / every) for n in count.values()) / 50)
    assert size > 40 and max(r["slot"] for r in got) <= 100
    check(rows, got, size)


def test_lightest_of_many_sources_share_a_weight(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_SOURCES", 4)
    rows = [(i, f"s{i % 40 if i % 2 else i % 4}") for i in range(1200)]
    got = run(spark, rows, block_rows=2)
    assert Counter(rows) == Counter((r["doc_id"], r["source"]) for r in got)
    assert len({r["position"] for r in got}) == len(got)
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in got)


def test_every_source_of_many_has_its_own_weight(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_SOURCES", 4)
    rows = [(i, f"s{i % 40:02}" if i % 2 else f"s{i % 4:02}") for i in range(1200)] + [(i, None) for i in range(3)]
    got = run(spark, rows, block_rows=2)
    check(rows, got, 2)
    count = sorted(Counter(s for _, s in rows).items(), key=lambda x: x[0] or "")
    every = sum(n**0.5 for _, n in count)
    slots = edf([n**0.5 / every for _, n in count], [-(-n // 2) for _, n in count])
    place = {s: i for i, (s, _) in enumerate(count)}
    assert all(r["slot"] == slots[place[r["source"]], r["block"]] for r in got)


@pytest.mark.parametrize("most", [1 << 17, 150])
def test_spread_schedule_against_brute_force(spark, monkeypatch, most):
    """Also with empty slots, equal weights, and blocks and slots in many ranges."""
    monkeypatch.setattr(mixing, "SPREAD_ROWS", most)
    rng = np.random.default_rng(3)
    for count, alpha, blocks in ((60, 0.3, 12), (90, 10.0, 5), (1, 1.0, 9), (7, None, 40), (120, None, 2)):
        w = np.full(count, 1 / count) if alpha is None else np.maximum(rng.dirichlet(np.full(count, alpha)), 1e-3)
        w = w / w.sum()
        lanes = [(f"s{i:03}" if i else None, float(x), int(n)) for i, (x, n) in enumerate(zip(w, rng.integers(1, blocks + 1, count)))]
        made = mixing.schedule_spread(spark.createDataFrame(lanes, "lane string, share double, blocks long")).collect()
        slots = edf(w, [n for *_, n in lanes])
        assert {(int((r["lane"] or "s0")[1:]), r["block"]): r["slot"] for r in made} == slots and len(made) == len(slots)


@pytest.mark.parametrize("weights", [None, {}, {"x": 0.0}])
def test_odd_tables(spark, weights):
    assert run(spark, [], weights=weights) == []
    check([(1, None)], run(spark, [(1, None)], weights=weights), mixing.BLOCK_ROWS)
    many = [(i, f"s{i}") for i in range(300)]
    check(many, run(spark, many, weights=weights), mixing.BLOCK_ROWS)


def test_carried_rows_and_plan(spark):
    docs = spark.createDataFrame([(1, "a", "slot"), (2, "b", None)], "doc_id long, source string, slot string")
    mixed = mixing.mix(docs, carry=True)
    assert sorted(map(tuple, mixed.select("row.*").collect()), key=str) == [(1, "a", "slot"), (2, "b", None)]
    assert "Python" not in mixed._jdf.queryExecution().toString()


def test_rows_of_equal_id_have_an_order(spark):
    rows = [(1, "a", f"t{i}") for i in range(40)] + [(None, "a", f"u{i}") for i in range(40)] + [(i, "b", "x") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    places = []
    for parts in (1, 7):
        mixed = mixing.mix(docs.repartition(parts, "text"), carry=True, block_rows=2)
        places.append(sorted((r["position"], r["row"]["text"]) for r in mixed.collect()))
    assert places[0] == places[1]


def test_weights_and_sources_without_one(spark):
    counts = spark.createDataFrame([("a", 100), ("b", 400), (None, 25)], "source string, n long")

    def share(weights):
        return {r["source"]: r["share"] for r in mixing.shares(counts, weights, 0.5).collect()}

    assert share(None) == {"a": 10 / 35, "b": 20 / 35, None: 5 / 35}
    assert share({"a": 3, "b": 1}) == {"a": 0.75 * (1 - 1 / 1024), "b": 0.25 * (1 - 1 / 1024), None: 1 / 1024}
