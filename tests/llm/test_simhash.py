import re

import numpy as np
import pytest
import xxhash

from rowtide.llm import simhash
from rowtide.llm.components import components

TEXT = "The quick brown fox jumps over the lazy dog and runs far away from here today my friend"


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if bin(fps[i] ^ fps[j]).count("1") <= 2 and root[j] < root[i]:
                    root[i], changed = root[j], True
    ids = {}
    for (doc, _), r in zip(rows, root):
        ids[r] = doc if ids.get(r) is None else ids[r] if doc is None else min(ids[r], doc)
    return sorted(((d, f"{f:016x}", ids[r]) for (d, _), f, r in zip(rows, fps, root)), key=str)


def run(spark, rows):
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, fp int, component_id string")
    return sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str)


def test_against_brute_force(spark):
    rng = np.random.default_rng(1)
    words = TEXT.split()
    rows = [(i, " ".join(rng.choice(words, 40))) for i in range(30)]
    rows += [(100 + i, (TEXT + " ") * 20 + " ".join(rng.choice(words, 2))) for i in range(20)]
    rows += [(7, rows[7][1]), (None, rows[3][1]), (200, None), (201, ""), (202, " \t"), (203, "one"), (204, "ONE\x0b"),
             (205, "one two É"), (None, "two words")]
    assert run(spark, rows) == brute(rows)


def test_crowded_key_gives_the_same_components(spark, monkeypatch):
    rng = np.random.default_rng(2)
    base = int(rng.integers(1 << 62))
    fps = {base}
    for _ in range(60):
        near = list(fps)[rng.integers(len(fps))]
        fps.add(near ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))))
    fps |= {int(x) for x in rng.integers(1 << 62, size=30)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = sorted(map(tuple, components(simhash.links(frame)).collect()))
    monkeypatch.setattr(simhash, "GROUP", 2)
    assert sorted(map(tuple, components(simhash.links(frame)).collect())) == want
    root = {f: f for f in signed}
    for _ in signed:
        for a in signed:
            close = (root[b] for b in signed if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2)
            root[a] = min(root[a], *close)
    assert want == sorted((v, r) for v, r in root.items() if v != r)


def test_chain_of_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (5, 5)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {**{i: 0 for i in range(1, 41)}, 101: 100}


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("distance", [0, 1])
def test_smaller_distances(spark, distance):
    frame = spark.createDataFrame([(0,), (1,), (3,), (1 << 40,)], "fp long")
    found = dict(map(tuple, components(simhash.links(frame, distance)).collect()))
    assert found == ({} if distance == 0 else {1: 0, 3: 0, 1 << 40: 0})


@pytest.mark.parametrize("group", [256, 1])
def test_one_bit_links_of_crowded_keys(spark, monkeypatch, group):
    monkeypatch.setattr(simhash, "GROUP", group)
    rng = np.random.default_rng(5)
    fps = {56, 57, 25, 40} | {int(x) for x in rng.integers(1 << 62, size=5)}
    fps |= {f ^ (1 << int(b)) for f in list(fps) for b in rng.integers(0, 63, 4)}
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    found = dict(map(tuple, components(simhash.links(frame, 1)).collect()))
    root = {f: f for f in fps}
    for _ in fps:
        root = {a: min(root[b] for b in fps if (a ^ b).bit_count() <= 1) for a in fps}
    assert found == {a: r for a, r in root.items() if a != r} and found[57] == found[56] == found[40] == 25


def test_rows_that_share_an_id_are_judged_by_their_texts(spark):
    rng = np.random.default_rng(6)
    one, two, three = (" ".join(f"w{n}" for n in rng.integers(0, 5000, 60)) for _ in range(3))
    rows = [(1, one), (1, two), (1, two), (2, two), (3, three), (3, one), (None, three), (None, three), (4, None), (5, "")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string")
    kept = sorted(((r["doc_id"], r["text"]) for r in simhash.representatives(docs).collect()), key=str)
    assert kept == sorted([(1, one), (1, two), (3, three), (None, three), (None, three), (4, None)], key=str)
    assert simhash.representatives(docs).columns == docs.columns
    assert simhash.representatives(docs.limit(0)).count() == 0
