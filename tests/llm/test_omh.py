import hashlib

import numpy as np
import pytest

from rowtide.llm import omh


def brute_sketch(text, sketcher):
    """The same by the definition: numbered k-mers, smallest hashes, text order, tuple hash."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if not len(points):
        return np.zeros(sketcher.functions, np.uint32)
    mask = ~np.uint64((1 << 20) - 1)
    size = min(sketcher.kmer, len(points))
    hashes = [int(sketcher._kmers(points[i : i + size])[0] & mask) for i in range(len(points) - size + 1)]
    seen, numbered = {}, []
    for h in hashes:
        numbered.append(int(omh._mix(np.array([h], np.uint64) ^ np.array([seen.get(h, 0)], np.uint64) * omh._BASE)[0]))
        seen[h] = seen.get(h, 0) + 1
    out = []
    for factor in sketcher._factors[:, 0].tolist():
        best = sorted(range(len(hashes)), key=lambda i: numbered[i] * factor % (1 << 64))[: sketcher.picked]
        entry = np.array([len(best)], np.uint64)
        for i in sorted(best):
            entry = omh._mix(entry * omh._BASE + np.array([hashes[i]], np.uint64))
        out.append(int(entry[0]) >> 32)
    return np.array(out, np.uint32)


@pytest.mark.parametrize("sizes", [{}, {"kmer": 3, "picked": 3, "functions": 7}, {"kmer": 5, "picked": 1, "functions": 4}])
def test_sketch_against_definition(sizes):
    rng, sketcher = np.random.default_rng(5), omh.Sketcher(**sizes)
    for length in (0, 1, 2, 4, 8, 9, 30, 200, 700):
        text = "".join(rng.choice(list("abé😀 "), length))
        assert (sketcher.sketch(text) == brute_sketch(text, sketcher)).all()


def test_long_text_has_the_same_sketch_in_parts(monkeypatch):
    text = "".join(np.random.default_rng(6).choice(list("abcdefghij "), 5000))
    whole = omh.Sketcher().sketch(text)
    monkeypatch.setattr(omh, "COLUMNS", 97)
    assert (omh.Sketcher().sketch(text) == whole).all()
    monkeypatch.setattr(omh, "NARROWED", 0)
    assert (omh.Sketcher(picked=2)._smallest(np.arange(9, dtype=np.uint64), 2) == np.argsort(
        np.arange(9, dtype=np.uint64) * omh.Sketcher()._factors, axis=1)[:, :2]).all()


def test_order_matters():
    rng = np.random.default_rng(7)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), 6)) for _ in range(400)]
    sketcher = omh.Sketcher(functions=256)
    text, moved = " ".join(words), " ".join(words[200:] + words[:200])
    assert omh.likeness(sketcher.sketch(text), sketcher.sketch(moved)) < 0.75
    near = " ".join(words[:100] + ["changed"] + words[101:])
    assert omh.likeness(sketcher.sketch(text), sketcher.sketch(near)) > 0.85


def brute(rows):
    sketcher = omh.Sketcher()
    named = sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], tie(r[1])))
    pairs = list(zip(named, named[1:] + named[:1])) + [(r, (named or [r])[0]) for r in rows if r[0] is None]
    out = []
    for (doc, text), (_, following) in pairs:
        text, following = text or "", following or ""
        tail = len(text) // 4
        edited = text[: len(text) - tail] + following[:tail]
        a, b, c = map(sketcher.sketch, (text, edited, following))
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), omh.as_text(a), omh.as_text(b),
                    omh.likeness(a, b), omh.likeness(a, c)))
    return sorted(out, key=str)


def tie(text):
    return omh.xxhash.xxh64_intdigest((text or "").encode())


def run(spark, rows):
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, bucket int, n_chars string")
    return sorted(map(tuple, omh.compare_with_next(docs).collect()), key=str)


@pytest.mark.parametrize("count", [0, 1, 2, 200])
def test_next_against_brute_force(spark, count):
    rng = np.random.default_rng(8)
    texts = ["".join(rng.choice(list("abcé \n"), rng.integers(0, 90))) for _ in range(count)]
    rows = [(int(i) * 3 - 50, t) for i, t in zip(rng.permutation(count), texts)]
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, "no id at all"), (None, None), (4, None), (4, "same id"), (4, "same id"), (9, "ab" * 100_000), (5, "")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:2]) == brute(rows[:2])


def test_fingerprints(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None), (None, "some text")], "doc_id long, text string")
    got = {r[0]: (r[1], r[2]) for r in omh.fingerprints(docs).collect()}
    assert got[1] == got[None] == (9, omh.as_text(omh.Sketcher().sketch("some text"))) and got[2][0] == 0
