import re

import numpy as np
import pytest

from rowtide.llm import substring


def brute(rows, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    least = {}
    for (doc, _), w in zip(rows, words):
        if doc is not None:
            for i in range(len(w) - window + 1):
                key = tuple(w[i : i + window])
                least[key] = min(doc, least.get(key, doc))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if doc is not None and least[tuple(w[i : i + window])] < doc:
                gone |= set(range(i, i + window))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def run(spark, rows, window):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, kept string, id int")
    found = substring.remove_duplicates(docs, window=window).collect()
    texts = {}
    for doc, text in rows:
        texts.setdefault(doc, []).append(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    for row in found:
        assert sum(s["end"] - s["start"] for s in row["spans"]) == row["n_removed"]
        removed = {i for s in row["spans"] for i in range(s["start"], s["end"])}
        free = 0
        for f in row["factors"]:
            # factors stand one after another, each whole in one earlier document, and their words are removed
            assert f["start"] >= free and f["length"] >= 1 and f["source"] < row["doc_id"]
            free = f["start"] + f["length"]
            assert removed.issuperset(range(f["start"], free))
            if len(texts[row["doc_id"]]) == 1:
                words = texts[row["doc_id"]][0][f["start"] : free]
                assert words in [t[f["place"] : f["place"] + f["length"]] for t in texts[f["source"]]]
        assert bool(row["factors"]) == bool(removed)
    return sorted((tuple(r)[:4] for r in found), key=str)


def test_parse():
    """Five-word blocks: two neighbouring sources, a block across their boundary, a jump inside one source."""
    starts = np.array([2, 3, 4, 5, 6, 9, 20, 21, 22])
    source = np.array([1, 1, 1, 7, 7, 7, 3, 3, 3])
    place = np.array([10, 11, 12, 0, 1, 4, 50, 51, 80])
    assert substring.parse(starts, source, place, 5) == [(2, 7, 1, 10), (9, 5, 7, 4), (20, 6, 3, 50)]
    assert substring.parse(starts[:0], source[:0], place[:0], 5) == []


def test_neighbouring_blocks_of_different_sources(spark):
    """a..h stands in no document as a whole: its factors come from two, and a block over both from a third."""
    rows = [(1, "a b c d e"), (2, "x e f g h i"), (3, "c d e f g"), (9, "a b c d e f g h i z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    (row,) = substring.remove_duplicates(docs, window=5).filter("doc_id = 9").collect()
    assert [tuple(f) for f in row["factors"]] == [(0, 5, 1, 0)]
    assert [tuple(s) for s in row["spans"]] == [(0, 9)] and row["kept"] == "z"
    # with longer documents the second factor begins where the first ends
    more = [*rows[:2], (9, "a b c d e x e f g h i q")]
    (row,) = substring.remove_duplicates(spark.createDataFrame(more, "doc_id long, text string"), window=5).filter("doc_id = 9").collect()
    assert [tuple(f) for f in row["factors"]] == [(0, 5, 1, 0), (5, 6, 2, 0)] and row["kept"] == "q"


def test_rows_without_id_are_spread(spark):
    texts = [f"text number {n} of many that have no id" for n in range(300)]
    docs = spark.createDataFrame([(None, t) for t in texts] + [(1, "a")], "doc_id long, text string")
    packed = docs.select("doc_id", docs["text"].cast("binary")).mapInArrow(substring._pack_texts(64), "grp int, id long, text binary")
    sizes = [r["count"] for r in packed.groupBy("grp").count().collect()]
    assert len(sizes) > 50 and max(sizes) < 20


@pytest.mark.parametrize("portion", [substring.PORTION, 20])
def test_against_brute_force(spark, monkeypatch, portion):
    monkeypatch.setattr(substring, "PORTION", portion)
    rng = np.random.default_rng(7)
    passages = [" ".join(rng.choice(list("abcdefgh"), 12)) for _ in range(4)]
    rows = []
    for doc in rng.permutation(60).tolist():
        parts = [str(rng.choice(passages)) if rng.random() < 0.4 else f"é{rng.integers(99)}" for _ in range(9)]
        rows.append((doc - 5, "\t \x0b".join(parts)))
    rows += [rows[3], (rows[4][0], rows[9][1]), (None, rows[5][1]), (None, passages[0]), (70, None), (71, ""), (72, " \n"),
             (73, "too short"), (1 << 62, passages[1]), (74, f"x y {passages[2]} z")]
    assert run(spark, rows, 5) == brute(rows, 5)


def test_words_over_segments(monkeypatch):
    text = b" ".join(b"w%d" % (i % 97) + b"x" * (i % 40) for i in range(3000)) + b"y" * 500 + b" z"
    plain, _ = substring.Hasher(5).words([text, b"", b"a b"])
    monkeypatch.setattr(substring, "SEGMENT", 100)
    cut, first = substring.Hasher(5).words([text, b"", b"a b"])
    assert (plain == cut).all() and first.tolist() == [0, 3001, 3001, 3003]
    assert len(plain) == 3003


def test_empty_table(spark):
    assert run(spark, [], 5) == []


def test_long_text(spark):
    words = " ".join(str(i) for i in range(150_000))
    got = run(spark, [(2, words), (1, "0 " + words)], 13)
    assert [(r[0], r[1], r[2]) for r in got] == [(1, 150_001, 0), (2, 150_000, 150_000)]
