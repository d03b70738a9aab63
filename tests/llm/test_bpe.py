import hashlib
import random
import sys

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from rowtide.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def odd_text(rng, length):
    parts = ["a", "é", "'re", "'s", " ", "  ", "\n\n", "\t", "12", "!?", "語", " ", "　", "😀", "x" * 9, "'"]
    out = []
    while sum(map(len, out)) < length:
        out.append(rng.choice(parts))
    return "".join(out)


def expected(reference, doc, text):
    ids = reference.encode_ordinary(text or "")
    packed = np.array(ids, "<u4").tobytes()
    return doc, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_against_the_library(spark, reference):
    rng = random.Random(3)
    texts = [None, "", " ", "hello  world", "it's'", "x" * 300, " " * 200, "ab " * 90 + "'", "\n" * 65, "'r" * 40]
    texts += [odd_text(rng, rng.randrange(1, 400)) for _ in range(60)]
    rows = [(i % 7 or None, t, "en", 5) for i, t in enumerate(texts)] + [(1, "hello  world", "en", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, row int")
    got = bpe.digests(docs, RANKS, PATTERN, chunk=64, overlap=20).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(expected(reference, d, t)) for d, t, _, _ in rows)


def test_stitching_equals_one_pass():
    rng = random.Random(4)
    find = regex.compile(PATTERN).findall
    for _ in range(400):
        text = odd_text(rng, rng.randrange(70, 500))
        chunks = [(s, text[s : s + 64], bpe.boundaries(find, text[s : s + 64], s)) for s in bpe.chunk_starts(len(text), 64, 20)]
        pieces = [t[a:b] for _, t, e in bpe.stitch(chunks, find) for a, b in zip([0, *e[:-1]], e)]
        assert pieces == find(text)


@pytest.mark.parametrize("pattern", [r"\s*[\r\n]+|\s+(?!\S)|\s+|[^\s]+", PATTERN])
@pytest.mark.parametrize("middle", ["\n" + " " * 2500 + "\n", " " * 700 + "\n\n" + "\t" * 900, "\r\n" * 600, "x" * 1500])
def test_runs_over_a_cut(pattern, middle):
    find = regex.compile(pattern).findall
    for before in range(0, 130, 7):
        text = "w" * 3 + " ab" * before + middle + "cd ef" * 40
        chunks = [(s, text[s : s + 400], bpe.boundaries(find, text[s : s + 400], s)) for s in bpe.chunk_starts(len(text), 400, 100)]
        pieces = [t[a:b] for _, t, e in bpe.stitch(chunks, find) for a, b in zip([0, *e[:-1]], e)]
        assert pieces == find(text)


def test_pattern_cuts_every_character_as_the_library_does(reference):
    find, pieces = regex.compile(PATTERN).findall, bpe._Pieces(bpe.read_ranks(RANKS))
    for c in map(chr, range(sys.maxunicode + 1)):
        if 0xD800 <= ord(c) <= 0xDFFF or not (c.isspace() or 0x1C <= ord(c) <= 0x1F or ord(c) in (0x85, 0x180E, 0x200B)):
            continue
        text = f"a{c}{c}b {c}1"
        ids = [i for piece in find(text) for i in pieces._merge(piece)]
        assert ids == reference.encode_ordinary(text), hex(ord(c))


def test_empty_table(spark):
    assert bpe.digests(spark.createDataFrame([], "doc_id long, text string"), RANKS, PATTERN).collect() == []
