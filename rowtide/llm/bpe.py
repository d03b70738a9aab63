"""Byte-level BPE over overlapping chunks, and back.

A text is cut into pre-tokens by a pattern and the bytes of every pre-token are merged by rank. Texts of up to
``chunk`` code points are one chunk. A longer text becomes overlapping chunks, which are pre-tokenised in parallel. Where
two neighbours share a boundary inside their overlap they have resynchronised: a match of the pattern depends only on
what follows its start, so from there on both agree, and the chunks are stitched at that place. Boundaries within
``MARGIN`` code points of a chunk's cut end, or in a run of white space that reaches there, are not trusted, because a
match there might have gone on. This holds for patterns whose matches see no further than the end of the run of letters,
digits, signs or white space they are in and ``MARGIN`` code points beyond; a match may not depend on what is before it.
If an overlap holds no common boundary (one endless word), the text is pre-tokenised again from the last trusted boundary.
The stitched pieces of a text are then encoded. Chunks and the lengths of their pre-tokens travel compressed.

Null texts are empty; an empty text has no ids. Invalid surrogates cannot occur in Spark strings. Ids are kept packed, as
little-endian unsigned 32-bit numbers, so that every id of a vocabulary fits and no array of objects is built.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.llm.common import ddl, small_batches, tidy

CHUNK, OVERLAP, MARGIN = 65536, 1024, 8
# Pre-tokens whose ids a task remembers, and the longest of them.
REMEMBERED, REMEMBERED_CHARS = 400_000, 64


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of a token's bytes and its rank, one token per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


class _Pieces(dict):
    """Pre-token to packed ids; the merges themselves are the tokenizer library's."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        whole = r"(?s:.+)"  # a pre-token is merged as it is, never cut again
        self._merge = tiktoken.Encoding("pieces", pat_str=whole, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __missing__(self, piece: str) -> bytes:
        packed = np.array(self._merge(piece), "<u4").tobytes()
        if len(piece) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = packed
        return packed

    @classmethod
    def of_task(cls, ranks) -> _Pieces:
        """One for all groups of a task: kept with the broadcast value, which lives as long as the task."""
        if not hasattr(ranks, "pieces"):
            ranks.pieces = cls(ranks.value)
        return ranks.pieces

    def encode(self, pieces: list[str]) -> bytes:
        return b"".join(map(self.__getitem__, pieces))


def _press(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _open(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _binary(values) -> pa.Array:
    return pa.array(values, pa.binary())


def chunk_starts(length: int, chunk: int, overlap: int) -> list[int]:
    """Where the chunks of a text begin; the last one reaches its end."""
    step = chunk - overlap
    return list(range(0, max(1, length - overlap), step))


def boundaries(find, text: str, start: int = 0) -> np.ndarray:
    """Where the pre-tokens of ``text`` end, the text beginning at ``start``."""
    return np.fromiter(accumulate(map(len, find(text))), np.int64) + start


def _settled(text: str) -> int:
    """Up to where what follows a text cannot move its pre-tokens: before its last ``MARGIN`` code points, and before the
    run of white space there, of which a pattern may want to see the end."""
    place = max(0, len(text) - MARGIN)
    while place and text[place - 1].isspace():
        place -= 1
    return place


def stitch(chunks: list[tuple[int, str, np.ndarray]], find) -> list[tuple[int, int, np.ndarray]]:
    """``(chunk, start, ends)`` per chunk: the pre-tokens of the whole text, each in one chunk.

    ``chunks`` are (start, text, ends of pre-tokens), neighbours overlapping.
    """
    out, begin = [], 0
    start, text, ends = chunks[0]
    for number in range(1, len(chunks)):
        next_start, next_text, next_ends = chunks[number]
        last = _settled(text) + start
        trusted = ends[(ends >= max(begin, next_start)) & (ends <= last)]
        common = np.intersect1d(trusted, next_ends, assume_unique=True)
        if len(common):
            cut = int(common[0])
        else:
            before = ends[(ends > begin) & (ends <= last)]
            cut = int(before[-1]) if len(before) else begin
            overlap = start + len(text) - next_start
            next_start, next_text = cut, text[cut - start :] + next_text[overlap:]
            next_ends = boundaries(find, next_text, cut)
        out.append((start, text, begin, ends[(ends > begin) & (ends <= cut)]))
        start, text, ends, begin = next_start, next_text, next_ends, cut
    out.append((start, text, begin, ends[ends > begin]))
    return [(number, text[begin - start : (e[-1] if len(e) else begin) - start], e - begin)
            for number, (start, text, begin, e) in enumerate(out)]


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``<id_col>, ids`` for every row: the ids of its text without special tokens, packed.

    ``ranks_path`` is read on the driver and sent to the executors; its size is that of the vocabulary. Null ids and
    repeated rows are kept, each row on its own. Other columns are not looked at. An empty table gives no rows.
    """
    if not MARGIN < overlap < chunk // 2:
        raise ValueError("the overlap must exceed the margin and be less than half a chunk")
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = small_batches(docs).select(docs[id_col].alias("id"), text.alias("text"))
    kind = ddl(rows, "id")
    short = rows.filter(F.length("text") <= chunk).mapInArrow(tidy(_encode_rows(ranks, pattern)), f"id {kind}, ids binary")
    numbered = rows.filter(F.length("text") > chunk).withColumn("row", F.monotonically_increasing_id())
    cut = numbered.mapInArrow(_cut(chunk, overlap), f"id {kind}, row long, start long, text binary")
    scattered = cut.repartition("row", "start")
    found = scattered.mapInArrow(_pretokenise(pattern), f"id {kind}, row long, start long, text binary, lengths binary")
    long = found.groupBy("row").applyInArrow(_encode_stitched(ranks, pattern), f"id {kind}, ids binary")
    return short.unionByName(long).select(F.col("id").alias(id_col), "ids")


def _encode_rows(ranks, pattern):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, find = _Pieces(ranks.value), regex.compile(pattern).findall
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = [pieces.encode(find(text)) for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), _binary(ids)], ["id", "ids"])

    return run


def _cut(chunk, overlap):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                text = one.column("text")[0].as_py()
                starts = chunk_starts(len(text), chunk, overlap)
                same = pa.array([0] * len(starts))
                yield pa.RecordBatch.from_arrays(
                    [one.column("id").take(same), one.column("row").take(same), pa.array(starts, pa.int64()),
                     _binary([_press(text[s : s + chunk].encode()) for s in starts])],
                    ["id", "row", "start", "text"],
                )

    return run


def _pretokenise(pattern):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        for batch in batches:
            lengths = []
            for text in batch.column("text").to_pylist():
                found = find(_open(text).decode())
                lengths.append(_press(np.fromiter(map(len, found), np.uint32, len(found)).tobytes()))
            yield pa.RecordBatch.from_arrays([*batch.columns, _binary(lengths)], [*batch.schema.names, "lengths"])

    return run


def _encode_stitched(ranks, pattern):
    """The chunks of one text."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("start")
        chunks = []
        for start, text, lengths in zip(*(group.column(c).to_pylist() for c in ("start", "text", "lengths"))):
            ends = np.cumsum(np.frombuffer(_open(lengths), np.uint32), dtype=np.int64) + start
            chunks.append((start, _open(text).decode(), ends))
        pieces, ids = _Pieces.of_task(ranks), []
        for _, text, ends in stitch(chunks, regex.compile(pattern).findall):
            ends = ends.tolist()
            ids.append(pieces.encode([text[a:b] for a, b in zip([0, *ends], ends)]))
        return pa.table({"id": group.column("id").slice(0, 1), "ids": _binary([b"".join(ids)])})

    return run


def decode(tokens: DataFrame, ranks_path: str, ids_col: str = "ids", name: str = "bytes") -> DataFrame:
    """Adds the bytes that the packed ids of a row stand for, joined in order. Null ids stay null; an id that is not in
    the vocabulary fails the job."""
    spark = tokens.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    at, columns = tokens.columns.index(ids_col), [*tokens.columns, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: token for token, rank in ranks.value.items()}.__getitem__
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                packed = part.column(at).to_pylist()
                out = [None if p is None else b"".join(map(token, np.frombuffer(p, "<u4").tolist())) for p in packed]
                yield pa.RecordBatch.from_arrays([*part.columns, _binary(out)], columns)

    return tokens.mapInArrow(tidy(run), T.StructType([*tokens.schema.fields, T.StructField(name, T.BinaryType())]))


def digests(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    ids: bool = False,
    **cut: int,
) -> DataFrame:
    """``<id_col>, n_tokens, ids_sha256, decoded_sha256``: a text encoded, and the ids decoded again. With ``ids`` the
    packed ids as well."""
    both = decode(encode(docs, ranks_path, pattern, id_col, text_col, **cut), ranks_path)
    return both.select(
        id_col,
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
        *["ids"] * ids,
    )
