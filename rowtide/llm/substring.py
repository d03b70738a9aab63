"""Duplicate passages by relative Lempel-Ziv parsing against the blocks of all documents with a smaller id.

The reference of a document is every block of ``window`` words of the documents before it, all indexed by hash: block
hashes are dealt to index buckets, and a bucket knows for each block the smallest document that has it and where. A
document is parsed from its front: where a block of the reference begins, a factor begins, and it goes on as long as the
next block is the next one of the same source; what no block covers are literal words. Factors are runs that stand in one
source document, of ``window`` words at least, and become duplicate spans. The blocks across the place where two factors
meet, or a factor and literal words, are looked up as well, so that a passage cut by the boundary is found too.

What moves is packed: a task sends per bucket one row of block hashes (the bits the bucket implies are left out),
document ids as differences, and word numbers, split into byte planes that compress well. A block that is repeated inside
the texts a task handles at a time goes out once, for its smallest document, so a passage that a third of all documents
share reaches its bucket once per such portion. Sources travel as differences too, which are zero along a factor.
Documents meet their blocks by a hash of their id (those without id are dealt by their text); texts travel compressed.
Windows are compared by 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import carried_row, ddl, id_and_text, release_memory, tidy

WINDOW = 13
# Words sent on together by a task, bytes hashed at a time.
PORTION, SEGMENT = 300_000, 500_000
# Sizes for a bucket of the index and for a group of documents, in bytes of text.
BUCKET_BYTES, GROUP_BYTES = 4_000_000, 4_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Odd multipliers and a value per byte; any fixed ones do.
_P, _Q = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_BYTE = np.random.default_rng(5).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    if count:
        out[0] = 1
    return np.multiply.accumulate(out)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Hashes of words and of windows of words, from differences of prefix sums."""

    def __init__(self, window: int):
        self.window = window
        self._bytes = self._words = None

    def _tables(self, size: int, base: int, kept):
        if kept is None or len(kept[0]) < size:
            kept = _powers(base, size), _powers(pow(base, -1, 1 << 64), size)
        return kept

    def _segment(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where words start in the segment, and their hashes."""
        space = _SPACE[data]
        edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
        start, end = edge[::2], edge[1::2]
        self._bytes = up, down = self._tables(len(data) + 1, _P, self._bytes)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
        return start, _mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all words, and where each text's words begin among them (and the end)."""
        joined = b"\n".join([*texts, b""])
        starts, hashes, at = [], [], 0
        while at < len(joined):
            end = min(at + SEGMENT, len(joined))
            while end < len(joined) and not _SPACE[joined[end - 1]]:  # never inside a word
                found = [p for p in (joined.find(bytes([s]), end, end + SEGMENT) for s in np.flatnonzero(_SPACE)) if p >= 0]
                end = min(found) + 1 if found else min(end + SEGMENT, len(joined))
            s, h = self._segment(np.frombuffer(joined, np.uint8, end - at, at))
            starts.append(s + at), hashes.append(h)
            at = end
        offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
        if not starts:
            return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
        return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)

    def windows(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hash of every window inside one text, and the number of its first word among all words."""
        counts = np.maximum(np.diff(first) - self.window + 1, 0)
        at = np.arange(counts.sum()) + np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
        self._words = up, down = self._tables(len(words) + 1, _Q, self._words)
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * up[: len(words)], out=sums[1:])
        return _mix((sums[at + self.window] - sums[at]) * down[at]), at


def _planes(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1)[:, :width].T.tobytes()


def _from_planes(data: bytes, count: int, dtype) -> np.ndarray:
    out = np.zeros((count, np.dtype(dtype).itemsize), np.uint8)
    width = len(data) // count if count else 0
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, count).T
    return out.reshape(-1).view(dtype)


def _pack(ids: np.ndarray, at: np.ndarray) -> tuple[bytes, bytes]:
    """Ids as differences, and word numbers; both in the given order."""
    return _planes(np.diff(ids.view(np.uint64), prepend=np.uint64(0)), 8), _planes(at.astype(np.uint32), 4)


def _unpack(ids: bytes, at: bytes) -> tuple[np.ndarray, np.ndarray]:
    count = len(at) // 4
    return np.cumsum(_from_planes(ids, count, np.uint64), dtype=np.uint64).view(np.int64), _from_planes(at, count, np.uint32)


def _group_of(ids: np.ndarray, groups: int) -> np.ndarray:
    return (_mix(ids.view(np.uint64)) % np.uint64(groups)).astype(np.int32)


_SENT = "bucket int, hashes binary, ids binary, at binary, src binary, gap binary"
_REMOVED = "grp int, ids binary, at binary, src binary, gap binary, checks binary"
_FACTORS = "array<struct<start: int, length: int, source: bigint, place: bigint>>"


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int32(), *[pa.binary()] * (len(names) - 1)]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _differences(values: np.ndarray) -> bytes:
    return _planes(np.diff(values.astype(np.int64).view(np.uint64), prepend=np.uint64(0)), 8)


def _sums(data: bytes, count: int) -> np.ndarray:
    return np.cumsum(_from_planes(data, count, np.uint64), dtype=np.uint64).view(np.int64)


def _removed_rows(
    ids: np.ndarray, at: np.ndarray, source: np.ndarray, place: np.ndarray, hashes: np.ndarray, groups: int
) -> Iterator[tuple]:
    """Blocks by group of documents, each with the document that has it before and its place there, and a few bits of its
    hash to tell rows that repeat an id."""
    group = _group_of(ids, groups)
    order = np.lexsort((at, ids, group))
    ids, at, group, checks = ids[order], at[order], group[order], hashes[order].astype(np.uint16)
    source, gap = source[order], place[order].astype(np.int64) - at
    cut = np.flatnonzero(np.diff(group, prepend=-1, append=-1))
    for a, b in zip(cut[:-1], cut[1:]):
        yield (int(group[a]), *_pack(ids[a:b], at[a:b]), _differences(source[a:b]), _differences(gap[a:b]), checks[a:b].tobytes())


def _send(window: int, bits: int, groups: int):
    """From documents to packed windows per bucket. Rows with a negative bucket are blocks whose source is known already."""
    width = (64 - bits + 7) // 8

    def portion(hasher: Hasher, ids: list, texts: list[bytes]) -> list[tuple]:
        ids = np.array(ids, np.int64)
        order = np.argsort(ids, kind="stable")
        ids, texts = ids[order], [texts[i] for i in order]
        words, first = hasher.words(texts)
        hashes, at = hasher.windows(words, first)
        doc = np.searchsorted(first, at, side="right") - 1
        at = at - first[doc]
        # windows run by id, so the first of equal hashes has the smallest id
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        opens = np.flatnonzero(np.diff(hashes, prepend=~hashes[:1]) != 0)
        first_of = np.repeat(order[opens], np.diff(opens, append=len(hashes)))
        is_lost = ids[doc[order]] > ids[doc[first_of]]
        lost, source = order[is_lost], first_of[is_lost]
        rows = []
        for grp, i, a, src, gap, checks in _removed_rows(
            ids[doc[lost]], at[lost], ids[doc[source]], at[source], hashes[is_lost], groups
        ):
            rows.append((-1 - grp, checks, i, a, src, gap))
        keep, kept = order[opens], hashes[opens]
        bucket = (kept >> np.uint64(64 - bits)).astype(np.int64)
        cut = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
        for a, b in zip(cut[:-1], cut[1:]):
            place = np.argsort(keep[a:b])
            taken = keep[a:b][place]
            rows.append((int(bucket[a]), _planes(kept[a:b][place], width), *_pack(ids[doc[taken]], at[taken]), None, None))
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(window)
        names = ["bucket", "hashes", "ids", "at", "src", "gap"]
        ids, texts, size = [], [], 0
        for batch in batches:
            for i, t in zip(batch.column(0), batch.column(1)):
                text = t.as_py()
                if text and i.is_valid:
                    ids.append(i.as_py()), texts.append(text)
                    size += len(text)
                if size > 6 * PORTION:
                    if rows := portion(hasher, ids, texts):
                        yield _rows(rows, names)
                    ids, texts, rows, size = [], [], [], 0
        if texts and (rows := portion(hasher, ids, texts)):
            yield _rows(rows, names)

    return run


def _look_up(bits: int, groups: int):
    """Per bucket (rows come sorted by it): windows that a smaller document has, with the smallest one and the place."""

    def losers(bucket: int, parts: list[tuple]) -> Iterator[tuple]:
        if bucket < 0:
            yield from ((-1 - bucket, ids, at, src, gap, checks) for checks, ids, at, src, gap in parts)
            return
        unpacked = [_unpack(ids, at) for _, ids, at, *_ in parts]
        hashes = np.concatenate([_from_planes(h, len(a), np.uint64) for (h, *_), (_, a) in zip(parts, unpacked)])
        ids, at = (np.concatenate(c) for c in zip(*unpacked))
        order = np.argsort(hashes)
        hashes = hashes[order]
        opens = np.flatnonzero(np.diff(hashes, prepend=~hashes[:1]) != 0)
        times = np.diff(opens, append=len(hashes))
        ids, at = ids[order], at[order]
        least = np.repeat(np.minimum.reduceat(ids, opens), times)
        is_lost = ids > least
        # where the smallest document has it first
        place = np.minimum.reduceat(np.where(is_lost, np.uint32(0xFFFFFFFF), at), opens)
        place = np.repeat(place, times)[is_lost]
        yield from _removed_rows(ids[is_lost], at[is_lost], least[is_lost], place, hashes[is_lost], groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["grp", "ids", "at", "src", "gap", "checks"]
        bucket, parts = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != bucket:
                    if parts and (rows := list(losers(bucket, parts))):
                        yield _rows(rows, names)
                    bucket, parts = row[0], []
                parts.append(row[1:])
        if parts and (rows := list(losers(bucket, parts))):
            yield _rows(rows, names)

    return run


def _pack_texts(groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = [None if not t.is_valid else press(t.as_py()) for t in batch.column(1)]
            named = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).copy()
            # no block is looked up for a row without id, so it may be anywhere
            ids[~named] = [xxhash.xxh64_intdigest(texts[n] or b"") >> 1 for n in np.flatnonzero(~named)]
            columns = [pa.array(_group_of(ids, groups)), batch.column(0), pa.array(texts, pa.binary()), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, ["grp", "id", "text", *batch.schema.names[2:]])

    return run


def _spans(covered: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0)).tolist()
    return [{"start": a, "end": b} for a, b in zip(edge[::2], edge[1::2])]


def parse(starts: np.ndarray, source: np.ndarray, place: np.ndarray, window: int) -> list[tuple[int, int, int, int]]:
    """The factors ``start, length, source, place`` of a text from its blocks that have a source, by ascending start.

    From the front: the next block that begins where the last factor ended or later begins a factor, which takes in the
    blocks after it while they go on in its source.
    """
    if not len(starts):
        return []
    ends = np.flatnonzero((np.diff(starts) != 1) | (np.diff(source) != 0) | (np.diff(place) != 1))
    factors, free = [], 0
    for a, b in zip([0, *(ends + 1)], [*ends, len(starts) - 1]):
        start, last = max(int(starts[a]), free), int(starts[b])
        if start <= last:
            free = last + window
            factors.append((start, free - start, int(source[a]), int(place[a]) + start - int(starts[a])))
    return factors


def _remove(window: int, verbatim: bool):
    """The documents of a group and their blocks that the reference has."""

    def run(texts: pa.Table, removals: pa.Table) -> pa.Table:
        hasher, open_text = Hasher(window), zstandard.ZstdDecompressor().decompress
        parts = [(*_unpack(i, a), s, g, np.frombuffer(c, np.uint16)) for i, a, s, g, c in
                 zip(*(removals.column(n).to_pylist() for n in ("ids", "at", "src", "gap", "checks")))]
        parts = [(i, a, _sums(s, len(a)), _sums(g, len(a)) + a, c) for i, a, s, g, c in parts]
        kinds = np.int64, np.uint32, np.int64, np.int64, np.uint16
        ids, at, source, place, checks = (
            np.concatenate(c) if c else np.zeros(0, k) for c, k in zip(zip(*parts) if parts else [()] * 5, kinds)
        )
        order = np.argsort(ids, kind="stable")
        ids, at, source, place, checks = (c[order] for c in (ids, at, source, place, checks))
        out = {"id": [], "n_words": [], "n_removed": [], "kept": [], "spans": [], "factors": []}
        for doc, packed in zip(texts.column("id"), texts.column("text")):
            doc = doc.as_py()
            text = open_text(packed.as_py()) if packed.is_valid else b""
            words = text.split()
            named = slice(*np.searchsorted(ids, [doc, doc + 1])) if doc is not None else slice(0)
            covered, factors = np.zeros(len(words), bool), []
            if len(at[named]) and len(words) >= window:
                hashes, _ = hasher.windows(*hasher.words([text]))
                lost = np.flatnonzero(at[named] < len(hashes))
                lost = lost[hashes[at[named][lost]].astype(np.uint16) == checks[named][lost]]
                known, first = np.unique(hashes[at[named][lost]], return_index=True)
                lost = lost[first]
                # also where the text repeats such a block: it was sent once
                starts = np.flatnonzero(np.isin(hashes, known))
                lost = lost[np.searchsorted(known, hashes[starts])]
                factors = parse(starts, source[named][lost], place[named][lost], window)
                # the factors' words, and those of the blocks across their boundaries
                change = np.zeros(len(words) + 1, np.int32)
                change[starts] += 1
                change[starts + window] -= 1
                covered = np.cumsum(change[:-1]) > 0
            out["id"].append(doc)
            out["n_words"].append(len(words))
            out["n_removed"].append(int(covered.sum()))
            if verbatim and not covered.any():
                out["kept"].append(text if packed.is_valid else None)
            else:
                out["kept"].append(b" ".join(compress(words, (~covered).tolist())))
            out["spans"].append(_spans(covered))
            out["factors"].append([dict(zip(("start", "length", "source", "place"), f)) for f in factors])
        span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
        factor = pa.struct([("start", pa.int32()), ("length", pa.int32()), ("source", pa.int64()), ("place", pa.int64())])
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(span), pa.list_(factor)]
        found = {n: pa.array(v, k) for (n, v), k in zip(out.items(), kinds)}
        release_memory()
        return pa.table(found | {n: texts.column(n) for n in texts.schema.names[3:]})

    return run


def remove_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    verbatim: bool = False,
    carry: bool = False,
) -> DataFrame:
    """``<id_col>, n_words, n_removed, kept, spans, factors`` for every row of ``docs``.

    Words are separated by ASCII white space. A word is removed if it lies in a window of ``window`` words that also
    starts in a document with a smaller id; ``kept`` has the others, joined by one space, and ``spans`` the removed
    ranges of word numbers. ``factors`` are the parse: ``length`` words from ``start`` on are those of document ``source``
    from its word ``place`` on; the other words are literal. Ids are whole numbers. What a document repeats in itself stays. A null or empty text has no words. A row without id
    takes no part and keeps its words. Rows that repeat an id do not remove each other's words. Other columns are not
    looked at, an empty table gives no rows.

    With ``verbatim`` a text that loses nothing stays as it is, white space and null included. With ``carry`` the rest of
    the row comes along as a struct ``row``.
    """
    rows = id_and_text(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    whole = docs.select(
        docs[id_col].cast("long").alias("id"),
        docs[text_col].cast("string").cast("binary").alias("text"),
        *carried_row(docs, carry, without=text_col),
    )
    more = f", row {ddl(whole, 'row')}" if carry else ""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(8, min(30, (size // BUCKET_BYTES).bit_length()))
    groups = max(256, size // GROUP_BYTES)
    sent = rows.mapInArrow(tidy(_send(window, bits, groups)), _SENT)
    by_bucket = sent.repartition("bucket").sortWithinPartitions("bucket")
    removed = by_bucket.mapInArrow(tidy(_look_up(bits, groups)), _REMOVED)
    texts = whole.mapInArrow(tidy(_pack_texts(groups)), f"grp int, id long, text binary{more}")
    kept = texts.groupBy("grp").cogroup(removed.groupBy("grp")).applyInArrow(
        _remove(window, verbatim),
        f"id long, n_words long, n_removed long, kept binary, spans array<struct<start: int, end: int>>, "
        f"factors {_FACTORS}{more}",
    )
    text = F.col("kept").cast("string").alias("kept")
    return kept.select(F.col("id").alias(id_col), "n_words", "n_removed", text, "spans", "factors", *["row"] * carry)
