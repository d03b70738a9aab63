"""Order MinHash fingerprints of whole texts, sensitive to the order of what they share.

The k-mers of a text are numbered by occurrence (first, second, ... of the same k-mer). For each of ``functions`` hash
functions the ``picked`` k-mers of smallest hash are selected, put back into text order, and the tuple is hashed; the
tuple hashes are the fingerprint. The share of equal entries estimates how alike two texts are: moving a passage changes
the order inside tuples, which a plain MinHash would not notice. A text shorter than a k-mer is its own only k-mer, an
empty text has a fingerprint of its own. Equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import id_and_text, per_slice

KMER, PICKED, FUNCTIONS = 8, 2, 32
# k-mers expected below the threshold that narrows the search for the smallest, per function.
NARROWED = 16
# k-mers hashed under all functions at a time, and the text of a bucket of neighbouring documents.
COLUMNS, BUCKET_BYTES, MOST_BUCKETS = 16384, 8_000_000, 16384
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Sketcher:
    def __init__(self, kmer: int = KMER, picked: int = PICKED, functions: int = FUNCTIONS):
        self.kmer, self.picked, self.functions = kmer, picked, functions
        self._factors = (_mix(np.arange(1, functions + 1, dtype=np.uint64)) | np.uint64(1))[:, None]

    def _kmers(self, points: np.ndarray) -> np.ndarray:
        size = min(self.kmer, len(points))
        values, width = points.astype(np.uint64) + np.uint64(1), 1
        with np.errstate(over="ignore"):
            while width < size:  # two neighbouring stretches make one of twice the width, the last ones may overlap
                step = min(width, size - width)
                factor = np.uint64(pow(int(_BASE), width, 1 << 64))
                values = values[:-step] * factor + values[step:]
                width += step
                if step < width - step:
                    values = _mix(values)
        return _mix(values)

    def sketch(self, text: str) -> np.ndarray:
        """``functions`` unsigned 32-bit numbers."""
        if not text:
            return np.zeros(self.functions, np.uint32)
        hashes = self._kmers(np.frombuffer(text.encode("utf-32-le"), np.uint32))
        count = len(hashes)
        if count < 1 << 20:
            packed = np.sort((hashes & ~np.uint64((1 << 20) - 1)) | np.arange(count, dtype=np.uint64))
            place = (packed & np.uint64((1 << 20) - 1)).astype(np.int64)
            hashes = packed >> np.uint64(20) << np.uint64(20)
        else:
            hashes = hashes & ~np.uint64((1 << 20) - 1)
            place = np.argsort(hashes, kind="stable")
            hashes = hashes[place]
        number = np.arange(count)
        opens = np.append(True, hashes[1:] != hashes[:-1])
        occurrence = number - np.maximum.accumulate(np.where(opens, number, 0))
        numbered = _mix(hashes ^ (occurrence.astype(np.uint64) * _BASE))
        picked = min(self.picked, count)
        best = self._smallest(numbered, picked)
        order = np.take_along_axis(best, np.argsort(place[best], axis=1), 1)
        out = np.full(self.functions, picked, np.uint64)
        for column in range(picked):
            out = _mix(out * _BASE + hashes[order[:, column]])
        return (out >> np.uint64(32)).astype(np.uint32)

    def _smallest(self, numbered: np.ndarray, picked: int) -> np.ndarray:
        """Function x picked: which k-mers have the smallest hashes."""
        count = len(numbered)
        limit = np.uint64(min((1 << 64) - 1, (1 << 64) * max(NARROWED, 8 * picked) // count))
        function, column, value = [], [], []
        for at in range(0, count, COLUMNS):
            product = numbered[at : at + COLUMNS] * self._factors
            found = np.flatnonzero(product <= limit)
            function.append(found // product.shape[1])
            column.append(found % product.shape[1] + at)
            value.append(product.ravel()[found])
        function, column, value = map(np.concatenate, (function, column, value))
        order = np.lexsort((value, function))
        first = np.searchsorted(function[order], np.arange(self.functions))
        enough = np.diff(first, append=len(order)) >= picked
        out = np.zeros((self.functions, picked), np.int64)
        out[enough] = column[order[first[enough, None] + np.arange(picked)]]
        for missed in np.flatnonzero(~enough):
            product = numbered * self._factors[missed]
            least = np.argpartition(product, picked - 1)[:picked]
            out[missed] = least[np.argsort(product[least])]
        return out


def as_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    return float((one == other).mean())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **sizes: int) -> DataFrame:
    """``<id_col>, n_chars, fingerprint`` of every row. A null text counts as empty, null ids and repeated rows stay,
    other columns are not looked at, an empty table gives no rows."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sketcher = Sketcher(**sizes)
        texts = [(t or b"").decode() for t in batch.column(1).to_pylist()]
        columns = [
            batch.column(0),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([as_text(sketcher.sketch(t)) for t in texts], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["id", "n_chars", "fingerprint"])

    rows = id_and_text(docs, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(per_slice(work), f"id {kind}, n_chars long, fingerprint string")
    return found.withColumnRenamed("id", id_col)


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **sizes: int) -> DataFrame:
    """Every text against an edited version of itself and against the next document.

    The edited text has its last quarter (rounded down) replaced by the first as many code points, or all, of the next
    document by ascending id; the first follows the last. Rows that repeat an id come in the order of a hash of their
    text. A row without id comes after the last one and is followed by the first document, or by itself if no row has
    an id. Returns ``<id_col>, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``, one
    row per row of ``docs``; null texts count as empty, other columns are not looked at, an empty table gives none.

    Documents are dealt once, compressed, to buckets of neighbouring ids, each with a copy of the document after its
    last one.
    """
    rows = id_and_text(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    size, least, unnamed = rows.agg(
        F.sum(F.octet_length("text")), F.min("id"), F.count_if(F.col("id").isNull())
    ).first()
    # as many ids on the driver as there are buckets; a larger corpus has larger buckets, which tasks stream through
    buckets = min(MOST_BUCKETS, max(64, (size or 0) // BUCKET_BYTES))
    cuts = rows.select("id").approxQuantile("id", [i / buckets for i in range(1, buckets)], 0.25 / buckets)
    starts = sorted({int(c) for c in cuts} - {least}) if least is not None else []
    dealt = rows.mapInArrow(
        _deal(np.array(starts, np.int64), buckets, least, unnamed > 0),
        "bucket int, turn int, id long, tie long, text binary",
    )
    order = ["bucket", "turn", "id", "tie"]
    near = dealt.repartition("bucket").sortWithinPartitions(*order).mapInArrow(
        _compare(len(starts), sizes),
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
    return near.withColumnRenamed("doc_id", id_col)


# The order inside a bucket: what follows rows without id, the rows, the document after the last row.
_FIRST, _ROW, _AFTER = -1, 0, 1


def _deal(starts: np.ndarray, buckets: int, least: int | None, unnamed: bool):
    last = len(starts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3).compress
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                out = []
                for doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                    text = text or b""
                    tie = xxhash.xxh64_intdigest(text) - (1 << 63)
                    packed = press(text)
                    if doc is None:
                        out.append((last + 1 + tie % buckets, _ROW, None, tie, packed))
                        continue
                    bucket = int(np.searchsorted(starts, doc, side="right"))
                    out.append((bucket, _ROW, doc, tie, packed))
                    if bucket and starts[bucket - 1] == doc:
                        out.append((bucket - 1, _AFTER, doc, tie, packed))
                    if doc == least:
                        out.append((last, _AFTER, doc, tie, packed))
                        if unnamed:
                            out += [(last + 1 + b, _FIRST, doc, tie, packed) for b in range(buckets)]
                kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "turn", "id", "tie", "text"])

    return run


def _compare(last: int, sizes: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher, open_text = Sketcher(**sizes), zstandard.ZstdDecompressor().decompress

        def compared(doc, text, sketch, next_text, next_sketch) -> tuple:
            tail = len(text) // 4
            edited = text[: len(text) - tail] + next_text[:tail]
            again = sketcher.sketch(edited) if edited != text else sketch
            return (
                doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), as_text(sketch), as_text(again),
                likeness(sketch, again), likeness(sketch, next_sketch),
            )

        def rows() -> Iterator[tuple]:
            bucket = before = first = None
            for batch in batches:
                for at in range(0, batch.num_rows, 64):
                    part = batch.slice(at, 64).to_pydict()
                    for b, turn, doc, packed in zip(part["bucket"], part["turn"], part["id"], part["text"]):
                        if b != bucket:
                            bucket, before, first = b, None, None
                        if turn == _FIRST and first or turn == _AFTER and before is None:
                            continue  # another row of the same id
                        text = open_text(packed).decode()
                        here = doc, text, sketcher.sketch(text)
                        if turn == _FIRST:
                            first = here
                        elif bucket > last:
                            yield compared(*here, *(first or here)[1:])
                        else:
                            if before:
                                yield compared(*before, *here[1:])
                            before = here if turn == _ROW else None

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], _NAMES)

        out = []
        for row in rows():
            out.append(row)
            if len(out) == 1024:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    return run
