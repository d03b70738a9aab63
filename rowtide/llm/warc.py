"""WARC archives as a Spark data source, written and read in parallel.

Format ``warc``. A task writes one file of gzip members, a record each; a member says how long it is in its extra field,
so a reader that does not want a record goes on without inflating the rest. A write lists its files in a manifest, which
is made last: files of failed or repeated tasks are in none and are not read. Manifests also keep places where a large
file can be cut, and reading plans one partition per stretch. Archives from elsewhere (no manifest, plain or gzip) are
read file by file. Predicates on record type, id, target, digest and the record referred to are pushed down; the reader
parses a record's headers first and decodes a payload only if they pass.

Paths are URIs that ``pyarrow.fs`` knows, in a folder all executors share. Load the path anew for every query: Spark keeps
the predicates of the first one with a loaded relation.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.datasource import WriterCommitMessage

from rowtide.llm.common import small_batches

SCHEMA = (
    "warc_type string, record_id string, target_uri string, payload_digest string, payload_bytes long, "
    "refers_to string, payload binary"
)
RESPONSE, REVISIT = "response", "revisit"
# Header lines of the format, and what names a record whose payload another one has.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Headers behind the columns that filters may name. The length is an extension field.
HEADERS = {
    "warc_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest",
    "payload_bytes": "WARC-X-Payload-Length",
    "refers_to": "WARC-Refers-To",
}
PUSHED = ("warc_type", "record_id", "target_uri", "payload_digest", "refers_to")
STRETCH, READ_BYTES, BATCH_BYTES = 32 << 20, 1 << 16, 1 << 20


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _safe(value: str) -> str:
    """Header values are one line."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\n" in value or "\r" in value else value


def record_bytes(row: dict, date: str) -> bytes:
    """One record. ``payload`` null: a revisit, which has only the headers of the answer."""
    payload = row["payload"]
    digest = base32_sha1(payload) if payload is not None else row["payload_digest"]
    length = len(payload) if payload is not None else row["payload_bytes"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % (length or 0)
    block = http + (payload or b"")
    values = {
        "WARC-Type": row["warc_type"],
        "WARC-Record-ID": f"<{row['record_id']}>",
        "WARC-Date": date,
        "WARC-Target-URI": row["target_uri"],
        "WARC-Payload-Digest": f"sha1:{digest}" if digest else None,
        "WARC-X-Payload-Length": None if length is None else str(length),
        "WARC-Refers-To": None if row["refers_to"] is None else f"<{row['refers_to']}>",
        "WARC-Profile": REVISIT_PROFILE if row["warc_type"] == REVISIT else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = [VERSION, *(f"{k}: {_safe(v)}".encode() for k, v in values.items() if v is not None)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


# The start of a gzip member with an extra field, and the subfield that holds its lengths.
_GZIP = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff"
_LENGTHS = "<H2sHII"
_LENGTHS_SIZE = struct.calcsize(_LENGTHS)


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member whose extra field ``sl`` has its whole length and the length of what it holds."""
    press = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = press.compress(data) + press.flush()
    total = len(_GZIP) + _LENGTHS_SIZE + len(body) + 8
    extra = struct.pack(_LENGTHS, 12, b"sl", 8, total & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return _GZIP + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


@dataclass
class Written(WriterCommitMessage):
    name: str | None
    size: int
    cuts: list[int]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool, date: str, level: int):
        self.path, self.overwrite, self.date, self.level = path, overwrite, date, level

    def _place(self):
        return pa.fs.FileSystem.from_uri(self.path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = self._place()
        fs.create_dir(folder, recursive=True)
        name, size, cuts, out = f"part-{uuid.uuid4().hex}.warc.gz", 0, [0], None
        try:
            for batch in iterator:
                for row in range(batch.num_rows):
                    out = out or fs.open_output_stream(f"{folder}/{name}", compression=None)
                    values = {n: c[row].as_py() for n, c in zip(batch.schema.names, batch.columns)}
                    if size - cuts[-1] >= STRETCH:
                        cuts.append(size)
                    size += out.write(member(record_bytes(values, self.date), self.level))
        finally:
            if out:
                out.close()
        return Written(name if out else None, size, cuts)

    def commit(self, messages: list[Written | None]) -> None:
        fs, folder = self._place()
        fs.create_dir(folder, recursive=True)
        old = _manifests(fs, folder) if self.overwrite else []
        lines = [json.dumps({"name": m.name, "size": m.size, "cuts": m.cuts}) for m in messages if m and m.name]
        name = f"{folder}/manifest-{uuid.uuid4().hex}.jsonl"
        with fs.open_output_stream(f"{name}.new") as out:
            out.write("".join(f"{line}\n" for line in lines).encode())
        fs.move(f"{name}.new", name)
        for path in old:
            files = [entry["name"] for entry in _entries(fs, path)]
            fs.delete_file(path)
            for file in files:
                fs.delete_file(f"{folder}/{file}")

    def abort(self, messages: list[Written | None]) -> None:
        fs, folder = self._place()
        for message in messages:
            if message and message.name:
                fs.delete_file(f"{folder}/{message.name}")


def _manifests(fs, folder: str) -> list[str]:
    found = fs.get_file_info(pa.fs.FileSelector(folder, allow_not_found=True))
    return sorted(f.path for f in found if f.base_name.startswith("manifest-") and f.base_name.endswith(".jsonl"))


def _entries(fs, manifest: str) -> list[dict]:
    with fs.open_input_stream(manifest) as lines:
        return [json.loads(line) for line in lines.read().splitlines()]


@dataclass
class Stretch(InputPartition):
    path: str
    start: int
    end: int


class _Bytes:
    """A file read forward, with jumps."""

    def __init__(self, file, at: int):
        self.file, self.at, self.held = file, at, b""
        file.seek(at)

    def peek(self, count: int) -> bytes:
        while len(self.held) < count and (more := self.file.read(max(READ_BYTES, count - len(self.held)))):
            self.held += more
        return self.held[:count]

    def take(self, count: int) -> bytes:
        out = self.peek(count)
        self.held, self.at = self.held[count:], self.at + len(out)
        return out

    def skip(self, count: int) -> None:
        """Forward, or back over what a gzip member did not need."""
        self.at += count
        if 0 <= count <= len(self.held):
            self.held = self.held[count:]
        else:
            self.held = b""
            self.file.seek(self.at)


class _Plain:
    """A record in an archive that is not compressed."""

    def __init__(self, source: _Bytes):
        self.source, self.used = source, 0

    def read(self, count: int) -> bytes:
        out = self.source.take(count)
        self.used += len(out)
        return out

    def until(self, mark: bytes) -> bytes:
        size = READ_BYTES
        while (at := (seen := self.source.peek(size)).find(mark)) < 0 and len(seen) == size:
            size *= 2
        return self.read(at + len(mark) if at >= 0 else len(seen))

    def close(self, rest: int) -> None:
        self.source.skip(rest)


class _Member:
    """A record in a gzip member of its own."""

    def __init__(self, source: _Bytes):
        self.source, self.start, self.held = source, source.at, b""
        self.total = None
        head = source.peek(len(_GZIP) + _LENGTHS_SIZE)
        if head[3:4] == b"\x04" and len(head) == len(_GZIP) + _LENGTHS_SIZE:
            _, name, _, total, _ = struct.unpack(_LENGTHS, head[len(_GZIP) :])
            self.total = total if name == b"sl" else None
        self.inflate = zlib.decompressobj(31)

    def _more(self, count: int) -> bytes:
        while not self.inflate.eof:
            data = self.inflate.unconsumed_tail or self.source.take(READ_BYTES)
            if not data:
                raise EOFError("a gzip member has no end")
            if out := self.inflate.decompress(data, count):
                return out
        return b""

    def read(self, count: int) -> bytes:
        parts, size = [self.held[:count]], min(count, len(self.held))
        self.held = self.held[count:]
        while size < count and (more := self._more(count - size)):
            parts.append(more)
            size += len(more)
        return b"".join(parts)

    def until(self, mark: bytes) -> bytes:
        while (at := self.held.find(mark)) < 0 and (more := self._more(2048)):
            self.held += more
        out, self.held = self.held[: at + len(mark)], self.held[at + len(mark) :]
        return out

    def close(self, rest: int) -> None:
        if self.total is not None:
            end = self.start + self.total
        else:
            while self._more(READ_BYTES):
                pass
            end = self.source.at - len(self.inflate.unused_data)
        self.source.skip(end - self.source.at)


def parse_headers(block: bytes) -> dict[str, str]:
    """Header lines by lower-case name; a line that begins with white space goes on with the one before."""
    out, last = {}, None
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            last = name.strip().lower()
            out[last] = value.strip()
    return out


def _column(headers: dict[str, str], column: str):
    value = headers.get(HEADERS[column].lower())
    if value is None:
        return None
    if column in ("record_id", "refers_to", "target_uri"):
        return value.removeprefix("<").removesuffix(">")
    if column == "payload_digest":
        return value.removeprefix("sha1:")
    return int(value) if column == "payload_bytes" else value


class WarcReader(DataSourceReader):
    def __init__(self, path: str, verify: bool):
        self.path, self.verify = path, verify
        self.wanted: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in PUSHED:
                self.wanted.append((f.attribute[0], frozenset([f.value] if isinstance(f, EqualTo) else f.value)))
            else:
                yield f

    def partitions(self) -> list[Stretch]:
        fs, folder = pa.fs.FileSystem.from_uri(self.path)
        manifests = _manifests(fs, folder)
        if manifests:
            entries = [e for m in manifests for e in _entries(fs, m)]
            return [
                Stretch(f"{folder}/{e['name']}", a, b)
                for e in entries
                for a, b in zip(e["cuts"], [*e["cuts"][1:], e["size"]])
            ]
        found = fs.get_file_info(pa.fs.FileSelector(folder, allow_not_found=True))
        return [Stretch(f.path, 0, f.size) for f in found if f.base_name.endswith((".warc", ".warc.gz"))]

    def _rows(self, stretch: Stretch) -> Iterator[tuple]:
        fs, _ = pa.fs.FileSystem.from_uri(self.path)
        with fs.open_input_file(stretch.path) as file:
            source = _Bytes(file, stretch.start)
            while source.at < stretch.end and (magic := source.peek(2)):
                if magic in (b"\r\n", b"\n"):
                    source.skip(2)
                    continue
                record = _Member(source) if magic == b"\x1f\x8b" else _Plain(source)
                headers = parse_headers(record.until(b"\r\n\r\n"))
                length = int(headers.get("content-length", 0))
                values = {c: _column(headers, c) for c in HEADERS}
                rest, payload = length, None
                if all(values[c] in allowed for c, allowed in self.wanted):
                    if values["warc_type"] != REVISIT:
                        payload = record.read(length)
                        rest = 0
                        if headers.get("content-type", "").startswith("application/http"):
                            payload = payload.partition(b"\r\n\r\n")[2]
                        if values["payload_bytes"] is None:
                            values["payload_bytes"] = len(payload)
                        if self.verify and values["payload_digest"] not in (None, base32_sha1(payload)):
                            raise ValueError(f"{stretch.path}: payload of {values['record_id']} has another digest")
                    yield (*values.values(), payload)
                record.close(rest)

    def read(self, partition: Stretch | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # nothing was planned
            return
        kinds = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()]
        names, rows, size = [*HEADERS, "payload"], [], 0
        for row in self._rows(partition):
            rows.append(row)
            size += len(row[-1] or b"") + 200
            if size >= BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


class WarcDataSource(DataSource):
    """Options: ``path``; ``date`` (of written records), ``level`` (of compression), ``verify`` (payloads against their
    digests while reading, default true)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("verify", "true").lower() == "true")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        now = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        return WarcWriter(
            self.options["path"], overwrite, self.options.get("date", now), int(self.options.get("level", 6))
        )


def register(spark: SparkSession) -> None:
    """Make format ``warc`` known to the session and let it take predicates."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def page_records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0
) -> DataFrame:
    """One record per page, in the columns of the format.

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with the largest id is the response and the
    others revisit it; rows that repeat that id are responses too. A null id is smaller than any; if all are null, all
    are responses. A null page has an empty payload. Record ids are ``urn:page:<id>``.
    """
    payload = F.coalesce(pages[html_col].cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        pages[id_col].cast("long").alias("id"), pages[url_col].cast("string").alias("url"), payload.alias("payload")
    ).withColumn("sha1", F.sha1("payload"))
    keepers = rows.groupBy("sha1").agg(F.max("id").alias("keeper"))
    both = rows.join(keepers, "sha1")
    is_response = (F.octet_length("payload") < min_bytes) | F.col("id").eqNullSafe(F.col("keeper"))
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")))
    return both.select(
        F.when(is_response, RESPONSE).otherwise(REVISIT).alias("warc_type"),
        urn("id").alias("record_id"),
        F.col("url").alias("target_uri"),
        base32(F.col("sha1")).alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(~is_response, urn("keeper")).alias("refers_to"),
        F.when(is_response, F.col("payload")).alias("payload"),
    )


def base32(hex_digest):
    """Base32 text of a hexadecimal digest whose length is a multiple of five digits."""
    # Fixed value: the digits of base 32.
    digits = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    parts = []
    for start in range(1, 41, 5):
        value = F.conv(F.substring(hex_digest, start, 5), 16, 10).cast("int")
        parts += [F.substring(digits, F.shiftright(value, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(*parts)


def write_pages(pages: DataFrame, path: str, **columns) -> None:
    """Write a page table as archives below ``path``, replacing what is there."""
    register(pages.sparkSession)
    small_batches(pages)
    page_records(pages, **columns).write.format("warc").mode("overwrite").save(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every record below ``path``, payloads of
    responses decoded and checked, revisits by their headers alone."""
    register(spark)
    page = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1).try_cast("long")
    # a relation of its own for each: a reader keeps the predicates pushed down to it
    responses, revisits = (spark.read.format("warc").load(path) for _ in range(2))
    responses = responses.filter(F.col("warc_type") == RESPONSE).withColumn(
        "payload_bytes", F.octet_length("payload").cast("long")
    )
    revisits = revisits.filter(F.col("warc_type") == REVISIT)
    return responses.unionByName(revisits).select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("warc_type").alias("record_type"),
        page("refers_to").alias("refers_to"),
    )
