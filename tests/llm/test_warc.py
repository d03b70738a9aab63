import gzip

import pytest

from rowtide.llm import warc


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], "page_id long, url string, html string, payload string, id int")


def brute(rows):
    keeper = {}
    for i, _, h in rows:
        keeper[h or ""] = max((x for x in (keeper.get(h or ""), i) if x is not None), default=None)
    out = []
    for i, _, h in rows:
        k, data = keeper[h or ""], (h or "").encode()
        out.append((i, len(data), warc.base32_sha1(data), "response" if i == k else "revisit", None if i == k else k))
    return sorted(out, key=str)


ROWS = [
    (1, "http://a/1", "<p>é</p>"), (2, "http://a/2", "<p>é</p>"), (3, None, None), (4, "http://a/\r\n4", ""), (5, "", "\r\n\r\nx"),
    (None, "http://a/n", "<p>é</p>"), (None, None, "alone"), (6, "u", "six"), (6, "u", "six"), (7, "u", "six"), (7, "v", "six"),
    (8, "long", "ab\r\n\r\n" * 200_000), (-9, "u", "x" * 70_000), (10, "u", "x" * 70_000),
]


def test_round_trip(spark, tmp_path):
    path = f"file://{tmp_path}/pages"
    warc.write_pages(frame(spark, ROWS), path)
    assert sorted(map(tuple, warc.read_pages(spark, path).collect()), key=str) == brute(ROWS)
    # replaced, not added to
    warc.write_pages(frame(spark, ROWS[:3]), path)
    assert sorted(map(tuple, warc.read_pages(spark, path).collect()), key=str) == brute(ROWS[:3])
    warc.write_pages(frame(spark, []), path)
    assert warc.read_pages(spark, path).collect() == []


def test_records_are_standard_gzip(spark, tmp_path):
    warc.write_pages(frame(spark, ROWS[:2]), str(tmp_path))
    data = b"".join(gzip.decompress(f.read_bytes()) for f in tmp_path.glob("*.warc.gz"))
    assert data.count(b"WARC/1.1\r\n") == 2 and data.count("<p>é</p>".encode()) == 1
    assert b"WARC-Refers-To: <urn:page:2>\r\n" in data


def test_predicates_are_pushed_and_unwanted_payloads_skipped(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/pages"
    warc.write_pages(frame(spark, ROWS), path)
    records = spark.read.format("warc").load(path)
    wanted = records.filter("warc_type = 'response' and target_uri in ('long', 'http://a/2')")
    assert sorted(r["record_id"] for r in wanted.collect()) == ["urn:page:2", "urn:page:8"]
    reader = warc.WarcReader(path, True)
    assert list(reader.pushFilters([warc.EqualTo(("warc_type",), "revisit"), warc.EqualTo(("payload_bytes",), 3)])) == [
        warc.EqualTo(("payload_bytes",), 3)]
    read = []
    monkeypatch.setattr(warc._Member, "read", lambda self, count: read.append(count) or b"")
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert len(rows) == sum(r[3] == "revisit" for r in brute(ROWS)) and not read


def test_stretches_of_a_file(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/pages"
    monkeypatch.setattr(warc, "STRETCH", 100)
    writer = warc.WarcWriter(path, True, "2024-01-01T00:00:00Z", 6)
    records = [{"warc_type": "response", "record_id": f"urn:page:{i}", "target_uri": None, "payload_digest": None,
                "payload_bytes": None, "refers_to": None, "payload": b"p" * i} for i in range(20)]
    batch = warc.pa.RecordBatch.from_pylist(records, warc.pa.schema(
        [(n, warc.pa.string()) for n in list(records[0])[:4]] + [("payload_bytes", warc.pa.int64()), ("refers_to", warc.pa.string()),
                                                                 ("payload", warc.pa.binary())]))
    lost = writer.write(iter([batch]))
    writer.commit([writer.write(iter([batch])), None, writer.write(iter([]))])
    reader = warc.WarcReader(path, True)
    parts = reader.partitions()
    assert len(parts) > 5 and not any(lost.name in p.path for p in parts)
    assert sorted(r["payload_bytes"] for p in parts for b in reader.read(p) for r in b.to_pylist()) == list(range(20))
    writer.abort([lost, None])


@pytest.mark.parametrize("pack", [lambda r: r, gzip.compress])
def test_archives_from_elsewhere(spark, tmp_path, pack):
    rows = [{"warc_type": "response", "record_id": f"urn:page:{i}", "target_uri": f"u{i}", "payload_digest": None,
             "payload_bytes": None, "refers_to": None, "payload": bytes([65 + i]) * 100_000} for i in range(3)]
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Type: text/plain\r\nX-Folded: a\r\n b\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    name = "x.warc" if pack(b"a") == b"a" else "x.warc.gz"
    (tmp_path / name).write_bytes(b"".join(map(pack, [info, *(warc.record_bytes(r, "2024-01-01T00:00:00Z") for r in rows)])))
    warc.register(spark)
    one = spark.read.format("warc").load(str(tmp_path)).filter("target_uri = 'u1'").collect()
    assert [r["payload"] for r in one] == [b"B" * 100_000]
    got = [(r["warc_type"], r["payload_bytes"]) for r in spark.read.format("warc").load(str(tmp_path)).collect()]
    assert got == [("warcinfo", 3)] + [("response", 100_000)] * 3
