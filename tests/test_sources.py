import pytest

from rowtide.sources import json_rows, kafka, landed
from tests.helpers import C1, rows


def test_stream_options():
    got = kafka.reader_options("h:9092", "a,b", start=1_700_000_000, max_offsets_per_trigger=1000)
    assert got == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "a,b",
        "failOnDataLoss": "false",
        "startingTimestamp": "1700000000000",
        "startingOffsetsByTimestampStrategy": "latest",
        "maxOffsetsPerTrigger": "1000",
    }
    assert kafka.reader_options("h", "t")["startingOffsets"] == "latest"
    assert kafka.reader_options("h", "t", start=-2)["startingOffsets"] == "earliest"
    assert kafka.reader_options("h", "t", start=-9)["startingOffsets"] == "latest"


def test_bounded_options():
    got = kafka.reader_options("h", "t", start=-2, end=1_700_000_000_123)
    assert (got["startingOffsets"], got["endingTimestamp"]) == ("earliest", "1700000000123")
    assert "maxOffsetsPerTrigger" not in got
    whole = kafka.reader_options("h", "t", start=-2, bounded=True)
    assert (whole["startingOffsets"], whole["endingOffsets"]) == ("earliest", "latest")


def test_options_that_cannot_work():
    with pytest.raises(ValueError, match="cannot start at the latest"):
        kafka.reader_options("h", "t", start=-1, end=1_700_000_000)
    with pytest.raises(ValueError, match="no end"):
        kafka.reader_options("h", "t", start=-2, end=1_700_000_000, bounded=False)


def test_security_options_pass_through():
    security = {"security.protocol": "SASL_PLAINTEXT", "kafka.sasl.mechanism": "PLAIN"}
    got = kafka.reader_options("h", "t", security=security)
    assert got["kafka.security.protocol"] == "SASL_PLAINTEXT" and got["kafka.sasl.mechanism"] == "PLAIN"
    assert not [k for k in kafka.reader_options("h", "t") if "sasl" in k or "security" in k]


def test_project_feed(spark):
    messages = spark.sql(
        "select cast('k' as binary) key, cast('v' as binary) value, 't' topic, 3 partition, 7L offset, "
        "timestamp'2024-01-01 00:00:01.900' timestamp, 0 timestampType"
    )
    got = landed.project_feed(messages)
    assert got.dtypes == [
        ("value", "string"), ("timestamp", "bigint"), ("topic", "string"), ("partition", "int"), ("offset", "bigint"),
    ]
    assert tuple(got.first()) == ("v", 1_704_067_201, "t", 3, 7)


def test_land_and_read_back(spark, tmp_path):
    path = str(tmp_path / "feed")
    landed.land(spark.createDataFrame([("v", 5), (None, 6)], "value string, timestamp long"), path)
    landed.land(spark.createDataFrame([("w", 7, 1, 2)], "value string, timestamp int, partition int, offset long"), path)
    got = landed.bounded_landed(spark, path)
    assert got.schema == landed.LANDED_SCHEMA
    assert sorted((r.timestamp, r.value, r.offset) for r in got.collect()) == [(5, "v", None), (6, None, None), (7, "w", 2)]


def test_json_rows(spark, tmp_path):
    path = str(tmp_path / "rows")
    source = spark.range(300).selectExpr("id", "id / 4 price", "if(id = 299, struct(id as deep), null) late")
    json_rows.write_json_rows(source.repartition(3), path)
    inferred = json_rows.read_json_rows(spark, path)
    # a field that shows up in the last row only is found: all rows count for the schema
    assert dict(inferred.dtypes) == {"id": "bigint", "price": "double", "late": "struct<deep:bigint>"}
    assert inferred.count() == 300
    given = json_rows.read_json_rows(spark, path, "id long, extra string")
    assert given.columns == ["id", "extra"] and given.count() == 300
    assert rows(given.filter("id = 1"), "id", "extra") == [(1, None)]
