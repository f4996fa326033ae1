"""Decoding of messages, quarantine, connector options."""

import pytest

from roadpulse.schema import EVENT_SCHEMA
from roadpulse.sources import streams

GOOD = (
    '{"source_id":"cam_01","tracker_id":7,"vehicle_type":"car","speed_kmh":12.5,"confidence":0.9,'
    '"timestamp":"2024-01-01 00:00:00","position_meters":{"x":1.5,"y":2.0},"frame":3}'
)


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_decode_never_fails(spark):
    bad_type = GOOD.replace("7", '"x"', 1)
    df = frame(spark, GOOD, GOOD[:20], bad_type, GOOD.replace("{", '{"extra":1,', 1), "[]", "", None)
    rows = streams.decode(df).collect()
    assert len(rows) == 7
    assert (rows[0].source_id, rows[0].position_meters.x, rows[0].trajectory_length) == ("cam_01", 1.5, None)
    assert all(value is None for value in rows[1])
    assert (rows[2].source_id, rows[2].tracker_id, rows[2].speed_kmh) == ("cam_01", None, 12.5)
    assert rows[3] == rows[0]
    assert [r.source_id for r in rows[4:]] == [None, None, None]


def test_decode_reads_bytes(spark):
    df = spark.createDataFrame([(bytearray(GOOD.encode()),)], "value binary")
    assert streams.decode(df).first().tracker_id == 7


def test_quarantine_names_what_is_missing(spark):
    df = frame(spark, GOOD, GOOD.replace('"speed_kmh"', '"speed"'), GOOD[:20])
    good, bad = streams.decode_checked(df)
    assert good.count() == 1
    missing = sorted(bad.collect(), key=lambda r: len(r.missing))
    assert missing[0].missing == ["speed_kmh"]
    assert len(missing[1].missing) == 5
    with pytest.raises(ValueError, match="Missing columns"):
        streams.decode_checked(df, EVENT_SCHEMA, ["source_id", "plate"])


def test_field_coverage(spark):
    df = frame(spark, GOOD, GOOD.replace('"speed_kmh"', '"speed"'), GOOD[:20])
    got = {r.column_name: (r.messages, r.is_missing) for r in streams.field_coverage(df, ["source_id", "speed_kmh", "plate"]).collect()}
    assert got == {"source_id": (2, False), "speed_kmh": (1, False), "plate": (0, True)}
    assert streams.missing_columns(df, ["value", "plate"]) == ["plate"]


def test_topic_options():
    options = streams.topic_options("broker:9092", "topic", 3000, extra={"kafka.security.protocol": "SSL"})
    assert options == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "topic",
        "startingOffsets": "latest",
        "failOnDataLoss": "true",
        "maxOffsetsPerTrigger": "3000",
        "kafka.security.protocol": "SSL",
    }
    assert "maxOffsetsPerTrigger" not in streams.topic_options("b", "t", None)
    assert streams.topic_options("b", "t", None, fail_on_data_loss=False)["failOnDataLoss"] == "false"
    with pytest.raises(TypeError):
        streams.topic_options("b", "t")
    assert streams.producer_options("b", "t")["kafka.linger.ms"] == "5"


def test_topic_records_round_trip(spark):
    decoded = streams.decode(frame(spark, GOOD))
    records = streams.topic_records(decoded)
    assert records.columns == ["key", "value"]
    assert records.first().key == "cam_01"
    assert streams.decode(records).collect() == decoded.collect()
