"""Message log on inline messages."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.rules import Rule
from millrace.functions.scalars import time_bucket
from millrace.schemas import ENVELOPE
from millrace.sources import log

AS_OF = datetime(2024, 1, 31, 12, 0, 0, 123456)
PAYLOAD = T.StructType([T.StructField("n", T.LongType())])


def envelope(spark, values, topic="t"):
    rows = [("k", v, topic, 0, i, datetime(2024, 1, 1)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, ENVELOPE)


def rules():
    return [Rule("n", "required", F.col("message.n").isNotNull())]


def offsets(df):
    return sorted(r.offset for r in df.collect())


def test_bad_messages_do_not_count(spark):
    source = envelope(spark, ['{"n":1}', "{oops", '{"n":2}', "nope", '{"n":3}'])
    good, bad = log.consume(source, PAYLOAD, rules(), 2)
    assert offsets(good) == [0, 2] and offsets(bad) == [1]
    assert {e for r in bad.collect() for e in r.validation_errors} >= {"value:json"}


@pytest.mark.parametrize("cap", [0, None])
def test_no_cap(spark, cap):
    good, bad = log.consume(envelope(spark, ['{"n":1}', "{", '{"n":2}', ""]), PAYLOAD, rules(), cap)
    assert offsets(good) == [0, 2] and offsets(bad) == [1, 3]


def test_cap_beyond_the_end_reads_everything(spark):
    good, bad = log.consume(envelope(spark, ['{"n":1}', "{"]), PAYLOAD, rules(), 5)
    assert offsets(good) == [0] and offsets(bad) == [1]


@pytest.mark.parametrize("top_k", [0, 10_000])
@pytest.mark.parametrize("cap", [1, 2, 5, 6, 7, 9, 100])
def test_cap_over_partitions_and_copies(spark, monkeypatch, top_k, cap):
    """The same answer from the top-k and from counting; offset 3 of partition 1 comes three times."""
    monkeypatch.setattr(log, "STRETCH", top_k)
    spec = [(0, 0, 1), (0, 1, None), (0, 2, 2), (1, 0, 3), (1, 1, None), (1, 3, 4), (1, 3, 4), (1, 3, 4), (1, 7, None),
            (2, 0, 5)]
    rows = [("k", "bad" if n is None else f'{{"n":{n}}}', "t", p, o, datetime(2024, 1, 1)) for p, o, n in spec]
    good, bad = log.consume(spark.createDataFrame(rows, ENVELOPE), PAYLOAD, rules(), cap)
    fine = [(p, o) for p, o, n in spec if n is not None]
    taken = fine[:cap]
    stop = taken[-1] if len(fine) >= cap else (9, 9)
    assert sorted((r.partition, r.offset) for r in good.collect()) == taken
    assert sorted((r.partition, r.offset) for r in bad.collect()) == [(p, o) for p, o, n in spec if n is None and (p, o) < stop]


def test_decode_bytes_and_empty(spark):
    rows = [(bytearray(b"key"), bytearray(b'{"n":7}')), (bytearray(b""), bytearray(b""))]
    df = spark.createDataFrame(rows, "key binary, value binary")
    a, b = log.decode(df, PAYLOAD).collect()
    assert (a.key, a.message.n) == ("key", 7)
    assert (b.key, b.value) == (None, None)


def test_stamp_overwrites(spark):
    df = spark.createDataFrame(
        [(1, "mine", "me", "", None, datetime(2024, 1, 1, 0, 0, 0, 5))],
        "a int, timestamp string, producer_id string, k string, gone string, at timestamp_ntz",
    )
    row = log.to_envelope(df, "t", "client", AS_OF, key="k").collect()[0]
    assert json.loads(row.value) == {
        "a": 1, "gone": None, "at": "2024-01-01T00:00:00.000005",
        "timestamp": "2024-01-31T12:00:00.123456", "producer_id": "client",
    }
    assert row.key is None and row.message_size == len(row.value) and row.topic == "t"


def test_batch_keys(spark):
    df = spark.createDataFrame([("b", i) for i in range(5)], "batch string, i int").withColumn(
        "at", F.timestamp_seconds("i").cast("timestamp_ntz")
    )
    keys = spark.createDataFrame([("b", i, f"k{i}") for i in range(3)], "batch string, batch_index long, message_key string")
    out = log.to_batch_envelope(df, "t", "c", AS_OF, ["batch"], [F.col("at")], keys)
    got = {json.loads(r.value)["batch_index"]: r.key for r in out.collect()}
    assert got == {0: "k0", 1: "k1", 2: "k2", 3: None, 4: None}
    plain = log.to_batch_envelope(df, "t", "c", AS_OF, ["batch"], [F.col("at")], bucket=time_bucket("at", 2))
    assert sorted(json.loads(r.value)["batch_index"] for r in plain.collect()) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("offset_range", [1, 3, 1000])
def test_gaps_across_ranges(spark, offset_range):
    rows = [("t", 0, o) for o in (5, 6, 6, 6, 9, 10, 50)] + [("t", 1, o) for o in (0, 1)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long").withColumn(
        "timestamp", F.lit(None).cast("timestamp")
    )
    got = {(r.partition, r.previous_offset, r.offset, r.kind, r.n) for r in log.offset_gaps(df, offset_range).collect()}
    assert got == {(0, 5, 6, "repeat", 2), (0, 6, 9, "gap", 2), (0, 10, 50, "gap", 39)}
    stats = {r.partition: (r.messages, r.min_offset, r.max_offset, r.missing) for r in log.topic_stats(df).collect()}
    assert stats == {0: (7, 5, 50, 41), 1: (2, 0, 1, 0)}


def test_unknown_topic(spark):
    source = envelope(spark, ['{"n":1}'])
    assert log.topic_info(source, "t").count() == 1
    with pytest.raises(ValueError):
        log.topic_info(source, "other")


def test_kafka_options():
    options = log.kafka_options("host:9092", ["a", "b"], group_id="g")
    assert options == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "a,b", "startingOffsets": "earliest",
        "kafka.max.poll.records": "500", "failOnDataLoss": "true", "groupIdPrefix": "g",
    }
    with pytest.raises(ValueError):
        log.kafka_options("host:9092", [])


def test_for_each_message(spark):
    judged = log.judge(envelope(spark, ['{"n":1}', '{"n":2}']), PAYLOAD, rules()).select("offset", "message.n")
    out = log.for_each_message(judged, lambda b: b.assign(n=b["n"] * 10), "offset long, n long")
    assert sorted((r.offset, r.n) for r in out.collect()) == [(0, 10), (1, 20)]
