"""Connectors that are not installed here: what would be asked of them."""

from types import SimpleNamespace

import pytest

from tidemark.sources import TopicSource, qualified_scan, read_topic, scan_jdbc, split_name, stream_topic
from tidemark.streaming.sinks import broker_messages


class _Reader:
    def __init__(self):
        self.asked = {}

    def format(self, name):
        self.asked["format"] = name
        return self

    def option(self, key, value):
        self.asked[key] = str(value)
        return self

    def options(self, **options):
        self.asked.update(options)
        return self

    def load(self):
        return self.asked


def _session():
    return SimpleNamespace(read=_Reader(), readStream=_Reader())


BROKER = {"kafka.bootstrap.servers": "broker:9092", "kafka.security.protocol": "SSL"}


def test_bounded_read_of_a_broker():
    asked = read_topic(_session(), TopicSource(("a", "b"), options=BROKER))
    assert asked["format"] == "kafka" and asked["subscribe"] == "a,b"
    assert asked["kafka.security.protocol"] == "SSL"
    assert "startingOffsets" not in asked and "maxOffsetsPerTrigger" not in asked


def test_stream_of_a_broker_starts_at_the_latest_message():
    asked = stream_topic(_session(), TopicSource(pattern="t.*", options=BROKER))
    assert asked["startingOffsets"] == "latest" and asked["subscribePattern"] == "t.*"
    asked = stream_topic(_session(), TopicSource(("a",), options=BROKER), "earliest", max_per_trigger=9)
    assert asked["startingOffsets"] == "earliest" and asked["maxOffsetsPerTrigger"] == "9"


def test_messages_for_a_broker_are_bytes(spark):
    df = spark.createDataFrame([(7, b"\xff\x00", "own", 1)], "key int, value binary, topic string, n int")
    sent = broker_messages(df)
    assert sent.schema.simpleString() == "struct<key:binary,value:binary,topic:string>"
    assert tuple(sent.first()) == (b"7", b"\xff\x00", "own")
    assert broker_messages(df.select("value"), "t").first().asDict() == {
        "value": b"\xff\x00", "topic": "t",
    }


def test_remote_table_is_read_in_ranges():
    secret = {"user": "u", "password": "p", "driver": "some.Driver"}
    asked = scan_jdbc(_session(), "jdbc:x://h", "s.t", "id", 0, 10**9, 64, secret)
    assert asked["format"] == "jdbc" and asked["dbtable"] == "s.t" and asked["driver"] == "some.Driver"
    assert (asked["partitionColumn"], asked["lowerBound"], asked["upperBound"]) == ("id", "0", "1000000000")
    assert asked["numPartitions"] == "64" and asked["preferTimestampNTZ"] == "true"


@pytest.mark.parametrize("name", ["table", "a.b.c.d", "a..b", ".a", ""])
def test_table_names_have_two_or_three_parts(spark, name):
    with pytest.raises(ValueError, match="2 or 3 parts"):
        qualified_scan(spark, name)


def test_split_name():
    assert split_name("c.s.t") == ["c", "s", "t"] and split_name("s.t") == ["s", "t"]
    with pytest.raises(ValueError, match="3 parts"):
        split_name("s.t", 3)
