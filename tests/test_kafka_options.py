import json

import pytest

from ledgerline.sources.kafka import kafka_options, kafka_write_options


def test_subscribe_earliest():
    o = kafka_options("b:9092", topic="posts")
    assert o["subscribe"] == "posts" and o["startingOffsets"] == "earliest"
    assert "assign" not in o


def test_assign_and_seek():
    o = kafka_options("b:9092", topic="posts", partitions=[7, 3], starting={3: 23, 7: 0}, max_offsets_per_trigger=100)
    assert json.loads(o["assign"]) == {"posts": [3, 7]}
    assert json.loads(o["startingOffsets"]) == {"posts": {"3": 23, "7": 0}}
    assert o["maxOffsetsPerTrigger"] == "100"


def test_rejects_bad_specs():
    with pytest.raises(ValueError):
        kafka_options("", topic="posts")
    with pytest.raises(ValueError):
        kafka_options("b:9092", topic="posts", starting="middle")
    with pytest.raises(ValueError):
        kafka_options("b:9092")


def test_write_options():
    assert kafka_write_options("b:9092", "posts") == {"kafka.bootstrap.servers": "b:9092", "topic": "posts"}


def test_more_reader_options():
    o = kafka_options("b:9092", topic="posts", starting="latest", ending={0: 100}, min_partitions=64,
                      fail_on_data_loss=False, group_id_prefix="ingest")
    assert o["startingOffsets"] == "latest"
    assert json.loads(o["endingOffsets"]) == {"posts": {"0": 100}}
    assert o["minPartitions"] == "64" and o["failOnDataLoss"] == "false" and o["groupIdPrefix"] == "ingest"
