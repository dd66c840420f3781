import json

from weirstone.sources import batch_options, stream_options


def test_batch_options():
    got = batch_options("b:1", "t", {"t": {0: 5, 1: -2}}, min_partitions=64)
    assert got == {
        "kafka.bootstrap.servers": "b:1",
        "subscribe": "t",
        "startingOffsets": '{"t":{"0":5,"1":-2}}',
        "endingOffsets": "latest",
        "failOnDataLoss": "false",
        "minPartitions": "64",
    }
    text = '{"t":{"0":1}}'
    got = batch_options("b", "t", text, {"t": {0: -1, 1: -1, 2: -1}}, fail_on_data_loss=True)
    assert got["startingOffsets"] == text
    assert json.loads(got["endingOffsets"]) == {"t": {"0": -1, "1": -1, "2": -1}}
    assert got["failOnDataLoss"] == "true" and "minPartitions" not in got


def test_stream_options():
    got = stream_options("b:1", "t", max_offsets_per_trigger=100)
    assert got["maxOffsetsPerTrigger"] == "100" and got["startingOffsets"] == "earliest"
    assert "endingOffsets" not in got
