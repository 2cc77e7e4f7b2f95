"""The topic functions without a broker: which format and options they ask Spark for."""

from rillwork.sources import messages
from rillwork.streaming import jobs


class Recorder:
    """Stands in for readers and writers and keeps what is set on them."""

    def __init__(self):
        self.seen = {}
        self.read = self.readStream = self.write = self.writeStream = self

    def format(self, name):
        self.seen["format"] = name
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def options(self, **given):
        self.seen |= given
        return self

    def outputMode(self, mode):
        self.seen["mode"] = mode
        return self

    def trigger(self, **given):
        self.seen |= given
        return self

    def load(self):
        return self

    save = start = load


def test_batch_topics():
    read = messages.read_topic(Recorder(), "host:9092", "t", failOnDataLoss="false").seen
    assert read == {
        "format": "kafka", "kafka.bootstrap.servers": "host:9092", "subscribe": "t", "failOnDataLoss": "false",
    }
    written = Recorder()
    messages.write_topic(written, "host:9092", "t")
    assert written.seen == {"format": "kafka", "kafka.bootstrap.servers": "host:9092", "topic": "t"}


def test_streamed_topics():
    assert messages.stream_topic(Recorder(), "host:9092", "t").seen["startingOffsets"] == "earliest"
    sent = jobs.append_topic(Recorder(), "host:9092", "t", "/shared/cp").seen
    assert sent == {
        "mode": "append", "checkpointLocation": "/shared/cp", "format": "kafka",
        "kafka.bootstrap.servers": "host:9092", "topic": "t",
    }
