"""Kafka ends of the event stream; they need Spark's Kafka connector on the class path."""

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql.streaming import DataStreamReader

from footfall.contract import EVENT_GROUP, EVENT_TOPIC
from footfall.streaming.events import as_json_lines


def kafka_event_source(
    spark: SparkSession,
    servers: str,
    topic: str = EVENT_TOPIC,
    starting: str = "latest",
    group: str = EVENT_GROUP,
    max_per_batch: int | None = None,
) -> DataStreamReader:
    """Reader of a topic from now on; ``.load()`` gives rows for ``decode_events``.

    The query's checkpoint remembers the position; the group only names the consumer.  After a
    stop, ``max_per_batch`` messages at most are read per micro-batch (default: no limit).
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("groupIdPrefix", group)
    )
    return reader.option("maxOffsetsPerTrigger", max_per_batch) if max_per_batch else reader


def kafka_event_sink(events: DataFrame, servers: str, topic: str = EVENT_TOPIC) -> DataFrameWriter:
    """Writer of events to a topic as JSON; call ``.save()``."""
    return (
        as_json_lines(events)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
    )
