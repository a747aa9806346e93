"""Progress events: typed rows, their JSON form, and streams of them."""

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from footfall.contract import EVENT_SCHEMA

EventSink = Callable[[DataFrame], None]


def event_rows(spark: SparkSession, events: Sequence[dict]) -> DataFrame:
    """Events (a handful, as dicts) as stamped rows."""
    text = F.lit(json.dumps(events))
    parsed = F.from_json(text, T.ArrayType(EVENT_SCHEMA))
    return stamp_events(spark.range(0, 1, 1, 1).select(F.inline(parsed)))


def stamp_events(events: DataFrame) -> DataFrame:
    """Set ``timestamp`` to the current time in UTC, whatever the session's time zone, where an event
    has no time of its own."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")
    return events.withColumn("timestamp", F.coalesce("timestamp", now))


def as_json_lines(events: DataFrame) -> DataFrame:
    """One text column ``value``; fields an event does not have are left out."""
    options = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    return events.select(F.to_json(F.struct("*"), options).alias("value"))


def decode_events(messages: DataFrame, schema: T.StructType = EVENT_SCHEMA,
                  unreadable: str | None = None) -> DataFrame:
    """Typed rows from a ``value`` column of UTF-8 JSON; what cannot be read is NULL.

    With ``unreadable``, a last column of that name keeps the whole text of every message that
    is no JSON object of these types; it is NULL for all others.
    """
    if unreadable is None:
        return messages.select(
            F.from_json(F.col("value").cast("string"), schema).alias("event")).select("event.*")
    fields = T.StructType([*schema.fields, T.StructField(unreadable, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": unreadable}
    return messages.select(
        F.from_json(F.col("value").cast("string"), fields, options).alias("event")
    ).select("event.*")


def json_event_log(path: str) -> EventSink:
    """A sink that appends events to a folder of JSON lines."""
    return lambda events: as_json_lines(events).write.mode("append").text(path)


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    return decode_events(spark.read.text(path))


def deliver_events(
    events: DataFrame, target: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Append a stream of decoded events to a Parquet folder, each exactly once.

    Runs until stopped, or with ``available_now`` until all present input is delivered.
    """
    writer = (
        events.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
