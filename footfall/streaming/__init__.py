from footfall.streaming.events import (
    as_json_lines, decode_events, deliver_events, event_rows, json_event_log, read_event_log,
    stamp_events,
)
from footfall.streaming.kafka import kafka_event_sink, kafka_event_source
from footfall.streaming.monitored import retry_failed, run_monitored_kpi
from footfall.streaming.visits import append_new_kpi, rebuild_kpi

__all__ = [
    "append_new_kpi",
    "as_json_lines",
    "decode_events",
    "deliver_events",
    "event_rows",
    "json_event_log",
    "kafka_event_sink",
    "kafka_event_source",
    "read_event_log",
    "rebuild_kpi",
    "retry_failed",
    "run_monitored_kpi",
    "stamp_events",
]
