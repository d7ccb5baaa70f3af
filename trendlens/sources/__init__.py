from trendlens.sources.canonical import (
    observations,
    raw_observations,
    stream_history,
    stream_messages,
    text_observations,
)
from trendlens.sources.files import read_observations, read_raw_csv, write_bucketed, write_observations, write_result
from trendlens.sources.kafka import kafka_source
from trendlens.sources.replay import ENVELOPE_SCHEMA, land_as_stream, replay_stream
from trendlens.sources.tables import read_table

__all__ = [
    "observations", "raw_observations", "stream_history", "stream_messages", "text_observations",
    "read_observations", "read_raw_csv", "write_bucketed", "write_observations", "write_result",
    "kafka_source", "ENVELOPE_SCHEMA", "land_as_stream", "replay_stream", "read_table",
]
