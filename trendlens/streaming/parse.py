"""Transport envelope -> typed message columns with event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from trendlens.functions.durations import stream_duration_seconds
from trendlens.functions.timefmt import event_time

DEFAULT_WATERMARK = "30 seconds"

# The message layout (ten text fields, four counts as doubles).
MESSAGE_SCHEMA = StructType([
    StructField("collected_at", StringType()),
    StructField("region_code", StringType()),
    StructField("video_id", StringType()),
    StructField("title", StringType()),
    StructField("published_at", StringType()),
    StructField("channel_id", StringType()),
    StructField("channel_title", StringType()),
    StructField("tags", StringType()),
    StructField("category_id", StringType()),
    StructField("view_count", DoubleType()),
    StructField("like_count", DoubleType()),
    StructField("dislike_count", DoubleType()),
    StructField("comment_count", DoubleType()),
    StructField("duration", StringType()),
])


def parse_messages(envelope: DataFrame, watermark: str | None = DEFAULT_WATERMARK,
                   schema: StructType = MESSAGE_SCHEMA) -> DataFrame:
    """``(key, value, timestamp)`` -> message fields + ``kafka_ts``,
    ``event_time`` (TIMESTAMP), ``duration_sec`` (BIGINT).

    JSON is parsed PERMISSIVE: malformed text gives NULL fields and the event
    time falls back to the transport time; a message without that too keeps a
    NULL event time, moves no watermark and enters no window. The watermark
    needs a TIMESTAMP (not TIMESTAMP_NTZ) column, hence the cast inside
    ``event_time``.

    The decoded fields leave through a generator of one row, so the not-NULL
    filter that a time window adds stays above the decoding, which would
    otherwise run a second time inside that filter.
    """
    fields = [F.col(f"m.{f.name}").alias(f.name) for f in schema.fields]
    parsed = (envelope
              .select(F.from_json(F.col("value").cast("string"), schema).alias("m"),
                      F.col("timestamp").cast("timestamp").alias("kafka_ts"))
              .select(F.inline(F.array(F.struct(
                  *fields, "kafka_ts",
                  event_time("m.collected_at", "kafka_ts").alias("event_time"),
                  stream_duration_seconds("m.duration").alias("duration_sec"))))))
    return parsed.withWatermark("event_time", watermark) if watermark else parsed
