"""One decoding for all queries: messages are judged and landed once.

The landing query decodes each transport envelope, gives it a verdict, and appends
it to a table partitioned by verdict, through Spark's file sink: the files of a
batch count once its entry of the sink's log is committed, so a batch that is run
again after a crash leaves nothing twice. Every question then streams from the
``accepted`` partition, without decoding, and the other partitions are the side
table of rejected messages, raw bytes included.

Verdicts, the first that fits:

* ``malformed``: not one field can be read (no value, broken JSON, no object).
* ``untimed``: no transport time (so nothing bounds the stamp), or no event time.
* ``future``: the event time lies more than ``tolerance`` after the transport time.
* ``late``: it lies more than ``max_delay`` before the transport time.
* ``accepted``: all others. A single unreadable field is NULL, as in ``parse_messages``.

Accepted event times lie within ``max_delay`` before and ``tolerance`` after the
transport time. So a message of the year 9999 moves no watermark, and with
messages in transport order and a watermark of ``max_delay + tolerance`` no
accepted row is late for any window: messages in are rows used plus rows rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType, TimestampType

from trendlens.functions.durations import stream_duration_seconds
from trendlens.functions.timefmt import event_time
from trendlens.streaming.parse import DEFAULT_WATERMARK, MESSAGE_SCHEMA

DEFAULT_TOLERANCE = "5 minutes"
DEFAULT_MAX_DELAY = "1 day"
ACCEPTED = "accepted"
REASONS = ("malformed", "untimed", "future", "late")
# Two 64-bit hashes of key and value: a message's identity, however often it is delivered.
MESSAGE_ID = ("id_a", "id_b")

LANDED_SCHEMA = StructType([
    *MESSAGE_SCHEMA.fields, StructField("kafka_ts", TimestampType()), StructField("event_time", TimestampType()),
    StructField("duration_sec", LongType()), StructField("value", BinaryType()),
    *[StructField(c, LongType()) for c in MESSAGE_ID], StructField("verdict", StringType())])


def _interval(text: str) -> Column:
    return F.expr(f"INTERVAL {text}")


def judge_messages(envelope: DataFrame, tolerance: str = DEFAULT_TOLERANCE, max_delay: str = DEFAULT_MAX_DELAY) -> DataFrame:
    """``(key, value, timestamp)`` -> ``LANDED_SCHEMA``, static or streaming. The
    fields leave through a generator of one row, so each message is decoded once;
    ``value`` is kept for rejected messages only."""
    corrupt = StructField("_corrupt", StringType())
    schema = StructType([*MESSAGE_SCHEMA.fields, corrupt])
    fields = [F.col(f"m.{f.name}").alias(f.name) for f in MESSAGE_SCHEMA.fields]
    decoded = envelope.select(
        F.from_json(F.col("value").cast("string"), schema, {"columnNameOfCorruptRecord": "_corrupt"}).alias("m"),
        F.col("timestamp").cast("timestamp").alias("kafka_ts"), F.col("value").cast("binary").alias("value"),
        F.xxhash64("key", "value").alias("id_a"), F.xxhash64(F.lit(1), "key", "value").alias("id_b"))
    nothing = F.coalesce(*[F.col(f"m.{f.name}").cast("string") for f in MESSAGE_SCHEMA.fields]).isNull()
    read = decoded.select(F.inline(F.array(F.struct(
        *fields, "kafka_ts", event_time("m.collected_at", "kafka_ts").alias("event_time"),
        stream_duration_seconds("m.duration").alias("duration_sec"), "value", *MESSAGE_ID,
        (F.col("m").isNull() | (F.col("m._corrupt").isNotNull() & nothing)).alias("unreadable")))))
    verdict = (F.when(F.col("unreadable"), F.lit("malformed"))
               .when(F.col("kafka_ts").isNull() | F.col("event_time").isNull(), F.lit("untimed"))
               .when(F.col("event_time") > F.col("kafka_ts") + _interval(tolerance), F.lit("future"))
               .when(F.col("event_time") < F.col("kafka_ts") - _interval(max_delay), F.lit("late"))
               .otherwise(F.lit(ACCEPTED)))
    judged = read.withColumn("verdict", verdict)
    return judged.withColumn("value", F.when(F.col("verdict") != ACCEPTED, F.col("value"))).select(
        *[f.name for f in LANDED_SCHEMA.fields])


def messages_path(root: str) -> str:
    return f"{root.rstrip('/')}/messages"


def land_messages(envelope: DataFrame, root: str, trigger: dict | None = None, tolerance: str = DEFAULT_TOLERANCE,
                  max_delay: str = DEFAULT_MAX_DELAY) -> StreamingQuery:
    """Start the landing query of a stream of envelopes."""
    return (judge_messages(envelope, tolerance, max_delay).writeStream.format("parquet").outputMode("append")
            .partitionBy("verdict").option("path", messages_path(root))
            .option("checkpointLocation", f"{root.rstrip('/')}/checkpoints/messages")
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())


def landed_messages(spark: SparkSession, root: str, watermark: str | None = DEFAULT_WATERMARK,
                    files_per_trigger: int | None = None) -> DataFrame:
    """The accepted messages as a stream with the columns of ``parse_messages``
    (and their id), which every question takes as it is."""
    reader = spark.readStream.schema(LANDED_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    accepted = reader.parquet(messages_path(root)).where(F.col("verdict") == ACCEPTED).drop("verdict", "value")
    return accepted.withWatermark("event_time", watermark) if watermark else accepted


def rejected_messages(spark: SparkSession, root: str) -> DataFrame:
    """The side table: rejected messages with their reason and raw value."""
    landed = spark.read.schema(LANDED_SCHEMA).parquet(messages_path(root))
    return landed.where(F.col("verdict") != ACCEPTED).withColumnRenamed("verdict", "reason")


def each_once(messages: DataFrame) -> DataFrame:
    """Messages that were delivered more than once within the watermark, once.
    The ids leave the state as the watermark passes them, so the state holds what
    arrives within the delay. On a static frame it is a plain distinct by id."""
    if not messages.isStreaming:
        return messages.dropDuplicates(list(MESSAGE_ID))
    return messages.dropDuplicatesWithinWatermark(list(MESSAGE_ID))
