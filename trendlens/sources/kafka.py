"""K5: the transport source. Operators only need ``(key, value, timestamp)``;
this sets the options of Spark's Kafka source (its jar must be on the
classpath)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_source(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "latest", fail_on_data_loss: bool = False) -> DataFrame:
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .option("failOnDataLoss", str(fail_on_data_loss).lower())
            .load()
            .select("key", "value", "timestamp"))
