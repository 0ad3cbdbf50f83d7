"""Streaming readers. Files everywhere; Kafka with Avro payloads where the connector jars are deployed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])

# Topics, their partitions, and the records taken per poll.
TOPICS = {"user_actions": "user.action.v1", "inventory_events": "product.inventory.v1",
          "notifications": "notification.push.v1"}
TOPIC_PARTITIONS = {"user.action.v1": 12, "product.inventory.v1": 3, "notification.push.v1": 6}
MAX_POLL_RECORDS = 500
DEAD_LETTER_SUFFIX = ".dlq"


def read_files(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of a parquet file or folder; new files become new micro-batches."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def read_topic(spark: SparkSession, servers: str, topic: str, avro_schema: str,
               max_offsets: int | None = None) -> DataFrame:
    """Decoded records of a Kafka topic. Needs the Kafka and Avro connectors on the class path."""
    from pyspark.sql.avro.functions import from_avro

    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", "earliest"))
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(
        F.col("key").cast("string").alias("record_key"), "partition", "offset",
        from_avro("value", avro_schema).alias("record")).select("record_key", "partition", "offset", "record.*")


def as_records(rows: DataFrame, key: str) -> DataFrame:
    """Key/value records of a topic sink: JSON payload, keyed so that one user's records keep their order."""
    return rows.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*rows.columns)).alias("value"))


def publish(rows: DataFrame, key: str, servers: str, topic: str, checkpoint: str):
    """Streaming write of `rows` to a Kafka topic, keyed by `key`."""
    return (as_records(rows, key).writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("checkpointLocation", checkpoint).start())
