"""Event streams: Kafka or folders of JSON lines in, keyed JSON messages out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Columns that say where a message stood: at the broker, or in files by time of arrival.
BROKER_POSITION = ["partition", "offset"]
FILE_POSITION = ["source_time", "source_file", "source_start"]


def read_kafka(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Needs the Kafka connector package on the class path."""
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    } | options
    return spark.readStream.format("kafka").options(**settings).load()


def read_event_files(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """The same ``value`` column from JSON-lines files that land in a folder.

    A micro-batch may hold several files, which Spark reads by size and not by age; so each
    message carries the time and name of its file, and the block it stands in.
    """
    lines = (
        spark.readStream.format("text")
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(folder)
    )
    return lines.select(
        "value",
        F.col("_metadata.file_modification_time").alias("source_time"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("source_start"),
    )


def publish_frame(events: DataFrame) -> DataFrame:
    """Messages keyed by shipment, so one shipment's events stay in one partition."""
    body = F.struct(*[F.col(name) for name in events.columns])
    return events.select(F.col("shipment_id").alias("key"), F.to_json(body).alias("value"))


def publish_kafka(events: DataFrame, servers: str, topic: str, **options: str) -> None:
    settings = {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "3",
        "kafka.linger.ms": "10",
        "kafka.compression.type": "gzip",
    } | options
    publish_frame(events).write.format("kafka").options(**settings).save()
