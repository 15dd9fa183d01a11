"""Reading ordered logs: topics and files of the same record shape."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import schemas

OFFSETS_PER_BATCH = 10_000_000
RECORD_COLUMNS = ["key", "value", "topic", "partition", "offset", "timestamp"]


def topic_options(
    servers: str,
    topic: str,
    group: str | None = None,
    client: Mapping[str, str] | None = None,
    starting: str = "earliest",
    **extra: str,
) -> dict[str, str]:
    """Options of the Kafka source; ``client`` holds security and other client properties."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        # Tell apart log truncation from a normal end of data.
        "failOnDataLoss": "true",
    }
    if group:
        options["kafka.group.id"] = group
    options.update({f"kafka.{name}": value for name, value in (client or {}).items()})
    options.update(extra)
    return options


def _records(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        *RECORD_COLUMNS[2:],
    )


def stream_topic(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """A topic as a stream of log records, metadata columns included.

    A batch takes at most ``OFFSETS_PER_BATCH`` records unless the options say
    otherwise: from the earliest offset on, the first one would else be all of the log.
    """
    bounded = {"maxOffsetsPerTrigger": str(OFFSETS_PER_BATCH), **options}
    return _records(spark.readStream.format("kafka").options(**bounded).load())


def replay_topic(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """The whole retained log as one batch, to rebuild state from the beginning."""
    return _records(spark.read.format("kafka").options(**options).load())


def stream_log_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of log records as a stream."""
    reader = spark.readStream.schema(schemas.LOG_RECORD)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def replay_log_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LOG_RECORD).parquet(path)

