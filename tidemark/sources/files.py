"""Text files: logs, keyed lines, dumps; and finds over documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import extended_json


@dataclass(frozen=True)
class LogJob:
    """A path pattern and the labels every line of it gets."""

    path: str
    labels: Mapping[str, str]


# The standing collection jobs.
LOG_JOBS = (
    LogJob("/var/log/*log", {"job": "varlogs"}),
    LogJob("/var/lib/docker/containers/*/*log", {"job": "dockerlogs"}),
    LogJob("/var/log/mongodb/mongod.log", {"job": "mongologs"}),
    LogJob("/var/log/result/*.log", {"job": "resultlogs"}),
)
NODE_LOG_JOBS = (
    LogJob("/var/log/mongodb/mongod.log", {"service_name": "mongolog", "job": "mongolog"}),
    LogJob("/var/log/result/*.log", {"service_name": "resultlog", "job": "resultlog"}),
)


def with_labels(lines: DataFrame, labels: Mapping[str, Column | str]) -> DataFrame:
    """Attach a label map to lines."""
    pairs = [
        part
        for name, value in labels.items()
        for part in (F.lit(name), value if isinstance(value, Column) else F.lit(value))
    ]
    return lines.withColumn("labels", F.create_map(*pairs))


def _labelled(lines: DataFrame, job: LogJob) -> DataFrame:
    return with_labels(lines.select("value", F.col("_metadata.file_path").alias("path")), job.labels)


def _all(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def collect_logs(spark: SparkSession, jobs: Sequence[LogJob]) -> DataFrame:
    """Lines of all jobs: ``value, path, labels``."""
    return _all([_labelled(spark.read.text(job.path, lineSep="\n"), job) for job in jobs])


def stream_logs(spark: SparkSession, jobs: Sequence[LogJob]) -> DataFrame:
    """As a stream; which files were read is kept in the query's checkpoint."""
    return _all([_labelled(spark.readStream.text(job.path, lineSep="\n"), job) for job in jobs])


def keyed_lines(lines: DataFrame, separator: str = "|") -> DataFrame:
    """Split ``key<separator>value`` at the first separator.

    ``key`` and ``value`` are null where there is none; see ``unkeyed``.
    """
    at = F.instr("line", separator)
    split = lines.withColumnRenamed("value", "line")
    key = F.when(at > 0, F.substring("line", F.lit(1), at - 1))
    value = F.when(at > 0, F.substring("line", at + len(separator), F.length("line")))
    return split.select(
        *[c for c in split.columns if c != "line"], key.alias("key"), value.alias("value"), "line"
    )


def keyed(split: DataFrame) -> DataFrame:
    return split.filter(F.col("key").isNotNull()).drop("line")


def unkeyed(split: DataFrame) -> DataFrame:
    return split.filter(F.col("key").isNull()).select("line")


def read_dump(lines: DataFrame, ddl: str | None = None) -> DataFrame:
    """Shell-dump lines as extended JSON text, or typed by ``ddl``."""
    fixed = lines.withColumn("value", extended_json(F.col("value")))
    if ddl is None:
        return fixed
    return fixed.select(F.from_json("value", ddl).alias("d")).select("d.*")


def find(
    documents: DataFrame,
    where: Column,
    fields: Sequence[str],
    newest_first: str,
    unique: str = "_id",
) -> DataFrame:
    """Filter, project and sort descending, missing values last.

    The unique field as second sort key lets Spark's range partitioning cut
    through rows that share the first.
    """
    order = [F.col(newest_first).desc_nulls_last(), F.col(unique).asc()]
    return documents.filter(where).orderBy(*order).select(*fields)
