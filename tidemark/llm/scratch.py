"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tidemark
from tidemark import session

_shipped: list[SparkContext] = []


def keep(rows: DataFrame, label: str, parts: int | None = None) -> DataFrame:
    """Write rows once and read them back: a lost executor costs no recomputation.

    ``parts`` is for results of a shuffle whose size is known: no more files than the rows need.
    """
    path = session.scratch_dir(rows.sparkSession, label)
    rows = rows if parts is None else rows.coalesce(parts)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def prepare(spark: SparkSession) -> SparkSession:
    """Settings, and this package's code for the Python workers, which may not have it installed."""
    session.configure(spark)
    # Tables here are kept files of known size, which the planner may judge.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    # A batch is held by the JVM, by the worker, and once more as Python objects; the default of 64 MB is a lot of texts.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")
    if spark.sparkContext not in _shipped:
        root = Path(tidemark.__file__).parent
        packed = Path(tempfile.mkdtemp(prefix="code-"), "tidemark-code.zip")
        with zipfile.ZipFile(packed, "w") as archive:
            for source in sorted(root.rglob("*.py")):
                archive.write(source, Path(root.name, source.relative_to(root)))
        spark.sparkContext.addPyFile(str(packed))
        _shipped.append(spark.sparkContext)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def by_keys(rows: DataFrame, keys: DataFrame, names: list[str], how: str, sent: int = 2_000_000) -> DataFrame:
    """Semi or anti join that leaves wide rows where they are if the keys, by count, are few enough to send.

    ``keys`` should be a kept table; beyond ``sent`` keys both sides are shuffled.
    """
    return rows.join(F.broadcast(keys) if keys.count() <= sent else keys, names, how)
