"""Judging a transaction by the period of its keyword."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import from_epoch_ms, latency_ms

# The result texts.
MISSING = "Missing keyword period"
NOT_STARTED = "Keyword period not yet started"
EXPIRED = "Keyword period expired"
ELIGIBLE = "ELIGIBLE"


def with_reason(redeems: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Add ``reason`` from ``start_period`` and ``end_period`` (epoch ms)."""
    now = F.current_timestamp() if as_of is None else as_of
    start, end = F.col("start_period"), F.col("end_period")
    reason = (
        F.when(start.isNull() | end.isNull(), MISSING)
        .when(now < from_epoch_ms(start), NOT_STARTED)
        .when(now > from_epoch_ms(end), EXPIRED)
        .otherwise(ELIGIBLE)
    )
    return redeems.withColumn("reason", reason)


def with_latency(rows: DataFrame, start: str = "kafka_timestamp", now: Column | None = None) -> DataFrame:
    """All columns plus the milliseconds since ``start``."""
    return rows.withColumn("latency_ms", latency_ms(F.col(start), now))
