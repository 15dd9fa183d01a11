"""Event-time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_ms(raw: Column) -> Column:
    """A date given as text, either epoch milliseconds or ISO-8601, to epoch milliseconds."""
    return F.coalesce(raw.try_cast("bigint"), F.unix_millis(raw.try_cast("timestamp")))


def from_epoch_ms(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def to_epoch_ms(moment: Column) -> Column:
    """Epoch milliseconds of a timestamp with or without time zone (UTC session)."""
    return F.unix_millis(moment.cast("timestamp"))


def resolve_event_ms(wall_ms: Column, cluster_seconds: Column, now: Column | None = None) -> Column:
    """Wall time, else cluster time in seconds, else now."""
    fallback = F.current_timestamp() if now is None else now
    return F.coalesce(wall_ms, cluster_seconds * F.lit(1000), to_epoch_ms(fallback))


def latency_ms(start: Column, now: Column | None = None) -> Column:
    """Whole milliseconds from ``start`` to now; 0 when ``start`` is null."""
    end = F.current_timestamp() if now is None else now
    elapsed = F.timestamp_diff("MILLISECOND", start.cast("timestamp"), end.cast("timestamp"))
    return F.coalesce(elapsed, F.lit(0).cast("bigint"))
