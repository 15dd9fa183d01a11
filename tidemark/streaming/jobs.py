"""The standing stream jobs. Each is its batch operator, run per micro-batch."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import alerts, eligibility, fold, lookup, metrics
from tidemark.sources.envelope import accepted, parse_changes, parse_redeems, rejected
from tidemark.streaming import state
from tidemark.streaming.io import SAMPLE_DELAY, drop_batch, start_batches, write_batch
from tidemark.streaming.store import Store


def materialize_changes(
    records: DataFrame,
    path: str,
    checkpoint: str,
    rejects: str | None = None,
    order: Column | str | None = None,
    removal: str = "intended",
    continuous: bool = False,
) -> StreamingQuery:
    """Change log to the entry table at ``path``; see ``fold.state_from_entries`` to read it."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        events = parse_changes(batch, order)
        if not rejects:
            fold.write_entries(accepted(events), path, batch_id, removal)
            return
        events = events.persist()  # parsed once for both
        try:
            fold.write_entries(accepted(events), path, batch_id, removal)
            write_batch(rejected(events), rejects, batch_id)
        finally:
            events.unpersist()

    return start_batches(records, apply, checkpoint, continuous)


def maintain_state(
    records: DataFrame,
    path: str,
    checkpoint: str,
    order: Column | str | None = None,
    removal: str = "intended",
    every: int = 6,
    continuous: bool = False,
    buckets: int = 64,
) -> StreamingQuery:
    """Change log, with all four operations, to a table of documents; ``state.current`` reads it.

    ``every`` batches (a minute of the usual trigger) the documents of changed buckets are renewed.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        events = accepted(parse_changes(batch, order))
        state.add_batch(batch.sparkSession, path, events, batch_id, every, removal, buckets)

    return start_batches(records, apply, checkpoint, continuous)


def _newest(keys: list[str]):
    return lambda rows, last: fold.latest_per_key(rows, keys, F.col("__order"))


def upsert_rows(
    rows: DataFrame, path: str, checkpoint: str, keys: list[str], order: Column, continuous: bool = False, buckets: int = 64
) -> StreamingQuery:
    """Keep the last row per key in a store of key buckets; ``latest_rows`` reads the table."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        ordered = batch.withColumn("__order", order)
        table = Store(batch.sparkSession, path, keys, _newest(keys), buckets)
        table.commit(batch_id, fold.latest_per_key(ordered, keys, F.col("__order")).select(*ordered.columns))

    return start_batches(rows, apply, checkpoint, continuous)


def latest_rows(spark, path: str, keys: list[str], tombstone: Column | None = None) -> DataFrame:
    rows = Store(spark, path, keys, _newest(keys)).read()
    return fold.latest_per_key(rows, keys, F.col("__order"), tombstone).drop("__order")


def enrich_redeems(
    records: DataFrame,
    read_lookup: Callable[[], DataFrame],
    path: str,
    checkpoint: str,
    mode: str = "documents_only",
    event_columns: list[str] | None = None,
    continuous: bool = False,
) -> StreamingQuery:
    """Redeem records to outgoing messages. The lookup is read anew for every batch."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        events = accepted(parse_redeems(batch))
        found = lookup.matched(lookup.enrich(events, read_lookup()))
        write_batch(lookup.message(found, mode, event_columns), path, batch_id)

    return start_batches(records, apply, checkpoint, continuous)


def judge_redeems(
    records: DataFrame,
    read_keywords: Callable[[], DataFrame],
    path: str,
    checkpoint: str,
    as_of: Column | None = None,
    continuous: bool = False,
    keyed: bool = False,
    now: Column | None = None,
) -> StreamingQuery:
    """Redeem records to eligibility rows with their latency, by the keywords of the moment.

    ``keyed`` writes them as JSON key and value for an upsert sink. ``as_of`` is the moment of the
    judgement and ``now`` that of the latency, both the clock's by default.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        redeems = lookup.redeem_periods(accepted(parse_redeems(batch)), read_keywords())
        judged = eligibility.with_latency(eligibility.with_reason(redeems, as_of), now=now)
        columns = ["transaction_id", "keyword", "start_period", "end_period", "kafka_timestamp", "reason", "latency_ms"]
        judged = judged.select(*columns)
        if keyed:
            judged = lookup.keyed_message(judged.drop("kafka_timestamp"), "transaction_id")
        write_batch(judged, path, batch_id)

    return start_batches(records, apply, checkpoint, continuous)


def step_values(samples: DataFrame, step_seconds: int, delay: str = SAMPLE_DELAY) -> DataFrame:
    """The newest sample per series and step, once no later sample is accepted.

    ``eval_ts`` is the end of the step. A sample exactly on a step's end counts
    to that step, so the windows are shifted by one microsecond.
    """
    tick = F.make_dt_interval(secs=F.lit(0.000001))
    shifted = samples.withColumn("ts", F.col("ts") - tick).withWatermark("ts", delay)
    return (
        shifted.groupBy(
            F.window("ts", f"{step_seconds} seconds").alias("w"),
            "metric",
            metrics.series_key("labels").alias("series"),
        )
        .agg(F.max_by("value", "ts").alias("value"))
        .select(
            "metric",
            F.map_from_entries("series").alias("labels"),
            "value",
            F.col("w.end").alias("eval_ts"),
        )
    )


def open_steps(samples: DataFrame, step_seconds: int, delay: str = SAMPLE_DELAY) -> DataFrame:
    """What ``step_values`` has kept back when a bounded stream ends, in batch from its stored samples.

    These are the steps that end after the last watermark; none of their samples has been refused as late.
    """
    tick = F.make_dt_interval(secs=F.lit(0.000001))
    newest = samples.agg(F.unix_millis(F.max(F.col("ts") - tick))).first()[0]
    watermark = F.timestamp_millis(F.lit(newest).cast("long")) - F.expr(f"interval {delay}")
    return step_values(samples, step_seconds, delay).filter(F.col("eval_ts") > watermark)


def _seen_at(samples: DataFrame, step_seconds: int, lookback_seconds: int, closed_left: bool) -> DataFrame:
    """Samples repeated for each evaluation time of the grid that may still see them."""
    step, lookback = step_seconds * 1_000_000, lookback_seconds * 1_000_000
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    first = (F.ceil(at / step) * step).cast("bigint")
    last = (F.floor((at + lookback - (0 if closed_left else 1)) / step) * step).cast("bigint")
    return (
        samples.select("metric", metrics.series_key("labels").alias("series"), "value", at.alias("at"), first.alias("first"), last.alias("last"))
        .filter("first <= last")
        .select("metric", "series", "value", "at", F.explode(F.sequence("first", "last", F.lit(step))).alias("eval"))
        .select("metric", "series", "value", "at", F.timestamp_micros("eval").alias("eval_ts"))
    )


def _seconds(delay: str) -> int:
    """Length of an interval such as "10 minutes"."""
    number, unit = delay.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}[unit.rstrip("s")]


def stream_vector(
    samples: DataFrame, step_seconds: int = 60, lookback_seconds: int = 300, delay: str = SAMPLE_DELAY, closed_left: bool = False
) -> DataFrame:
    """``metrics.instant_vector`` of a stream: each step once, when no sample that it may see is accepted any more.

    A sample is held for every step that may see it, until a newer one of its series takes its place or the watermark
    passes the step. So a series whose samples stop is repeated until the look-back ends, and a batch puts out whole
    steps. The state is (delay + 2 * look-back) / step rows per series at most; repeated samples of a series
    and step are combined before the shuffle. The watermark runs on evaluation times, which are up to one
    look-back ahead of their samples, and allows for that.
    """
    seen = _seen_at(samples, step_seconds, lookback_seconds, closed_left)
    return (
        seen.withWatermark("eval_ts", f"{_seconds(delay) + lookback_seconds} seconds")
        .groupBy("metric", "series", "eval_ts")
        .agg(F.max_by("value", "at").alias("value"))
        .select("metric", F.map_from_entries("series").alias("labels"), "value", "eval_ts")
    )


def open_vector(
    samples: DataFrame, step_seconds: int = 60, lookback_seconds: int = 300, delay: str = SAMPLE_DELAY, closed_left: bool = False
) -> DataFrame:
    """The steps that ``stream_vector`` has kept back when a bounded stream ends, in batch from its stored samples."""
    newest = _seen_at(samples, step_seconds, lookback_seconds, closed_left).agg(F.unix_millis(F.max("eval_ts"))).first()[0]
    length = _seconds(delay) + lookback_seconds
    watermark = F.timestamp_millis(F.lit(newest).cast("long") - length * 1000)
    # Samples that no open step can see are left out before the aggregation.
    recent = samples.filter(F.col("ts") >= watermark - F.make_dt_interval(secs=F.lit(lookback_seconds)))
    vector = metrics.instant_vector(recent, step_seconds, lookback_seconds, closed_left=closed_left)
    return vector.filter(F.col("eval_ts") > watermark)


def record_rules(
    vector: DataFrame,
    rules: Sequence[metrics.RecordingRule],
    path: str,
    checkpoint: str,
    continuous: bool = False,
) -> StreamingQuery:
    """Evaluate recording rules on finished steps."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        write_batch(metrics.evaluate_rules(batch, rules), path, batch_id)

    return start_batches(vector, apply, checkpoint, continuous)


_RUN = ("alert", "series")


def _active(batch: DataFrame, ring: DataFrame | None, rules: Sequence[alerts.AlertRule]) -> DataFrame:
    """Samples of the batch for which a rule holds; rules over their own past also see the ring of past values."""
    past = [rule for rule in rules if rule.offset_seconds is not None]
    now = [rule for rule in rules if rule.offset_seconds is None]
    parts = [alerts.active_series(batch, now)] if now else []
    if past:
        seen = batch if ring is None else batch.unionByName(ring)
        found = alerts.active_series(seen, past)
        parts.append(found.join(batch.select("eval_ts").distinct(), "eval_ts", "left_semi").select(*_RUN, "value", "eval_ts"))
    return reduce(DataFrame.unionByName, parts)


def _continued(
    batch: DataFrame,
    before: DataFrame | None,
    ring: DataFrame | None,
    rules: Sequence[alerts.AlertRule],
    step_seconds: int,
    close_after_seconds: int,
) -> DataFrame:
    """Runs of the batch, continuing the open runs of ``before``, with their state as of the newest step."""
    runs = alerts.streaks(_active(batch, ring, rules), step_seconds, _RUN)
    now = batch.agg(F.max("eval_ts")).first()[0]
    if before is not None:
        runs = alerts.merge_runs(runs.unionByName(before.select(*runs.columns)), step_seconds, _RUN)
        if now is None:
            now = before.agg(F.max("as_of")).first()[0]
    as_of = F.lit(now).cast("timestamp")
    return alerts.rule_states(runs, rules, as_of, step_seconds, close_after_seconds).withColumn("as_of", as_of)


def _reach(rules: Sequence[alerts.AlertRule]) -> dict[str, int]:
    """How far back the values of a metric are needed, in seconds."""
    far: dict[str, int] = {}
    for rule in rules:
        if rule.offset_seconds is not None:
            far[rule.metric] = max(far.get(rule.metric, 0), rule.offset_seconds)
    return far


def _ring(rows: DataFrame, rules: Sequence[alerts.AlertRule]) -> DataFrame:
    """Values that a rule may still compare with: of each metric those within its offset of the newest step."""
    newest = rows.agg(F.max("eval_ts")).first()[0]
    keep = F.lit(False)
    for metric, seconds in _reach(rules).items():
        edge = F.lit(newest).cast("timestamp") - F.make_dt_interval(secs=F.lit(seconds))
        keep = keep | ((F.col("metric") == metric) & (F.col("eval_ts") > edge))
    return rows.filter(keep)


def watch(
    vector: DataFrame,
    rules: alerts.AlertRule | Sequence[alerts.AlertRule],
    path: str,
    checkpoint: str,
    step_seconds: int,
    close_after_seconds: int = 60,
    continuous: bool = False,
) -> StreamingQuery:
    """Alert runs of all rules over finished steps, each batch holding whole steps after those before it.

    The state is one open run per rule and series, and for rules over their own past a ring of the values within
    their offset. Per batch, the runs of the batch continue the open runs of the one before. Closed runs go to
    ``<path>/closed``, open ones to ``<path>/open`` and the ring to ``<path>/ring``; each batch has its own folder,
    so a repeated batch starts from the same state. Open runs and rings older than two batches are dropped.
    """
    rules = [rules] if isinstance(rules, alerts.AlertRule) else list(rules)

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark, before, ring = batch.sparkSession, None, None
        if batch_id > 0:
            before = spark.read.parquet(f"{path}/open/batch={batch_id - 1}")
            ring = spark.read.parquet(f"{path}/ring/batch={batch_id - 1}") if _reach(rules) else None
        states = _continued(batch, before, ring, rules, step_seconds, close_after_seconds).persist()
        try:
            is_open = F.col("state").isin("pending", "firing")
            write_batch(states.filter(F.col("state") == "resolved").drop("as_of"), f"{path}/closed", batch_id)
            write_batch(states.filter(is_open), f"{path}/open", batch_id)
        finally:
            states.unpersist()
        if _reach(rules):
            seen = batch.select("metric", "labels", "value", "eval_ts")
            write_batch(_ring(seen if ring is None else seen.unionByName(ring), rules), f"{path}/ring", batch_id)
        for name in ("open", "ring"):
            drop_batch(spark, f"{path}/{name}", batch_id - 2)

    return start_batches(vector, apply, checkpoint, continuous, reused=True)


def _last(spark, path: str) -> DataFrame:
    """The rows of the last batch, told by its files: a batch without rows has one too."""
    stored = spark.read.parquet(path)
    newest = max(int(re.search(r"/batch=(\d+)/", name).group(1)) for name in stored.inputFiles())
    return stored.filter(F.col("batch") == newest).drop("batch")


def watched(spark, path: str) -> DataFrame:
    """All closed runs and the runs that are open after the last batch."""
    closed = spark.read.parquet(f"{path}/closed").drop("batch")
    return closed.unionByName(_last(spark, f"{path}/open").drop("as_of"))


def watched_to_end(
    remainder: DataFrame,
    rules: alerts.AlertRule | Sequence[alerts.AlertRule],
    path: str,
    step_seconds: int,
    close_after_seconds: int = 60,
) -> DataFrame:
    """``watched`` after a bounded stream has ended, continued over the steps it has kept back (``open_steps``)."""
    rules = [rules] if isinstance(rules, alerts.AlertRule) else list(rules)
    spark = remainder.sparkSession
    ring = _last(spark, f"{path}/ring") if _reach(rules) else None
    states = _continued(remainder, _last(spark, f"{path}/open"), ring, rules, step_seconds, close_after_seconds).drop("as_of")
    states = states.filter(F.col("state").isin("pending", "firing", "resolved"))
    return spark.read.parquet(f"{path}/closed").drop("batch").unionByName(states)
