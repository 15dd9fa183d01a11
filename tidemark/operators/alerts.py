"""Alerts: a condition that holds for a while.

Input vectors lie on a regular evaluation grid, so a series has at most one
row per step and a window over one series is bounded by the time range, not by
the number of samples.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.metrics import Matcher, compare, offset_join, series_key


@dataclass(frozen=True)
class AlertRule:
    """``metric{matchers} op threshold``, or compared with its own past by ``offset_seconds``."""

    name: str
    metric: str
    op: str
    threshold: float | None
    for_seconds: int
    severity: str
    matchers: tuple[Matcher, ...] = ()
    offset_seconds: int | None = None
    ignoring: tuple[str, ...] = ()
    summary: str = ""
    description: str = ""


def _holds(rule: AlertRule) -> Column:
    conditions = [F.col("metric") == rule.metric, *[m.condition() for m in rule.matchers]]
    return reduce(Column.__and__, [*conditions, compare(F.col("value"), rule.op, rule.threshold)])


def active_series(vector: DataFrame, rules: Sequence[AlertRule]) -> DataFrame:
    """Samples for which the condition of a rule holds: ``alert, series, value, eval_ts``.

    All threshold rules share one pass over the vector; a rule over its own
    past needs a join of its own.
    """
    simple = [rule for rule in rules if rule.offset_seconds is None]
    parts = []
    if simple:
        names = F.array(*[F.when(_holds(rule), F.lit(rule.name)) for rule in simple])
        metrics = sorted({rule.metric for rule in simple})
        parts.append(
            vector.filter(F.col("metric").isin(*metrics)).select(
                F.explode(F.array_compact(names)).alias("alert"), series_key("labels").alias("series"), "value", "eval_ts"
            )
        )
    for rule in rules:
        if rule.offset_seconds is not None:
            changed = offset_join(vector, rule.metric, rule.op, rule.offset_seconds, rule.ignoring)
            parts.append(
                changed.select(F.lit(rule.name).alias("alert"), series_key("labels").alias("series"), "value", "eval_ts")
            )
    return reduce(DataFrame.unionByName, parts)


def streaks(active: DataFrame, step_seconds: int, by: Sequence[str] = ("labels",)) -> DataFrame:
    """Unbroken runs of grid steps per series.

    Columns: the series, ``starts_at``, ``last_active``, ``steps`` and the
    ``value`` at the last step. Within a run, step number minus row number is
    constant.
    """
    step = (F.unix_seconds(F.col("eval_ts").cast("timestamp")) / step_seconds).cast("bigint")
    order = Window.partitionBy(*by).orderBy("eval_ts")
    return (
        active.select(*by, "eval_ts", "value", (step - F.row_number().over(order)).alias("run"))
        .groupBy(*by, "run")
        .agg(
            F.min("eval_ts").alias("starts_at"),
            F.max("eval_ts").alias("last_active"),
            F.count("*").alias("steps"),
            F.max_by("value", "eval_ts").alias("value"),
        )
        .drop("run")
    )


def merge_runs(runs: DataFrame, step_seconds: int, by: Sequence[str]) -> DataFrame:
    """Join runs of a series that touch (the next starts one step after the last ends).

    Used to continue the open runs of an earlier batch.
    """
    order = Window.partitionBy(*by).orderBy("starts_at")
    step = F.make_dt_interval(secs=F.lit(step_seconds))
    opens = F.coalesce(F.col("starts_at") > F.lag("last_active").over(order) + step, F.lit(True))
    return (
        runs.withColumn("opens", opens.cast("int"))
        .withColumn("part", F.sum("opens").over(order))
        .groupBy(*by, "part")
        .agg(
            F.min("starts_at").alias("starts_at"),
            F.max("last_active").alias("last_active"),
            F.sum("steps").alias("steps"),
            F.max_by("value", "last_active").alias("value"),
        )
        .drop("part")
    )


def with_state(
    runs: DataFrame, for_seconds: Column | int, as_of: Column, step_seconds: int, close_after_seconds: int = 60
) -> DataFrame:
    """Add ``fired_at``, ``ends_at`` and ``state`` as seen at ``as_of``.

    A run fires at the first step at least ``for_seconds`` after its start. It
    is over once it was not renewed for ``close_after_seconds``. A run that
    ended before firing has the state ``inactive``.
    """
    waits = for_seconds if isinstance(for_seconds, Column) else F.lit(for_seconds)
    steps = F.ceil(waits / step_seconds)
    fires = F.col("starts_at") + F.make_dt_interval(secs=steps * step_seconds)
    fired = fires <= F.col("last_active")
    closes = F.col("last_active") + F.make_dt_interval(secs=F.lit(close_after_seconds))
    over = closes <= as_of
    state = (
        F.when(over & fired, "resolved").when(over, "inactive").when(fired, "firing").otherwise("pending")
    )
    return (
        runs.withColumn("fired_at", F.when(fired, fires))
        .withColumn("ends_at", F.when(over, closes))
        .withColumn("state", state)
    )


def number_text(value: Column) -> Column:
    """A sample value as template text: whole numbers without a fraction."""
    whole = (value == F.floor(value)) & (F.abs(value) < 1e15)
    return F.when(whole, value.cast("bigint").cast("string")).otherwise(value.cast("string"))


_PLACEHOLDER = re.compile(r"\{\{\s*\$(value|labels\.(\w+))\s*\}\}")


def annotation(template: str) -> Column:
    """A text with ``{{ $value }}`` and ``{{ $labels.x }}`` filled in; a missing label is empty."""
    parts, at = [], 0
    for hit in _PLACEHOLDER.finditer(template):
        parts.append(F.lit(template[at : hit.start()]))
        name = hit.group(2)
        parts.append(F.coalesce(F.col("labels")[name], F.lit("")) if name else number_text(F.col("value")))
        at = hit.end()
    return F.concat(*parts, F.lit(template[at:]))


def _by_rule(rules: Sequence[AlertRule], value) -> Column:
    """A value that depends on the rule of the row."""
    chosen = F.when(F.lit(False), value(rules[0]))
    for rule in rules:
        chosen = chosen.when(F.col("alert") == rule.name, value(rule))
    return chosen


def rule_states(
    runs: DataFrame, rules: Sequence[AlertRule], as_of: Column, step_seconds: int, close_after_seconds: int = 60
) -> DataFrame:
    """``with_state`` for runs of several rules, each with its own waiting time."""
    waits = _by_rule(rules, lambda rule: F.lit(rule.for_seconds))
    return with_state(runs, waits, as_of, step_seconds, close_after_seconds)


def described(states: DataFrame, rules: Sequence[AlertRule]) -> DataFrame:
    """Alerts with severity and texts; runs that ended before they fired are no alerts."""
    return (
        states.filter(F.col("state") != "inactive")
        .withColumn("labels", F.map_from_entries("series"))
        .select(
            "alert",
            "labels",
            _by_rule(rules, lambda rule: F.lit(rule.severity)).alias("severity"),
            "value",
            "state",
            "starts_at",
            "fired_at",
            "ends_at",
            _by_rule(rules, lambda rule: annotation(rule.summary)).alias("summary"),
            _by_rule(rules, lambda rule: annotation(rule.description)).alias("description"),
        )
    )


def evaluate_alerts(
    vector: DataFrame,
    rules: Sequence[AlertRule],
    as_of: Column,
    step_seconds: int = 60,
    close_after_seconds: int = 60,
) -> DataFrame:
    """All alerts of the rules up to ``as_of``, past ones included."""
    runs = streaks(active_series(vector, rules), step_seconds, ["alert", "series"])
    return described(rule_states(runs, rules, as_of, step_seconds, close_after_seconds), rules)
