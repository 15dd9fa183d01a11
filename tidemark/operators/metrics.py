"""Metric samples: labels, renaming, instant vectors and aggregation rules.

A sample is ``metric string, labels map<string,string>, value double, ts
timestamp``; a vector has ``eval_ts`` in place of ``ts``. A label that is
missing counts as the empty string, and an empty label is no label.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.once import with_once
from tidemark.functions.text import safe_metric_name


def label(name: str, labels: str = "labels") -> Column:
    return F.coalesce(F.col(labels)[name], F.lit(""))


@dataclass(frozen=True)
class Matcher:
    """One label condition; ``op`` is ``=``, ``!=``, ``=~`` or ``!~``."""

    label: str
    op: str
    text: str

    def condition(self) -> Column:
        value = label(self.label)
        whole = value.rlike(f"^(?:{self.text})$")
        return {"=": value == self.text, "!=": value != self.text, "=~": whole, "!~": ~whole}[self.op]


def compare(value: Column, op: str, other: Column | float) -> Column:
    other = other if isinstance(other, Column) else F.lit(float(other))
    return {
        "==": value == other,
        "!=": value != other,
        ">": value > other,
        "<": value < other,
        ">=": value >= other,
        "<=": value <= other,
    }[op]


def select_series(rows: DataFrame, metric: str, matchers: Sequence[Matcher] = ()) -> DataFrame:
    """Rows of one metric that satisfy all label conditions."""
    conditions = [F.col("metric") == metric, *[m.condition() for m in matchers]]
    return rows.filter(reduce(Column.__and__, conditions))


def include_metrics(rows: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Keep metrics whose whole name matches one of the patterns."""
    return rows.filter(F.col("metric").rlike("^(?:" + "|".join(patterns) + ")$"))


def promote_attributes(rows: DataFrame, names: Sequence[str], attributes: str = "attributes") -> DataFrame:
    """Turn the named resource attributes into labels, dots becoming underscores."""
    wanted = F.map_filter(attributes, lambda key, _: key.isin(*names))
    as_labels = F.transform_keys(wanted, lambda key, _: F.replace(key, F.lit("."), F.lit("_")))
    return rows.withColumn("labels", F.map_concat("labels", as_labels)).drop(attributes)


@dataclass(frozen=True)
class RenameRule:
    """A pattern over a bean attribute; ``$n`` in name and label texts are its groups."""

    pattern: str
    name: str
    labels: dict[str, str] = field(default_factory=dict)


def _filled(template: str, text: Column, pattern: str) -> Column:
    """A template with ``$n`` replaced by the groups of ``pattern`` in ``text``."""
    parts, rest = [], template
    while "$" in rest:
        before, _, rest = rest.partition("$")
        digits = len(rest) - len(rest.lstrip("0123456789"))
        if before:
            parts.append(F.lit(before))
        parts.append(F.regexp_extract(text, pattern, int(rest[:digits])))
        rest = rest[digits:]
    if rest:
        parts.append(F.lit(rest))
    return F.concat(*parts)


def rename_metrics(
    rows: DataFrame,
    rules: Sequence[RenameRule],
    bean: str = "bean",
    order: str = "as_given",
) -> DataFrame:
    """Add ``metric`` and ``labels`` by the first rule whose pattern occurs in ``bean``.

    ``order='most_specific_first'`` tries rules with more literal text first,
    since an early general rule hides later special ones.
    Rows that no rule matches are dropped. Names are made safe and lower-cased.
    """
    if order not in ("as_given", "most_specific_first"):
        raise ValueError("order must be 'as_given' or 'most_specific_first'")
    if order == "most_specific_first":
        rules = sorted(rules, key=lambda r: -len(re.sub(r"\([^)]*\)", "", r.pattern)))
    text = F.col(bean)
    outcome = F.lit(None).cast("struct<metric: string, labels: map<string, string>>")
    for rule in reversed(rules):
        pattern = f"^.*(?:{rule.pattern}).*$"
        pairs = [
            part
            for name, value in rule.labels.items()
            for part in (safe_metric_name(F.lit(name)), _filled(value, text, pattern))
        ]
        labels = F.create_map(*pairs) if pairs else F.create_map()
        result = F.struct(
            safe_metric_name(_filled(rule.name, text, pattern)).alias("metric"),
            labels.cast("map<string,string>").alias("labels"),
        )
        outcome = F.when(text.rlike(pattern), result).otherwise(outcome)
    return with_once(rows, "__r", outcome, drop_null=True).select(
        *rows.columns, F.col("__r.metric").alias("metric"), F.col("__r.labels").alias("labels")
    )


def series_key(labels: Column | str) -> Column:
    """Labels in one canonical, groupable form: sorted pairs without empty values."""
    return F.array_sort(F.filter(F.map_entries(labels), lambda e: e["value"] != ""))


def instant_vector(
    samples: DataFrame,
    step_seconds: int = 60,
    lookback_seconds: int = 300,
    end: Column | None = None,
    closed_left: bool = False,
) -> DataFrame:
    """The newest sample per series at every evaluation time of a regular grid.

    A sample at ``t`` is visible at grid times ``g`` with ``g - lookback < t <=
    g`` (``<=`` on both sides with ``closed_left``). Samples are reduced to the
    newest per series and step before they are spread over the grid, so a
    series costs at most lookback/step rows per step, however often it was
    sampled. ``end`` bounds the grid.
    """
    step, lookback = step_seconds * 1_000_000, lookback_seconds * 1_000_000
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    first = (F.ceil(F.col("at") / step) * step).cast("bigint")
    newest = (
        samples.select("metric", series_key("labels").alias("series"), "value", at.alias("at"))
        .groupBy("metric", "series", first.alias("first"))
        .agg(F.max_by("value", "at").alias("value"), F.max("at").alias("at"))
    )
    edge = F.col("at") + lookback - (0 if closed_left else 1)
    last = (F.floor(edge / step) * step).cast("bigint")
    if end is not None:
        last = F.least(last, F.unix_micros(end.cast("timestamp")))
    spread = newest.filter(F.col("first") <= last).withColumn(
        "eval", F.explode(F.sequence(F.col("first"), last, F.lit(step)))
    )
    return (
        spread.groupBy("metric", "series", "eval")
        .agg(F.max_by("value", "at").alias("value"))
        .select(
            "metric",
            F.map_from_entries("series").alias("labels"),
            "value",
            F.timestamp_micros("eval").alias("eval_ts"),
        )
    )


@dataclass(frozen=True)
class RecordingRule:
    """``agg by (by) (metric{matchers} [keep])``, or over ``max by (inner_by)`` first."""

    record: str
    metric: str
    by: tuple[str, ...]
    agg: str = "sum"
    matchers: tuple[Matcher, ...] = ()
    keep: tuple[str, float] | None = None
    inner_by: tuple[str, ...] | None = None

    def condition(self) -> Column | None:
        """Which samples of the metric count; None for all."""
        conditions = [m.condition() for m in self.matchers]
        if self.keep:
            conditions.append(compare(F.col("value"), *self.keep))
        return reduce(Column.__and__, conditions) if conditions else None


def evaluate_rules(vector: DataFrame, rules: Sequence[RecordingRule]) -> DataFrame:
    """All rules at all evaluation times: ``record, labels, value, eval_ts``.

    The vector is read once. Each row is repeated for the rules of its metric,
    and one aggregation (two for sums of maxima) serves every rule; partial sums
    are formed before the shuffle, so a large group costs no more than a small.
    """
    numbers = range(len(rules))
    names = sorted({name for rule in rules for name in (*rule.by, *(rule.inner_by or ()))})
    of_metric = {m: [i for i in numbers if rules[i].metric == m] for m in {rule.metric for rule in rules}}

    def chosen(test) -> Column:
        return F.col("rule").isin([i for i in numbers if test(rules[i])])

    def grouping(by) -> list[Column]:
        """One column per label name, null for rules that do not group by it."""
        return [F.when(chosen(lambda rule: name in by(rule)), F.col(name)).alias(name) for name in names]

    counts = F.lit(True)
    for i in numbers:
        condition = rules[i].condition()
        if condition is not None:
            counts = counts & ((F.col("rule") != i) | condition)
    applicable = F.create_map(
        *[part for m, ids in of_metric.items() for part in (F.lit(m), F.array(*[F.lit(i) for i in ids]))]
    )
    inner = (
        vector.filter(F.col("metric").isin(*of_metric))
        .select("eval_ts", "value", "labels", F.explode(applicable[F.col("metric")]).alias("rule"))
        .filter(counts)
        .select("eval_ts", "value", "rule", *[F.nullif(F.col("labels")[name], F.lit("")).alias(name) for name in names])
        .select("eval_ts", "value", "rule", *grouping(lambda rule: rule.inner_by or rule.by))
        .groupBy("rule", "eval_ts", *names)
        .agg(F.sum("value").alias("total"), F.max("value").alias("top"), F.count("value").alias("n"))
    )
    value = (
        F.when(chosen(lambda rule: rule.inner_by is not None), F.col("top"))
        .when(chosen(lambda rule: rule.agg == "count"), F.col("n").cast("double"))
        .otherwise(F.col("total"))
    )
    outer = (
        inner.select("rule", "eval_ts", value.alias("value"), *grouping(lambda rule: rule.by))
        .groupBy("rule", "eval_ts", *names)
        .agg(F.sum("value").alias("value"))
    )
    pairs = F.array(*[F.struct(F.lit(name).alias("key"), F.col(name).alias("value")) for name in names])
    labels = F.map_from_entries(F.filter(pairs, lambda pair: pair["value"].isNotNull())) if names else F.create_map()
    records = F.array(*[F.lit(rule.record) for rule in rules])
    return outer.select(
        records[F.col("rule")].alias("record"),
        labels.cast("map<string,string>").alias("labels"),
        "value",
        "eval_ts",
    )


def count_by_count(vector: DataFrame, metric: str, by: Sequence[str]) -> DataFrame:
    """``count(count by (...) (metric))``: the number of distinct label groups."""
    values = [label(name).alias(f"l{i}") for i, name in enumerate(by)]
    groups = select_series(vector, metric).select("eval_ts", *values).distinct()
    return groups.groupBy("eval_ts").agg(F.count("*").cast("double").alias("value"))


def offset_join(
    vector: DataFrame,
    metric: str,
    op: str,
    offset_seconds: int,
    ignoring: Sequence[str] = (),
    labels: str = "matched",
    step_seconds: int | None = None,
) -> DataFrame:
    """``metric op ignoring(...) metric offset d``: keep samples that compare true.

    Matching is one-to-one on the labels that are not ignored; if two series
    fall together the job fails, as the expression would. The result carries
    those matched labels, or with ``labels='left'`` all labels of the left side.
    An offset between two steps would match nothing; ``step_seconds`` checks it.
    """
    if step_seconds and offset_seconds % step_seconds:
        raise ValueError("the offset must be a multiple of the step")
    if labels not in ("matched", "left"):
        raise ValueError("labels must be 'matched' or 'left'")
    kept = F.map_filter("labels", lambda key, _: ~key.isin(*ignoring)) if ignoring else F.col("labels")
    one = (
        select_series(vector, metric)
        .groupBy(series_key(kept).alias("m"), "eval_ts")
        .agg(
            F.count("*").alias("n"),
            F.first("value").alias("value"),
            F.first(series_key("labels")).alias("own"),
        )
    )
    message = F.lit(f"several series of {metric} share all labels but the ignored ones")
    one = one.withColumn("value", F.when(F.col("n") == 1, F.col("value")).otherwise(F.raise_error(message)))
    past = one.select(
        "m",
        (F.col("eval_ts") + F.make_dt_interval(secs=F.lit(offset_seconds))).alias("eval_ts"),
        F.col("value").alias("past"),
    )
    result = F.col("m") if labels == "matched" else F.col("own")
    return (
        one.join(past, ["m", "eval_ts"])
        .filter(compare(F.col("value"), op, F.col("past")))
        .select(F.lit(metric).alias("metric"), F.map_from_entries(result).alias("labels"), "value", "eval_ts")
    )
