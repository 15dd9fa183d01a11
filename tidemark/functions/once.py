"""Evaluating a costly expression once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(rows: DataFrame, name: str, value: Column, drop_null: bool = False) -> DataFrame:
    """Add a column that is evaluated exactly once per row.

    The optimizer copies an ordinary computed column into each filter and
    projection that uses it, and generated code may put it off until after a
    join has multiplied the rows, so a JSON text would be handled many times.
    The output of a generator is neither copied nor put off. ``drop_null`` also drops rows whose
    value is null.
    """
    single = F.array(value)
    return rows.select("*", F.explode(F.array_compact(single) if drop_null else single).alias(name))
