"""Lookup tables in a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_state_table(
    spark: SparkSession,
    url: str,
    table: str,
    ranges: list[str],
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A current-state table ``(_id, document)``, read once per batch.

    ``ranges`` are WHERE conditions that split the table, one task each; without
    a split one task would read all of it, so they must be given.
    """
    if not ranges:
        raise ValueError("ranges must split the table; use ['1 = 1'] for a table that fits one task")
    return spark.read.jdbc(url, table, predicates=ranges, properties=properties)
