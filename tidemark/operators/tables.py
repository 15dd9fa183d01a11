"""Keyed changes to a table that has one row per key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import excerpt
from tidemark.operators.fold import latest_per_key


def upsert(table: DataFrame, changes: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Rows of ``changes`` (the last per key) replace or extend ``table``.

    Only keys and changed rows meet the table; when the changes are small, AQE
    broadcasts their keys and the table is not shuffled.
    """
    newest = latest_per_key(changes, keys, order).select(*table.columns)
    kept = table.join(newest.select(*keys), keys, "left_anti")
    return kept.unionByName(newest)


def delete_keys(table: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``table`` whose key is not among ``gone``."""
    return table.join(gone.select(*keys).distinct(), keys, "left_anti")


def verify_written(written: DataFrame, table: DataFrame, key: str = "_id", document: str = "document") -> DataFrame:
    """Look every written key up again: ``found`` and an excerpt of what is stored."""
    stored = table.select(key, F.lit(True).alias("found"), excerpt(F.col(document)).alias("excerpt"))
    checked = written.select(key).distinct().join(stored, key, "left")
    return checked.withColumn("found", F.coalesce("found", F.lit(False)))


def append_rows(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def apply_changes(
    table: DataFrame, changes: DataFrame, keys: list[str], order: Column | str, deleted: Column
) -> DataFrame:
    """Upserts and deletes in one pass: the last change per key decides, and ``deleted`` removes the row."""
    newest = latest_per_key(changes.withColumn("__gone", deleted), keys, order)
    kept = table.join(newest.select(*keys), keys, "left_anti")
    return kept.unionByName(newest.filter(~F.coalesce("__gone", F.lit(False))).select(*table.columns))


def merge_statement(table: str, staging: str, columns: list[str], key: str, deleted: str | None = None) -> str:
    """SQL that moves a staged batch into a keyed database table.

    ``deleted`` names a boolean column of the staged rows that asks for the
    removal of the row; it is not a column of the table.
    """
    columns = [c for c in columns if c != deleted]
    names = ", ".join(columns)
    sets = ", ".join(f"{c} = s.{c}" for c in columns if c != key)
    values = ", ".join(f"s.{c}" for c in columns)
    gone = f"WHEN MATCHED AND s.{deleted} THEN DELETE " if deleted else ""
    new = f"WHEN NOT MATCHED AND NOT s.{deleted}" if deleted else "WHEN NOT MATCHED"
    return (
        f"MERGE INTO {table} t USING {staging} s ON t.{key} = s.{key} {gone}"
        f"WHEN MATCHED THEN UPDATE SET {sets} "
        f"{new} THEN INSERT ({names}) VALUES ({values})"
    )


def upsert_jdbc(
    rows: DataFrame,
    url: str,
    table: str,
    key: str,
    execute: Callable[[str], None],
    properties: dict[str, str] | None = None,
    batch_rows: int = 10_000,
    deleted: str | None = None,
) -> None:
    """Stage a batch in ``<table>_staging`` from all executors, then merge it once.

    ``execute`` runs one statement on the database through the caller's own
    connection; Spark's JDBC writer can only insert.
    """
    staging = f"{table}_staging"
    options = {"batchsize": str(batch_rows), "truncate": "true", **(properties or {})}
    rows.write.mode("overwrite").jdbc(url, staging, properties=options)
    execute(merge_statement(table, staging, rows.columns, key, deleted))
