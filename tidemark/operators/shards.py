"""How rows spread over shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hashed_shard(key: Column, shards: int) -> Column:
    """Shard of a hashed key field, by the first 32 bits of an MD5 of its text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(shards)).cast("int")


def shard_report(rows: DataFrame, shard: Column) -> DataFrame:
    """Rows per shard and their share of all rows, in percent.

    The window runs over one row per shard.
    """
    counts = rows.groupBy(shard.alias("shard")).agg(F.count("*").alias("rows"))
    total = F.sum("rows").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("share", F.col("rows") * 100.0 / total)


def lay_out(rows: DataFrame, path: str, hashed: str, sort_by: list[str], shards: int) -> None:
    """Write rows in one folder per shard, clustered and sorted by the key fields.

    Range partitioning uses all key fields, so one value of the hashed field
    that holds many rows is cut by the further fields.
    """
    placed = rows.withColumn("shard", hashed_shard(F.col(hashed), shards))
    (
        placed.repartitionByRange("shard", hashed, *sort_by)
        .sortWithinPartitions("shard", hashed, *sort_by)
        .write.partitionBy("shard")
        .mode("overwrite")
        .parquet(path)
    )
