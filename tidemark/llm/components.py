"""Connected components of a graph held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import scratch


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _hung(pairs: DataFrame, towards: str, parts: int) -> DataFrame:
    """Every neighbour v of u is linked to the least of u and its neighbours.

    The least is combined before the shuffle and joined back, so a node with very many links is split
    like any skewed join partition.
    """
    least = scratch.keep(pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least", parts)
    hung = pairs.join(least, "u")
    out = hung.where("v > u") if towards == "larger" else hung
    out = out.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if towards == "smaller":
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return scratch.keep(out.where("u > v").distinct(), "links", parts)


def label(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, label) with the least id of the component, for ids that are not least themselves.

    Large and small stars alternate until the links no longer change; then each is (node, least node).
    """
    now = scratch.keep(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "links",
    )
    before = _state(now)
    parts = 1 + before[0] // 250_000  # links never become more
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        now = _hung(_hung(both, "larger", parts), "smaller", parts)
        after = _state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("id"), F.col("v").alias("label"))
