"""Sharding by jump consistent hashing.

A row's shard follows from its key and the number of shards alone (law ``key``): the published
generator draws ever later shards at which the key would jump, and the last one below the shard count
holds it. One more shard therefore takes rows only into itself. No ring table is kept or shipped.

Everything is columns; 64-bit products that wrap are put together from 32-bit halves, so that the
result does not depend on ANSI mode.

Defined cases: a null key counts as key 0; a null text has size 1 and the checksum of no bytes; rows
that agree in every column are told apart by their slot only; an output column replaces an input column
of the same name; a very long text counts with all its bytes; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import scratch

# The generator's multiplier, as in the published algorithm.
MULTIPLIER = 2862933555777941757
_LOW = 0xFFFFFFFF


def _advance(high: Column, low: Column) -> tuple[Column, Column]:
    """state * MULTIPLIER + 1 modulo 2^64, as two 32-bit halves."""
    top, bottom = MULTIPLIER >> 32, MULTIPLIER & _LOW

    def wrapped(value: Column, factor: int) -> Column:
        upper = F.shiftleft((value * (factor >> 16)).bitwiseAND(0xFFFF), 16)
        return value * (factor & 0xFFFF) + upper

    middle = F.shiftright(low, 16) * bottom
    first = (low.bitwiseAND(0xFFFF)) * bottom + F.shiftleft(middle.bitwiseAND(0xFFFF), 16) + 1
    carry = F.shiftright(first, 32) + F.shiftright(middle, 16)
    return (carry + wrapped(high, bottom) + wrapped(low, top)).bitwiseAND(_LOW), first.bitwiseAND(_LOW)


def jump_hash(key: Column, shards: int) -> Column:
    """The shard in [0, shards) of an integer key."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))

    def state(high: Column, low: Column, held: Column, ahead: Column) -> Column:
        return F.struct(
            high.cast("long").alias("high"),
            low.cast("long").alias("low"),
            held.cast("long").alias("held"),
            ahead.cast("long").alias("ahead"),
        )

    def step(now: Column, _: Column) -> Column:
        high, low = _advance(now["high"], now["low"])
        ahead = ((now["ahead"] + 1) * (F.lit(float(1 << 31)) / (F.shiftright(high, 1) + 1))).cast("long")
        return F.when(now["ahead"] >= shards, now).otherwise(state(high, low, now["ahead"], ahead))

    def run(start: Column, steps: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)

    # Each step passes at least one shard and about doubles the place, so a short
    # run almost always ends; the long one is evaluated only where it did not.
    start = state(F.shiftrightunsigned(key, 32), key.bitwiseAND(_LOW), F.lit(-1), F.lit(0))
    short = run(start, min(shards, 48))
    if shards > 48:
        short = F.when(short["ahead"] >= shards, short).otherwise(run(short, shards))
    return short["held"].cast("int")


def with_shards(rows: DataFrame, key: str, shards: int, shard: str = "shard", grown: str | None = None) -> DataFrame:
    """Add the shard and, if named, the shard after one more has been appended."""
    out = rows.withColumn(shard, jump_hash(F.col(key), shards))
    return out.withColumn(grown, jump_hash(F.col(key), shards + 1)) if grown else out


def number_slots(rows: DataFrame, shard: str = "shard", slot: str = "slot", pieces_bits: int = 10) -> DataFrame:
    """Add a gapless number from 0 within each shard.

    Slots follow a hash of the row, so a shard is cut into 2^pieces_bits pieces that are numbered apart;
    only the row count of each piece crosses pieces. Equal rows are counted before they are shuffled and
    spread out at the end, so a row repeated any number of times is no hot group. The numbers do not
    depend on ``pieces_bits``.
    """
    columns = rows.columns
    code, piece, copies, first = "__code", "__piece", "__copies", "__first"
    counted = (
        rows.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias(copies))
        .withColumn(code, F.xxhash64(*columns))
        .withColumn(piece, F.shiftrightunsigned(F.col(code), 64 - pieces_bits).cast("int"))
    )
    counted = scratch.keep(counted, "slots")
    before = Window.partitionBy(shard).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        counted.groupBy(shard, piece)
        .agg(F.sum(copies).alias("__rows"))
        .select(shard, piece, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    )
    # The code is unsigned by its top bits and signed here: any total order within a piece will do.
    within = Window.partitionBy(shard, piece).orderBy(code, *columns).rowsBetween(Window.unboundedPreceding, -1)
    numbered = counted.withColumn(first, F.coalesce(F.sum(copies).over(within), F.lit(0)))
    return (
        numbered.join(starts, [shard, piece])
        .select(
            *columns,
            F.explode(
                F.sequence(
                    F.col("__start") + F.col(first), F.col("__start") + F.col(first) + F.col(copies) - 1
                )
            ).alias(slot),
        )
    )


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and the shard under one more shard."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = with_shards(rows, "doc_id", shards, grown="grown_shard")
    return number_slots(placed).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
