"""As-of join: for each probe row the version valid at its time.

A version is valid from its own time, inclusive, until the next version of the
same key, exclusive.

Neither all pairs of a key nor all rows of a key ever meet in one task. Probe
times and versions are first reduced to distinct (key, time) points. Points are
cut along time at global quantiles, so the points of one key inside one piece
are at most about 1/pieces of all rows, however many rows the key holds. Inside
a piece a running "last version" answers each point; the last version before a
piece comes from a summary with one row per (key, piece). Probes then pick up
their answer by an equi-join on (key, time), which AQE can split.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_AT, _ROW, _ORD, _PROBE, _PIECE = "__at", "__row", "__ord", "__probe", "__piece"


def time_cuts(times: DataFrame, column: str, pieces: int) -> list[float]:
    """Approximate quantiles of a timestamp column in epoch microseconds.

    They only decide how evenly the work is cut, not the result.
    """
    micros = times.select(F.unix_micros(F.col(column).cast("timestamp")).cast("double").alias("t"))
    steps = [i / pieces for i in range(1, pieces)]
    return sorted(set(micros.approxQuantile("t", steps, 1 / (2 * pieces))))


def _with_piece(points: DataFrame, cuts: list[float]) -> DataFrame:
    if not cuts:
        return points.withColumn(_PIECE, F.lit(0))
    timed = points.withColumn("__t", F.unix_micros(F.col(_AT).cast("timestamp")).cast("double"))
    splits = [float("-inf"), *cuts, float("inf")]
    cut = Bucketizer(splits=splits, inputCol="__t", outputCol=_PIECE).transform(timed)
    return cut.withColumn(_PIECE, F.col(_PIECE).cast("int")).drop("__t")


def asof_join(
    probes: DataFrame,
    versions: DataFrame,
    keys: list[str],
    probe_time: str,
    version_time: str,
    how: str = "left",
    tie_order: Column | None = None,
    closed_by: Column | None = None,
    cuts: list[float] | None = None,
    pieces: int | None = None,
) -> DataFrame:
    """Add the other columns of the valid version to each probe row.

    ``tie_order`` decides between versions of one key and time (the greatest
    wins), ``closed_by`` marks a version that ends validity, such as a delete.
    ``cuts`` are the time cuts; by default they are measured with one pass over
    the two time columns. ``pieces`` is how finely a key is cut at most, by
    default once per shuffle partition.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    spark = probes.sparkSession
    payload = [c for c in versions.columns if c not in keys and c != version_time]
    closed = F.lit(False) if closed_by is None else F.coalesce(closed_by, F.lit(False))
    order = F.struct((F.lit(0) if tie_order is None else tie_order).alias("o"))

    has_keys = F.lit(True)
    for key in keys:
        has_keys = has_keys & F.col(key).isNotNull()
    version_points = versions.filter(has_keys & F.col(version_time).isNotNull()).select(
        *keys,
        F.col(version_time).alias(_AT),
        F.struct(
            closed.alias("closed"),
            F.col(version_time).alias("valid_from"),
            F.struct(*payload).alias("payload"),
        ).alias(_ROW),
        order.alias(_ORD),
        F.lit(False).alias(_PROBE),
    )
    probe_points = probes.filter(has_keys & F.col(probe_time).isNotNull()).select(
        *keys,
        F.col(probe_time).alias(_AT),
        F.lit(None).cast(version_points.schema[_ROW].dataType).alias(_ROW),
        F.lit(None).cast(version_points.schema[_ORD].dataType).alias(_ORD),
        F.lit(True).alias(_PROBE),
    )
    points = (
        probe_points.unionByName(version_points)
        .groupBy(*keys, _AT)
        .agg(F.max_by(_ROW, _ORD).alias(_ROW), F.max(_PROBE).alias(_PROBE))
    )
    if cuts is None:
        pieces = pieces or int(spark.conf.get("spark.sql.shuffle.partitions"))
        times = probe_points.select(_AT).unionByName(version_points.select(_AT))
        cuts = time_cuts(times, _AT, pieces) if pieces > 1 else []
    points = _with_piece(points, cuts)

    tail = points.groupBy(*keys, _PIECE).agg(
        F.max_by(_ROW, F.when(F.col(_ROW).isNotNull(), F.col(_AT))).alias("__tail"),
        F.max(_PROBE).alias("__any_probe"),
    )
    before = Window.partitionBy(*keys).orderBy(_PIECE).rowsBetween(Window.unboundedPreceding, -1)
    carried = tail.withColumn("__carry", F.last("__tail", ignorenulls=True).over(before)).filter(
        "__any_probe"
    ).select(*keys, _PIECE, "__carry")

    so_far = Window.partitionBy(*keys, _PIECE).orderBy(_AT).rowsBetween(Window.unboundedPreceding, 0)
    here = points.withColumn("__here", F.last(_ROW, ignorenulls=True).over(so_far)).filter(_PROBE)
    found = F.coalesce(F.col("__here"), F.col("__carry"))
    answers = (
        here.join(carried, [*keys, _PIECE], "left")
        .select(*keys, F.col(_AT).alias(probe_time), found.alias("__found"))
        .filter(F.col("__found").isNotNull() & ~F.col("__found.closed"))
        .select(*keys, probe_time, "__found.valid_from", "__found.payload.*")
    )
    return probes.join(answers, [*keys, probe_time], how)
