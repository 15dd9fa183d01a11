"""As-of joins: boundaries, and random data against a direct search."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.asof import asof_join

T0 = datetime(2024, 1, 1)
PROBES = "pid int, k string, pt timestamp"
VERSIONS = "k string, vt timestamp, vid int, gone boolean"


def at(seconds):
    return None if seconds is None else T0 + timedelta(seconds=seconds)


def frames(spark, probes, versions):
    return (
        spark.createDataFrame([(p, k, at(t)) for p, k, t in probes], PROBES),
        spark.createDataFrame([(k, at(t), v, g) for k, t, v, g in versions], VERSIONS),
    )


def answers(joined):
    return {row["pid"]: row["vid"] for row in joined.collect()}


def search(probes, versions, closing=False):
    found = {}
    for pid, k, t in probes:
        valid = [(vt, vid, gone) for vk, vt, vid, gone in versions if vk == k and None not in (k, t) and vt <= t]
        best = max(valid, default=None)
        found[pid] = None if best is None or (closing and best[2]) else best[1]
    return found


def test_boundaries(spark):
    probes = [(1, "a", 10), (2, "a", 9), (3, "a", 19), (4, "a", 20), (5, "b", 10), (6, None, 10), (7, "a", None), (8, "a", 30)]
    versions = [("a", 10, 100, False), ("a", 20, 200, False), ("a", 20, 201, False), ("a", 30, 300, True)]
    p, v = frames(spark, probes, versions)
    joined = asof_join(p, v, ["k"], "pt", "vt", tie_order=F.col("vid"), closed_by=F.col("gone"))
    assert answers(joined) == {1: 100, 2: None, 3: 100, 4: 201, 5: None, 6: None, 7: None, 8: None}
    inner = asof_join(p, v, ["k"], "pt", "vt", "inner", tie_order=F.col("vid"), closed_by=F.col("gone"))
    assert answers(inner) == {1: 100, 3: 100, 4: 201}
    assert {r["pid"]: r["valid_from"] for r in inner.collect()}[3] == at(10)


@pytest.mark.parametrize("pieces", [1, 4, 40])
def test_random_with_one_hot_key(spark, pieces):
    rng = random.Random(pieces)

    def key():
        return "hot" if rng.random() < 0.5 else f"k{rng.randint(0, 8)}"

    probes = [(i, key(), rng.randint(0, 300)) for i in range(600)]
    versions = [(key(), rng.randint(0, 300), i, rng.random() < 0.2) for i in range(150)]
    p, v = frames(spark, probes, versions)
    cuts = [1e6 * (T0 - datetime(1970, 1, 1)).total_seconds() + 1e6 * 300 * i / pieces for i in range(1, pieces)]
    joined = asof_join(
        p, v, ["k"], "pt", "vt", tie_order=F.col("vid"), closed_by=F.col("gone"), cuts=cuts
    )
    assert answers(joined) == search(probes, versions, closing=True)


def test_measured_cuts(spark):
    probes = [(i, "k", i) for i in range(100)]
    versions = [("k", 10 * i, i, False) for i in range(10)]
    p, v = frames(spark, probes, versions)
    assert answers(asof_join(p, v, ["k"], "pt", "vt")) == {i: i // 10 for i in range(100)}


def test_empty_sides(spark):
    p, v = frames(spark, [], [("k", 1, 1, False)])
    assert asof_join(p, v, ["k"], "pt", "vt").count() == 0
    p, v = frames(spark, [(1, "k", 1)], [])
    assert answers(asof_join(p, v, ["k"], "pt", "vt")) == {1: None}


def test_other_join_kinds_are_refused(spark):
    p, v = frames(spark, [], [])
    with pytest.raises(ValueError):
        asof_join(p, v, ["k"], "pt", "vt", how="outer")


def test_more_pieces_than_any_ceiling(spark):
    probes = [(i, "k", i) for i in range(1200)]
    versions = [("k", 3 * i, i, False) for i in range(400)]
    p, v = frames(spark, probes, versions)
    joined = asof_join(p, v, ["k"], "pt", "vt", pieces=600)
    assert answers(joined) == {i: i // 3 for i in range(1200)}
