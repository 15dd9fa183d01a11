"""Hard negatives against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import gnat

VECTORS = "vec_id long, embedding array<float>, label int, anchor long, v string"


def brute(rows, divisor, scale=256):
    taken = {}
    for vec_id, vector, label, *_ in rows:
        if vec_id is None or vector is None or label is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        ints = [int(np.floor(scale * np.float64(np.float32(x)))) for x in vector]
        taken[vec_id] = min(taken.get(vec_id, (label, ints)), (label, ints))
    dims = max((len(v) for _, v in taken.values()), default=0)
    ids = list(taken)
    matrix = [taken[i][1] + [0] * (dims - len(taken[i][1])) for i in ids]
    out = []
    for a, anchor in enumerate(ids):
        if anchor % divisor:
            continue
        scored = sorted((-sum(x * y for x, y in zip(matrix[a], matrix[b], strict=True)), i) for b, i in enumerate(ids) if i != anchor)
        label = taken[anchor][0]
        for score, positive in [s for s in scored if taken[s[1]][0] == label][:5]:
            ps = -score
            fit = [(-s, i) for s, i in scored if taken[i][0] != label and 50 * ps <= -100 * s <= 95 * ps][:3]
            out += [(anchor, positive, rank, i, ps, s) for rank, (s, i) in enumerate(fit, 1)]
    return sorted(out)


def got(spark, rows, divisor):
    vectors = gnat.prepared(spark.createDataFrame(rows, VECTORS).repartition(3))
    frame = gnat.hard_negatives(vectors, F.col("vec_id") % divisor == 0)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert frame.columns == names
    return sorted(tuple(r) for r in frame.collect())


def rows_of(n, dims, seed, spread=0.3):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, dims))
    out = []
    for i in range(n):
        vector = centres[draw.integers(6)] + spread * draw.normal(size=dims)
        out.append((i, [float(x) for x in vector / np.linalg.norm(vector)], int(draw.integers(4)), 1, "x"))
    return out


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(gnat, "BLOCK", 40)
    monkeypatch.setattr(gnat, "QUERIES", 7)
    monkeypatch.setattr(gnat, "SAMPLE", 400)
    monkeypatch.setattr(gnat, "LEAST", 8)


def test_equals_brute_force(spark, small):
    rows = rows_of(900, 5, 1)
    rows += [(5000 + i, rows[3][1], i % 4, 1, "x") for i in range(120)]  # a group of copies
    rows += [(None, rows[1][1], 1, 1, "x"), (6000, None, 1, 1, "x"), (6001, [0.1, None, 0.2, 0.0, 0.0], 1, 1, "x")]
    rows += [(6002, [float("nan")] * 5, 1, 1, "x"), (6003, [float("inf")] * 5, 1, 1, "x"), (6004, rows[2][1], None, 1, "x")]
    rows += [(6010, [], 2, 1, "x"), (6020, [0.5], 1, 1, "x"), (6030, [1.0] * 5, 3, 1, "x"), (6040, [-1.0] * 5, 3, 1, "x")]
    rows += [(0, rows[5][1], 0, 1, "x"), (0, rows[0][1], 3, 1, "x"), (-10, rows[9][1], 1, 1, "x"), (6050, [0.0] * 5, 2, 1, "x")]
    assert got(spark, rows, 10) == brute(rows, 10)


def test_large_components(spark, small):
    rows = [(i, [float(x) * 1e5 for x in v], k, a, b) for i, v, k, a, b in rows_of(150, 4, 2)]
    assert got(spark, rows, 10) == brute(rows, 10)


def test_no_label_twice_and_one_label(spark):
    rows = rows_of(30, 3, 4)
    assert got(spark, [(i, v, i, a, b) for i, v, _, a, b in rows], 5) == []
    assert got(spark, [(i, v, 1, a, b) for i, v, _, a, b in rows], 5) == []


def test_empty(spark):
    assert got(spark, [], 5) == []
    assert got(spark, [(7, [1.0], 1, 1, "x")], 5) == []
