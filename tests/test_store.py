"""Bucketed tables of many small writes, and the two-sided as-of join that keeps its state in them."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof, fold
from tidemark.streaming import io, state
from tidemark.streaming.store import Store
from tidemark.streaming.versions import VersionedJoin

T0 = datetime(2024, 1, 1)


def newest(rows, last):
    return fold.latest_per_key(rows, ["k"], F.col("o"))


def table(spark, path, **options):
    return Store(spark, str(path), ["k"], newest, **{"buckets": 4, "fan": 2, "levels": 2, **options})


def test_many_batches_equal_one_walk(spark, tmp_path):
    draw, want = random.Random(1), {}
    store = table(spark, tmp_path)
    for batch in range(9):
        rows = [(f"k{draw.randrange(12)}", batch * 100 + i, draw.randrange(1000)) for i in range(draw.randrange(0, 6))]
        for k, o, v in rows:
            want[k] = (o, v)
        frame = spark.createDataFrame(rows, "k string, o int, v int")
        store.commit(batch, newest(frame, False).select("k", "o", "v"), {"batch": batch})
        if batch % 3 == 0:  # a batch that is run again
            store.commit(batch, frame)
        got = {r["k"]: (r["o"], r["v"]) for r in newest(store.read(), True).collect()}
        assert got == want
        head = store.head()
        assert head.note == {"batch": batch}
        assert all(len(runs) <= store.fan * store.levels for runs in head.buckets.values())
    assert set(store.folders()) <= head.runs() | store.head(8).runs()  # what no pointer needs is gone
    assert len(store._heads()) == 2


def test_one_changed_key_rewrites_one_bucket(spark, tmp_path):
    store = table(spark, tmp_path)
    keys = [f"k{i}" for i in range(40)]
    for batch in range(4):
        store.commit(batch, spark.createDataFrame([(k, batch, 0) for k in keys], "k string, o int, v int"))
    before = store.head()
    assert len(before.buckets) == 4
    for batch in range(4, 8):
        store.commit(batch, spark.createDataFrame([("k7", batch, 7)], "k string, o int, v int"))
    after = store.head()
    assert [b for b in before.buckets if before.buckets[b] != after.buckets[b]] == store.touched(
        spark.createDataFrame([("k7",)], "k string")
    )


def test_state_renews_touched_buckets_only(spark, tmp_path):
    from test_fold import documents, event, parsed

    path = str(tmp_path)
    ids = [f"u{i}" for i in range(30)]
    state.add_batch(spark, path, parsed(spark, [event("insert", i, {"x": 1}) for i in ids], 0), 0, 1, buckets=8)
    entries, docs = state.stores(spark, path, 8)
    before = docs.head().buckets
    state.add_batch(spark, path, parsed(spark, [event("update", "u3", updated={"y": 2})], 100), 1, 1, buckets=8)
    after = docs.head().buckets
    assert [b for b in before if before[b] != after[b]] == docs.touched(spark.createDataFrame([("u3",)], "_id string"))
    assert [b for b, runs in entries.head().buckets.items() if len(runs) > 1] == docs.touched(spark.createDataFrame([("u3",)], "_id string"))
    want = {i: {"x": 1} for i in ids} | {"u3": {"x": 1, "y": 2}}
    assert documents(state.current(spark, path, 8)) == want
    # Deleting all documents of a bucket leaves no folder for it, and a later change still finds it.
    state.add_batch(spark, path, parsed(spark, [event("delete", i) for i in ids], 200), 2, 1, buckets=8)
    assert documents(state.current(spark, path, 8)) == {} and docs.head().buckets == {}
    state.add_batch(spark, path, parsed(spark, [event("insert", "u3", {"z": 1})], 300), 3, 2, buckets=8)
    assert documents(state.current(spark, path, 8)) == {"u3": {"z": 1}}


@pytest.mark.parametrize("bad", [{"fan": 1}, {"levels": 0}, {"keep": 1}])
def test_settings(spark, tmp_path, bad):
    with pytest.raises(ValueError):
        table(spark, tmp_path, **bad)


PROBES, VERSIONS = "p int, k string, t timestamp", "k string, t timestamp, v int, gone boolean"


def at(second):
    return None if second is None else T0 + timedelta(seconds=second)


def run_join(spark, tmp_path, parts, **options):
    """``parts``: per batch, probes and versions."""
    join = VersionedJoin(spark, str(tmp_path / "join"), ["k"], "t", "t", 5, buckets=4, **options)
    for probes, versions in parts:
        for name, rows, schema in (("p", probes, PROBES), ("v", versions, VERSIONS)):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        streams = [
            spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))
            for name, schema in (("p", PROBES), ("v", VERSIONS))
        ]
        io.finish(join.start(*streams, str(tmp_path / "cp")))
    return join


def test_versions_may_come_a_batch_after_their_probes(spark, tmp_path):
    draw = random.Random(4)
    probes = [(i, draw.choice(["a", "b", "c", None, "none"]), at(draw.choice([None, *range(0, 200)]))) for i in range(150)]
    versions = [(draw.choice(["a", "b", "c", None]), at(s), i, draw.random() < 0.2) for i, s in enumerate(draw.choices(range(200), k=90))]

    def part(rows, column, low, high):
        return [r for r in rows if (r[column] is None and low == 0) or (r[column] is not None and at(low) <= r[column] < at(high))]

    cuts = [(0, 60, 0, 20), (60, 120, 20, 70), (120, 150, 70, 110), (150, 200, 110, 200)]
    parts = [(part(probes, 2, a, b), part(versions, 1, c, d)) for a, b, c, d in cuts]
    options = {"tie_order": "v", "closed_by": lambda: F.col("gone")}
    join = run_join(spark, tmp_path, parts, **options)
    whole = asof.asof_join(
        spark.createDataFrame(probes, PROBES), spark.createDataFrame(versions, VERSIONS), ["k"], "t", "t",
        tie_order=F.col("v"), closed_by=F.col("gone"),
    )
    columns = ["p", "k", "t", "v"]
    got = sorted(map(str, join.answers().select(*columns).collect()))
    assert got == sorted(map(str, whole.select(*columns).collect()))
    assert len(got) == 150
    answered = spark.read.parquet(str(tmp_path / "join" / "out")).count()
    assert 0 < answered < 150  # some still waited


def test_state_of_the_join_is_bounded(spark, tmp_path):
    """One hot key with very many versions: behind the watermark one is left, whatever came in."""
    parts = []
    for batch in range(9):
        times = range(batch * 100, batch * 100 + 100)
        parts.append(([(batch, "hot", at(batch * 100 + 99))], [("hot", at(s), s, False) for s in times]))
    join = run_join(spark, tmp_path, parts, tie_order="v")
    assert join.known.read().count() <= 4 * 100 + 10  # fan runs not merged yet, and what is behind them
    assert join.waiting.read().count() <= 4
    assert sorted((r["p"], r["v"]) for r in join.answers().collect()) == [(b, b * 100 + 99) for b in range(9)]


def test_late_rows_are_put_aside(spark, tmp_path):
    parts = [
        ([(1, "a", at(100))], [("a", at(100), 1, False)]),
        ([(2, "a", at(50)), (3, "a", at(200))], [("a", at(60), 2, False), ("a", at(200), 3, False)]),
    ]
    join = run_join(spark, tmp_path, parts)
    assert sorted((r["p"], r["v"]) for r in join.answers().collect()) == [(1, 1), (3, 3)]
    late = spark.read.parquet(str(tmp_path / "join" / "late")).collect()
    assert sorted(r["side"] for r in late) == ["probe", "version"]
