"""Streams: restarts, repeated batches, late and repeated rows."""

import json
from datetime import datetime, timedelta

import test_fold
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import fold
from tidemark.operators.alerts import AlertRule
from tidemark.streaming import io, jobs

T0 = datetime(2024, 1, 1)


def test_restart_adds_nothing(spark, tmp_path):
    log = test_fold.random_log(11, 300)
    source, entries, checkpoint = (str(tmp_path / n) for n in ("in", "entries", "cp"))

    def run():
        stream = spark.readStream.schema(test_fold.LOG).option("maxFilesPerTrigger", 1).parquet(source)
        io.finish(jobs.materialize_changes(stream, entries, checkpoint, order="offset"))
        state = fold.state_from_entries(fold.reduce_entries(fold.read_entries(spark, entries)))
        return test_fold.documents(state)

    test_fold.records(spark, log[:150]).coalesce(1).write.parquet(source)
    assert run() == test_fold.walk(log[:150])
    test_fold.records(spark, log[150:], 150).coalesce(1).write.mode("append").parquet(source)
    assert run() == test_fold.walk(log)
    assert run() == test_fold.walk(log)


def test_batches_plan_adaptively(spark, tmp_path):
    seen = []
    spark.range(10).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id bigint").parquet(str(tmp_path / "in"))

    def action(batch, batch_id):
        joined = batch.join(batch.sparkSession.range(5), "id").groupBy("id").count()
        joined.collect()
        seen.append(joined._jdf.queryExecution().executedPlan().toString())

    io.finish(io.start_batches(stream, action, str(tmp_path / "cp")))
    assert seen and all(plan.startswith("AdaptiveSparkPlan") for plan in seen)


def test_copies_are_dropped(spark, tmp_path):
    rows = [("a", i, T0 + timedelta(seconds=i % 3)) for i in range(200)] + [("b", 1, T0), ("c", 2, T0)]
    spark.createDataFrame(rows, "k string, offset int, ts timestamp").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, offset int, ts timestamp").parquet(str(tmp_path / "in"))
    once = io.drop_copies(io.watermarked(stream, "ts"), ["k"], ["offset"])
    io.finish(io.start_files(once, str(tmp_path / "out"), str(tmp_path / "cp")))
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"]


def test_watch_over_batches(spark, tmp_path):
    """Runs that cross batches, one that ends and one that stays open."""
    schema = "metric string, labels map<string,string>, value double, eval_ts timestamp"
    source, path = str(tmp_path / "in"), str(tmp_path / "alerts")
    batches = [[0, 60], [120], [300, 360], [420]]
    for steps in batches:
        rows = [("m", {"b": "1"}, 1.0, T0 + timedelta(seconds=s)) for s in steps]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    rule = AlertRule("A", "m", ">", 0, 60, "critical")
    io.finish(jobs.watch(stream, rule, path, str(tmp_path / "cp"), 60))
    found = jobs.watched(spark, path).collect()
    got = {(r["state"], (r["starts_at"] - T0).seconds, (r["last_active"] - T0).seconds, r["steps"]) for r in found}
    assert got == {("resolved", 0, 120, 3), ("firing", 300, 420, 3)}


def test_step_values_wait_for_late_samples(spark, tmp_path):
    schema = "metric string, labels map<string,string>, value double, ts timestamp"
    source = str(tmp_path / "in")
    for rows in ([(60, 1.0), (61, 2.0)], [(500, 3.0)], [(120, 4.0)], [(5000, 5.0)], [(61, 9.0)]):
        frame = spark.createDataFrame([("m", {"a": "1"}, v, T0 + timedelta(seconds=s)) for s, v in rows], schema)
        frame.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    steps = jobs.step_values(stream, 60)
    io.finish(io.start_files(steps, str(tmp_path / "out"), str(tmp_path / "cp")))
    got = {((r["eval_ts"] - T0).seconds, r["value"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    # A sample exactly at the end of a step belongs to it. 120 came late but in
    # time, the second 61 after its step was closed, and 5000 is still open.
    assert got == {(60, 1.0), (120, 4.0), (540, 3.0)}


def test_open_steps_complete_a_bounded_stream(spark, tmp_path):
    """Steps and alert runs reach the last sample; a late sample does not reopen its step."""
    schema = "metric string, labels map<string,string>, value double, ts timestamp"
    source, path = str(tmp_path / "in"), str(tmp_path / "alerts")
    for rows in ([(60, 1.0), (61, 2.0)], [(2000, 3.0)], [(2041, 4.0), (2030, 8.0)], [(61, 9.0)]):
        frame = spark.createDataFrame([("m", {"a": "1"}, v, T0 + timedelta(seconds=s)) for s, v in rows], schema)
        frame.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    rule = AlertRule("A", "m", ">", 2, 60, "critical")
    io.finish(jobs.watch(jobs.step_values(stream, 60), rule, path, str(tmp_path / "cp"), 60, 60))
    rest = jobs.open_steps(spark.read.parquet(source), 60)
    assert sorted(((r["eval_ts"] - T0).seconds, r["value"]) for r in rest.collect()) == [(2040, 8.0), (2100, 4.0)]
    found = jobs.watched_to_end(rest, rule, path, 60, 60).collect()
    assert [(r["state"], (r["starts_at"] - T0).seconds, r["steps"]) for r in found] == [("firing", 2040, 2)]


def test_lookup_is_read_anew(spark, tmp_path):
    log = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    known = []

    def read_lookup():
        columns = "name string, keyword_id string, documents string"
        return spark.createDataFrame(known, columns)

    for offset in range(2):
        value = json.dumps({"data": {"keyword": "A", "transaction_id": str(offset)}})
        spark.createDataFrame([(None, value, "t", 0, offset, T0)], log).write.mode("append").parquet(source)
        stream = spark.readStream.schema(log).parquet(source)
        query = jobs.enrich_redeems(stream, read_lookup, out, checkpoint, "with_event", ["transaction_id"])
        io.finish(query)
        known = [("A", "1", '{"keyword":{}}')]
    sent = [json.loads(r["value"]) for r in io.read_batches(spark, out).collect()]
    assert [m["event"]["transaction_id"] for m in sent] == ["1"]


def test_console_sink_runs(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id bigint").parquet(str(tmp_path / "in"))
    query = io.start_console(stream, str(tmp_path / "cp"))
    io.finish(query)
    assert query.exception() is None


def test_scratch_folder_is_the_shared_one(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = session.scratch_dir(spark, "x"), session.scratch_dir(spark, "x")
    assert first.startswith(base) and first != second


def test_latest_rows_with_tombstone(spark, tmp_path):
    schema = "k string, o int, v string"
    source = str(tmp_path / "in")
    for rows in ([("a", 1, "x"), ("b", 1, "y")], [("a", 2, None), ("b", 0, "old")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    io.finish(jobs.upsert_rows(stream, str(tmp_path / "t"), str(tmp_path / "cp"), ["k"], F.col("o")))
    rows = jobs.latest_rows(spark, str(tmp_path / "t"), ["k"], F.col("v").isNull()).collect()
    assert [(r["k"], r["v"]) for r in rows] == [("b", "y")]


def test_state_table_keeps_deletes_and_replays(spark, tmp_path):
    """Versions, a late older event, and a batch that is run again."""
    from test_fold import documents, event, parsed

    from tidemark.streaming import state

    batches = [
        (10, [event("insert", "a", {"x": 1}), event("insert", "b", {"x": 1}), event("delete", "a")]),
        (20, [event("update", "b", updated={"y": 2})]),
        (1, [event("insert", "a", {"x": 9}), event("update", "b", updated={"x": 7, "y": 7})]),
        (30, [event("insert", "c", {"z": 1}), event("delete", "b")]),
    ]
    path = str(tmp_path / "state")
    assert state.current(spark, path).count() == 0
    want = [{"b": {"x": 1}}, {"b": {"x": 1, "y": 2}}, {"b": {"x": 1, "y": 2}}, {"c": {"z": 1}}]
    for batch_id, (start, log) in enumerate(batches):
        for _ in range(2):
            state.add_batch(spark, path, parsed(spark, log, start), batch_id, every=2)
            assert documents(state.current(spark, path)) == want[batch_id]
    state.add_batch(spark, path, parsed(spark, batches[0][1], 10), 0, every=2)
    assert documents(state.current(spark, path)) == want[-1]


def test_streamed_vector_with_gaps_and_slips(spark, tmp_path):
    """Samples out of order, a series that stops, one that comes back; equal to the batch vector step by step."""
    import random

    from tidemark.operators import metrics

    draw = random.Random(8)
    schema = "metric string, labels map<string,string>, value double, ts timestamp"
    source, rows = str(tmp_path / "in"), []
    for second in range(0, 6000, 17):
        for series in "abc":
            gone = (series == "b" and 1000 < second < 3000) or (series == "c" and second > 2500)
            if not gone and draw.random() < 0.7:
                slip = draw.choice([0, 0, 0, 300, 599])  # how late it arrives
                rows.append((second + slip, ("m", {"s": series, "none": ""}, float(second), T0 + timedelta(seconds=second))))
    rows = [row for _, row in sorted(rows, key=lambda r: r[0])]
    for start in range(0, len(rows), 60):
        spark.createDataFrame(rows[start : start + 60], schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    io.finish(io.start_files(jobs.stream_vector(stream, 60, 300), str(tmp_path / "out"), str(tmp_path / "cp")))
    samples = spark.createDataFrame(rows, schema)
    rest = jobs.open_vector(spark.read.parquet(source), 60, 300)

    def plain(frame):
        return sorted((r["labels"]["s"], r["eval_ts"], r["value"]) for r in frame.collect())

    emitted, left = plain(spark.read.parquet(str(tmp_path / "out"))), plain(rest)
    assert emitted and left
    assert sorted(emitted + left) == plain(metrics.instant_vector(samples, 60, 300))


def test_all_rules_in_one_stream(spark, tmp_path):
    """Threshold rules and one over its own past, cut into batches at any step, equal the batch evaluation."""
    import random

    from tidemark.operators import alerts

    draw = random.Random(9)
    schema = "metric string, labels map<string,string>, value double, eval_ts timestamp"
    rules = [
        AlertRule("High", "m", ">", 1, 120, "critical", summary="{{ $labels.s }} is {{ $value }}"),
        AlertRule("Low", "m", "<", 1, 0, "warning"),
        AlertRule("Changed", "n", "!=", None, 60, "warning", offset_seconds=180, ignoring=("x",)),
    ]
    source, path, everything = str(tmp_path / "in"), str(tmp_path / "alerts"), []
    steps = [s for s in range(0, 3600, 60) if not 1200 < s < 1500]
    while steps:
        some = steps[: draw.randrange(1, 9)]
        steps = steps[len(some) :]
        rows = []
        for s in some:
            when = T0 + timedelta(seconds=s)
            rows += [("m", {"s": k}, float(draw.randrange(3)), when) for k in "ab" if draw.random() < 0.9]
            rows += [("n", {"s": k, "x": str(draw.randrange(5))}, float(draw.randrange(2)), when) for k in "ab" if draw.random() < 0.9]
        everything += rows
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    io.finish(jobs.watch(stream, rules, path, str(tmp_path / "cp"), 60, 60))
    as_of = F.lit(max(r[3] for r in everything)).cast("timestamp")
    want = alerts.evaluate_alerts(spark.createDataFrame(everything, schema), rules, as_of, 60, 60)
    got = alerts.described(jobs.watched(spark, path), rules)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
    assert len(io.kept_batches(spark, f"{path}/open")) <= 2 and len(io.kept_batches(spark, f"{path}/ring")) <= 2
