"""Instant vectors, rules and alerts on hand-made samples."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import alerts, metrics, rulebook
from tidemark.operators.alerts import AlertRule
from tidemark.operators.metrics import Matcher, RecordingRule

T0 = datetime(2024, 1, 1)
SAMPLE = "metric string, labels map<string,string>, value double, ts timestamp"
VECTOR = "metric string, labels map<string,string>, value double, eval_ts timestamp"


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def vector(spark, rows):
    return spark.createDataFrame([(m, ls, float(v), at(t)) for m, ls, v, t in rows], VECTOR)


def instants(spark, rows, **settings):
    samples = spark.createDataFrame([(m, ls, float(v), at(t)) for m, ls, v, t in rows], SAMPLE)
    found = metrics.instant_vector(samples, **settings).collect()
    return sorted(((r["eval_ts"] - T0).total_seconds(), r["value"]) for r in found)


def test_lookback_edges(spark):
    rows = [("m", {"a": "1", "none": ""}, 5, 60)]
    assert instants(spark, rows, step_seconds=60, lookback_seconds=120) == [(60, 5), (120, 5)]
    assert instants(spark, rows, step_seconds=60, lookback_seconds=120, closed_left=True) == [(60, 5), (120, 5), (180, 5)]
    assert instants(spark, [("m", {}, 5, 61)], step_seconds=60, lookback_seconds=120) == [(120, 5), (180, 5)]
    assert instants(spark, [("m", {}, 5, 61)], step_seconds=60, lookback_seconds=30) == []
    end = F.lit(at(60)).cast("timestamp")
    assert instants(spark, rows, step_seconds=60, lookback_seconds=300, end=end) == [(60, 5)]


def test_newest_sample_wins(spark):
    rows = [("m", {"a": "1"}, 1, 10), ("m", {"a": "1", "b": ""}, 2, 50), ("m", {"a": "1"}, 3, 70)]
    assert instants(spark, rows, step_seconds=60, lookback_seconds=60) == [(60, 2), (120, 3)]


def test_missing_label_is_empty(spark):
    rows = vector(spark, [("m", {"t": "x"}, 1, 0), ("m", {}, 2, 0), ("o", {}, 4, 0)])

    def values(*matchers):
        return sorted(r["value"] for r in metrics.select_series(rows, "m", matchers).collect())

    assert values(Matcher("t", "!=", "x")) == [2]
    assert values(Matcher("t", "=", "")) == [2]
    assert values(Matcher("t", "=~", "x|y")) == [1]
    assert values(Matcher("t", "!~", ".")) == [2]


def test_rules(spark):
    rows = vector(
        spark,
        [
            ("m", {"c": "1", "p": "0", "r": "a"}, 5, 0),
            ("m", {"c": "1", "p": "0", "r": "b"}, 7, 0),
            ("m", {"c": "1", "p": "1", "r": "a"}, 0, 0),
            ("m", {"p": "1"}, 2, 0),
            ("m", {"c": "1", "p": "1", "r": "a"}, 9, 60),
        ],
    )
    rules = [
        RecordingRule("sum", "m", ("c",)),
        RecordingRule("peak", "m", ("c",), inner_by=("p", "c")),
        RecordingRule("n", "m", ("c",), "count", keep=(">", 0)),
        RecordingRule("all", "m", ()),
    ]
    found = metrics.evaluate_rules(rows, rules).collect()
    got = {(r["record"], r["labels"].get("c", ""), (r["eval_ts"] - T0).seconds): r["value"] for r in found}
    assert got == {
        ("sum", "1", 0): 12, ("sum", "", 0): 2, ("sum", "1", 60): 9,
        ("peak", "1", 0): 7, ("peak", "", 0): 2, ("peak", "1", 60): 9,
        ("n", "1", 0): 2, ("n", "", 0): 1, ("n", "1", 60): 1,
        ("all", "", 0): 14, ("all", "", 60): 9,
    }
    counted = metrics.count_by_count(rows, "m", ("p", "r")).collect()
    assert {(r["eval_ts"] - T0).seconds: r["value"] for r in counted} == {0: 4, 60: 1}


def test_offset_join(spark):
    rows = [("m", {"broker": "1", "x": "a"}, 3, 0), ("m", {"broker": "2", "x": "a"}, 4, 60), ("m", {"broker": "2", "x": "a"}, 4, 120)]
    found = metrics.offset_join(vector(spark, rows), "m", "!=", 60, ("broker",)).collect()
    assert [(r["labels"], r["value"], r["eval_ts"]) for r in found] == [({"x": "a"}, 4, at(60))]
    left = metrics.offset_join(vector(spark, rows), "m", "!=", 60, ("broker",), labels="left").collect()
    assert left[0]["labels"] == {"broker": "2", "x": "a"}
    twofold = vector(spark, [*rows, ("m", {"broker": "3", "x": "a"}, 1, 60)])
    with pytest.raises(Exception, match="several series"):
        metrics.offset_join(twofold, "m", "!=", 60, ("broker",)).collect()


def test_rename_orders(spark):
    bean = "kafka.server<type=ReplicaManager, name=UnderReplicated, topic=T, partition=0><>Value"
    rows = spark.createDataFrame([(bean,), ("unknown",)], "bean string")
    given = metrics.rename_metrics(rows, rulebook.RENAME_RULES).collect()
    assert [(r["metric"], r["labels"]) for r in given] == [
        ("io_confluent_kafka_server_replicamanager_underreplicated_topic_t_partition_0", {})
    ]
    special = metrics.rename_metrics(rows, rulebook.RENAME_RULES, order="most_specific_first").collect()
    assert [(r["metric"], r["labels"]) for r in special] == [
        ("io_confluent_kafka_server_partition_underreplicated", {"topic": "T", "partition": "0"})
    ]


def test_rulebook_is_complete():
    assert len(rulebook.RECORDING_RULES) == 15
    assert len({rule.record for rule in rulebook.RECORDING_RULES}) == 15
    assert len(rulebook.ALERT_RULES) == 6 and len(rulebook.RENAME_RULES) == 8


def run_alerts(spark, seconds, for_seconds, as_of, value=1):
    rule = AlertRule(
        "A", "m", ">", 0, for_seconds, "critical", summary="{{ $labels.b }} is {{ $value }}", description="{{ $labels.no }}!"
    )
    rows = vector(spark, [("m", {"b": "1"}, value, s) for s in seconds])
    found = alerts.evaluate_alerts(rows, [rule], F.lit(at(as_of)).cast("timestamp")).orderBy("starts_at").collect()

    def offset(moment):
        return None if moment is None else int((moment - T0).total_seconds())

    return [(r["state"], offset(r["starts_at"]), offset(r["fired_at"]), offset(r["ends_at"])) for r in found], found


def test_alert_life_cycle(spark):
    assert run_alerts(spark, [0, 60], 60, 60)[0] == [("firing", 0, 60, None)]
    assert run_alerts(spark, [0], 60, 0)[0] == [("pending", 0, None, None)]
    assert run_alerts(spark, [0], 60, 60)[0] == []
    assert run_alerts(spark, [0, 60], 90, 60)[0] == [("pending", 0, None, None)]
    assert run_alerts(spark, [0, 60, 120], 90, 120)[0] == [("firing", 0, 120, None)]
    # A gap starts anew; the first run is over.
    assert run_alerts(spark, [0, 60, 180, 240], 60, 240)[0] == [("resolved", 0, 60, 120), ("firing", 180, 240, None)]


def test_annotations(spark):
    _, found = run_alerts(spark, [0, 60], 60, 60, value=3)
    assert (found[0]["summary"], found[0]["description"], found[0]["severity"]) == ("1 is 3", "!", "critical")
    _, found = run_alerts(spark, [0, 60], 60, 60, value=0.5)
    assert found[0]["summary"] == "1 is 0.5"


def test_merging_runs(spark):
    rows = [("a", 0, 60, 2, 1.0), ("a", 120, 180, 2, 2.0), ("a", 300, 300, 1, 3.0), ("b", 120, 120, 1, 4.0)]
    runs = spark.createDataFrame(
        [(k, at(s), at(e), n, v) for k, s, e, n, v in rows],
        "k string, starts_at timestamp, last_active timestamp, steps bigint, value double",
    )
    merged = alerts.merge_runs(runs, 60, ["k"]).collect()
    got = {(r["k"], (r["starts_at"] - T0).seconds, (r["last_active"] - T0).seconds, r["steps"], r["value"]) for r in merged}
    assert got == {("a", 0, 180, 4, 2.0), ("a", 300, 300, 1, 3.0), ("b", 120, 120, 1, 4.0)}
