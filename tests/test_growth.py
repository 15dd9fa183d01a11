"""What keeps queries in proportion to their input: nothing is parsed twice, and no broadcast without a measure."""

import json
import os

import pytest
from pyspark.sql import functions as F

import oracle
from tidemark import session
from tidemark.functions.jsondoc import json_fields, marked
from tidemark.operators import fold, lookup
from tidemark.plans import cdc, fixtures, streams
from tidemark.sources.envelope import accepted, parse_redeems
from tidemark.streaming.lookups import DocumentTable


def _plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_parsed_events_are_not_taken_for_small(spark, tmp_path):
    """rows cut out of parsed records look far smaller to the planner than they are."""
    session.configure(spark)
    value = json.dumps({"data": {"keyword": "K", "transaction_id": "1"}})
    records = spark.range(100).select(
        F.lit(value).alias("value"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.current_timestamp().alias("timestamp")
    )
    records.write.parquet(f"{tmp_path}/log")
    names = spark.createDataFrame([("K", "k", "doc" * 1000)], "name string, keyword_id string, documents string")
    names.write.parquet(f"{tmp_path}/names")
    events = accepted(parse_redeems(spark.read.parquet(f"{tmp_path}/log")))
    found = lookup.matched(lookup.enrich(events, spark.read.parquet(f"{tmp_path}/names"))).select("transaction_id", "documents")
    assert "BroadcastExchange" not in _plan(found)
    assert found.count() == 100


def test_text_is_marked_in_one_pass(spark):
    frame = spark.createDataFrame([("{}",)], "v string").select(marked("v").alias("m"))
    assert frame._jdf.queryExecution().analyzed().toString().count("regexp_replace") == 1


@pytest.mark.parametrize(
    "text, want",
    [
        ('{"a":1.10,"b":"1.10","c":"","d":null,"e":-0,"f":true}', {"a": "1.10", "b": '"1.10"', "c": '""', "d": "null", "e": "-0", "f": "true"}),
        ('{"a":{"x":1.50,"y":["1.50",{"z":1e2}]},"b":[]}', {"a": '{"x":1.50,"y":["1.50",{"z":1e2}]}', "b": "[]"}),
        ('{"a\\"1":"x\\\\","b":{"q":"a\\"7\\"","r":"\\\\"}}', {'a"1': '"x\\\\"', "b": '{"q":"a\\"7\\"","r":"\\\\"}'}),
        ('{"a":"5","b":"","c":{"x":"5","y":"5"}}', {"a": '"5"', "b": '""', "c": '{"x":"5","y":"5"}'}),
        ('{"a":"' + "x" * 100_000 + '"}', {"a": '"' + "x" * 100_000 + '"'}),
    ],
)
def test_values_keep_kind_and_characters(spark, text, want):
    frame = spark.createDataFrame([(text,)], "v string")
    assert frame.select(json_fields("v")).first()[0] == want


@pytest.mark.parametrize("query", [cdc.fold_snapshot, cdc.verify_written])
def test_log_is_not_parsed_again(spark, query):
    """a log that is read for several purposes is parsed once."""
    assert "documentKey" not in _plan(query(spark, oracle.FOLDER))


def test_events_are_spread_before_they_are_made_into_records(spark):
    session.configure(spark)
    assert "hashpartitioning(event_id" in _plan(fixtures.change_log(spark, oracle.FOLDER))
    assert "hashpartitioning(o_orderkey" in _plan(fixtures.redeem_log(spark, oracle.FOLDER))


def test_files_of_a_part_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(streams, "ROWS", 50, raising=False)
    records, base = streams._stream(spark, spark.range(1200).withColumnRenamed("id", "offset"), "offset", "parts")
    assert len([name for name in os.listdir(f"{base}/in") if name.endswith(".parquet")]) == 24
    sizes = []
    query = records.writeStream.option("checkpointLocation", f"{base}/cp").foreachBatch(lambda b, _: sizes.append(b.count()))
    query.trigger(availableNow=True).start().awaitTermination()
    assert sizes == [400, 400, 400]


def test_lookup_tables_parse_a_change_once(spark, tmp_path):
    session.configure(spark)
    seen = spark.sparkContext.accumulator(0)

    def tell(op):
        seen.add(1)
        return op

    rows = [(str(i), "insert", i, {"n": str(i)}, None) for i in range(20)]
    events = spark.createDataFrame(rows, "_id string, op string, seq long, patch map<string,string>, removed array<string>")
    events = events.repartition(1).withColumn("op", F.udf(tell, "string").asNondeterministic()("op"))
    table = DocumentTable(spark, str(tmp_path), lambda documents: documents, 2)
    assert table.add(events, 0).count() == 20
    assert seen.value == 20


def test_stored_rows_over_events_of_every_kind(spark):
    stored = spark.createDataFrame(
        [("a", '{"x":1.0}'), ("b", '{ "y": 2 }'), ("c", "broken"), ("d", "broken"), (None, '{ "z": 3 }'), ("a", '{"x":1.0}')],
        "_id string, document string",
    )
    rows = [("a", "update", 1, {"k": "1"}, None), ("c", "update", 2, {"k": "2"}, None), ("d", "insert", 3, {"k": "3"}, None)]
    events = spark.createDataFrame(rows, "_id string, op string, seq long, patch map<string,string>, removed array<string>")
    found = sorted(map(tuple, fold.fold(events, stored).collect()), key=str)
    assert found == sorted(
        [("a", '{"k":1,"x":1.0}'), ("b", '{ "y": 2 }'), ("c", "broken"), ("d", '{"k":3}'), (None, '{ "z": 3 }')], key=str
    )
