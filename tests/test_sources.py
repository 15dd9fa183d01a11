"""Envelopes, lookups, text files and declared tables on hand-made rows."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import jsondoc, text, times
from tidemark.operators import eligibility, lookup, shards, tables
from tidemark.sources import envelope, files, specs, topics

LOG = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"


def log(spark, values):
    return spark.createDataFrame([(None, v, "t", 0, i, None) for i, v in enumerate(values)], LOG)


def one(spark, column, **values):
    frame = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} string" for n in values))
    return frame.select(column.alias("x")).first()["x"]


def test_rejects_and_shapes(spark):
    key = '"documentKey":{"_id":{"$oid":"k"}}'
    values = [
        '{"operationType":"insert",' + key + ',"fullDocument":{"a":1}}',
        '{"operationType":"delete","documentKey":{"_id":"plain"}}',
        '{"operationType":"delete","documentKey":{"_id":7}}',
        '{"operationType":"insert",' + key + ',"fullDocument":{"a"',
        "[]",
        None,
        '{"operationType":"insert","documentKey":{}}',
        '{"operationType":"insert","documentKey":{"_id":{"$oid":null}}}',
        '{"operationType":"rename",' + key + "}",
        "{" + key + "}",
        '{"operationType":"insert",' + key + ',"fullDocument":[1]}',
        '{"operationType":"update",' + key + ',"updateDescription":{"updatedFields":3}}',
        '{"operationType":"insert",' + key + ',"fullDocument":{"a":1},"wallTime":{"$date":[]},"extra":{"deep":1}}',
        '{"operationType":"delete",' + key + ',"ns":{"db"',
        '{"operationType":"delete",' + key,
    ]
    events = envelope.parse_changes(log(spark, values), "offset")
    got = {r["seq"]: (r["_id"], r["reject"]) for r in events.collect()}
    assert got == {
        0: ("k", None),
        1: ("plain", None),
        2: ("7", None),
        3: ("k", "malformed_json"),
        4: (None, "malformed_json"),
        5: (None, "missing_key"),
        6: (None, "missing_key"),
        7: (None, "missing_key"),
        8: ("k", "unknown_operation"),
        9: ("k", "unknown_operation"),
        10: ("k", "invalid_document"),
        11: ("k", "invalid_document"),
        12: ("k", None),
        13: ("k", "malformed_json"),
        14: (None, "malformed_json"),
    }
    assert envelope.rejected(events).count() + envelope.accepted(events).count() == len(values)


def test_event_time_shapes(spark):
    key = '"operationType":"delete","documentKey":{"_id":"k"}'
    values = [
        '{"wallTime":{"$date":1500},' + key + "}",
        '{"wallTime":{"$date":"1970-01-01T00:00:02Z"},' + key + "}",
        '{"clusterTime":{"$timestamp":{"t":3,"i":1}},' + key + "}",
        '{"clusterTime":{"t":4,"i":1},' + key + "}",
        "{" + key + "}",
    ]
    now = F.lit("1970-01-01 00:00:09").cast("timestamp")
    rows = envelope.parse_changes(log(spark, values), "offset", now).orderBy("seq").collect()
    assert [r["event_ms"] for r in rows] == [1500, 2000, 3000, 4000, 9000]


def test_redeem_shapes(spark):
    values = [
        '{"data":{"keyword":"A","transaction_id":"1","additional":{"n":5}},"account":{"_id":{"$oid":"x"},"user_id":{"u":1}}}',
        '{"data":{"keyword_id":"B","transaction_id":"2"},"account":{"_id":"y"}}',
        '{"data":{"transaction_id":"3"}}',
        "{}",
        "{",
    ]
    rows = envelope.parse_redeems(log(spark, values)).orderBy("offset").collect()
    assert [(r["keyword"], r["account_id"], r["reject"]) for r in rows] == [
        ("A", "x", None),
        ("B", "y", None),
        (None, None, "missing_keyword"),
        (None, None, "missing_keyword"),
        (None, None, "malformed_json"),
    ]
    assert rows[0]["additional"] == {"n": "5"} and rows[0]["user_id"] == '{"u":1}'


def test_json_functions(spark):
    doc = '{"a":{"b.c":{"$oid":"x"}},"n":null,"s":"t"}'
    assert one(spark, jsondoc.json_text("d", "a", "b.c", "$oid"), d=doc) == "x"
    assert one(spark, F.to_json(jsondoc.json_node("d", "a", "b.c")), d=doc) == '{"$oid":"x"}'
    assert one(spark, jsondoc.json_text("d", "a", "nope"), d=doc) is None
    assert one(spark, jsondoc.is_json("d"), d="{") is False
    assert one(spark, jsondoc.is_json("d"), d="3") is True
    left, right = F.from_json("l", "map<string,variant>"), F.from_json("r", "map<string,variant>")
    merged = jsondoc.document_text(jsondoc.merge_objects(left, right))
    assert json.loads(one(spark, merged, l='{"a":1,"b":{"x":1}}', r='{"b":{"y":2},"c":null}')) == {
        "a": 1, "b": {"y": 2}, "c": None,
    }
    assert one(spark, merged, l=None, r='{"b":1}') == '{"b":1}'
    cut = jsondoc.document_text(jsondoc.without_keys(left, F.array(F.lit("a"))))
    assert one(spark, cut, l='{"a":1,"b":2}') == '{"b":2}'
    assert one(spark, jsondoc.document_text(left), l=None) == "{}"


def test_text_functions(spark):
    assert one(spark, text.excerpt(F.col("t"), 3), t="abcd") == "abc..."
    assert one(spark, text.excerpt(F.col("t"), 4), t="abcd") == "abcd"
    line = '{"_id": ObjectId("0aF1"), "d": [ISODate("2024-01-01"), ISODate("x y")]}'
    assert json.loads(one(spark, text.extended_json(F.col("t")), t=line)) == {
        "_id": {"$oid": "0aF1"}, "d": [{"$date": "2024-01-01"}, {"$date": "x y"}],
    }
    assert one(spark, text.safe_metric_name(F.col("t")), t="Ab-.c__D:e") == "ab_c_d:e"


def test_latency(spark):
    end = F.lit("2024-01-01 00:00:01.5").cast("timestamp")
    assert one(spark, times.latency_ms(F.col("t").cast("timestamp"), end), t="2024-01-01 00:00:00") == 1500
    assert one(spark, times.latency_ms(F.col("t").cast("timestamp"), end), t=None) == 0


def test_keyed_lines(spark):
    lines = spark.createDataFrame([("k|v|w",), ("|v",), ("none",), ("k|",)], "value string")
    split = files.keyed_lines(lines)
    assert {tuple(r) for r in files.keyed(split).collect()} == {("k", "v|w"), ("", "v"), ("k", "")}
    assert [r["line"] for r in files.unkeyed(split).collect()] == ["none"]


def test_collect_logs(spark, tmp_path):
    for name, lines in {"a.log": "1\n2\n", "b.log": "3\n", "c.txt": "4\n"}.items():
        (tmp_path / name).write_text(lines)
    jobs = [files.LogJob(f"{tmp_path}/*.log", {"job": "x"}), files.LogJob(f"{tmp_path}/*.txt", {"job": "y", "n": "1"})]
    rows = files.collect_logs(spark, jobs).collect()
    got = {(r["value"], r["path"].rsplit("/", 1)[1], r["labels"]["job"]) for r in rows}
    assert got == {("1", "a.log", "x"), ("2", "a.log", "x"), ("3", "b.log", "x"), ("4", "c.txt", "y")}


def test_find_puts_missing_last(spark):
    docs = spark.createDataFrame([("a", 1, 5), ("b", 1, None), ("c", 1, 9), ("d", 2, 7)], "_id string, abc int, created_at int")
    found = files.find(docs, F.col("abc") == 1, ["_id", "abc"], "created_at")
    assert [r["_id"] for r in found.collect()] == ["c", "a", "b"]


def test_declared_types(spark):
    assert specs.spark_type("STRING") == "string"
    assert specs.spark_type("TIMESTAMP_LTZ(3)") == "timestamp"
    assert specs.spark_type("MAP<STRING, STRING>") == "map<string, string>"
    nested = specs.spark_type("ROW<`_id` ROW<`$oid` STRING>, `desc` STRING, a ARRAY<ROW<n INT, t TIMESTAMP_LTZ(3)>>>")
    assert nested == "struct<`_id`: struct<`$oid`: string>, `desc`: string, `a`: array<struct<`n`: int, `t`: timestamp>>>"
    from pyspark.sql.types import _parse_datatype_string

    _parse_datatype_string(f"x {nested}")


def test_spec_options():
    spec = specs.load_spec(
        json.dumps(
            {
                "table": {
                    "identifier": {"catalog": "c", "database": "d", "table": "t"},
                    "schema": {"columns": [{"name": "a", "type": "INT"}]},
                    "options": {
                        "topic": "x", "properties.bootstrap.servers": "h:1", "properties.group.id": "g",
                        "properties.security.protocol": "PLAINTEXT", "scan.startup.mode": "earliest-offset",
                    },
                }
            }
        )
    )
    assert spec.name == "c.d.t" and spec.ddl == "`a` int"
    options = specs.kafka_reader_options(spec)
    assert options["kafka.bootstrap.servers"] == "h:1" and options["subscribe"] == "x"
    assert options["kafka.group.id"] == "g" and options["startingOffsets"] == "earliest"
    assert options["kafka.security.protocol"] == "PLAINTEXT"
    flat = specs.compact_spec(
        {"name": "t", "topic": "x", "schema": "op STRING\n  key ROW<`$oid` STRING>\n", "properties.bootstrap.servers": "h:1", "empty": None}
    )
    assert flat.columns == {"op": "STRING", "key": "ROW<`$oid` STRING>"} and flat.options["empty"] == ""
    assert topics.topic_options("h:1", "x", client={"client.id": "c"})["kafka.client.id"] == "c"


def test_first_keyword_and_missing_program(spark):
    def keyword(key, name, program):
        doc = {"eligibility": {"name": name, "program_id": {"_id": {"$oid": program}}}}
        return (key, json.dumps(doc))

    keywords = spark.createDataFrame(
        [keyword("2", "A", "p"), keyword("10", "A", "p"), keyword("1", "A", "none"), keyword("3", "B", "none"), ("4", "{}")],
        "_id string, document string",
    )
    programs = spark.createDataFrame([("p", '{"n":1}')], "_id string, document string")
    first = lookup.first_per_name(keywords, programs).collect()
    assert [(r["name"], r["keyword_id"]) for r in first] == [("A", "10")]
    events = spark.createDataFrame([("1", "A"), ("2", "B"), ("3", "A"), ("4", None)], "transaction_id string, keyword string")
    enriched = lookup.enrich(events, lookup.first_per_name(keywords, programs))
    assert enriched.count() == 4
    assert {r["transaction_id"] for r in lookup.matched(enriched).collect()} == {"1", "3"}
    value = json.loads(lookup.message(lookup.matched(enriched)).first()["value"])
    assert list(value) == ["keyword", "program", "customer"] and value["customer"] is None
    with pytest.raises(ValueError):
        lookup.message(enriched, "other")
    flags = {r["transaction_id"]: r["found"] for r in lookup.with_existence(events, keywords).collect()}
    assert flags == {"1": True, "2": True, "3": True, "4": False}


def test_regular_join_keeps_every_keyword_of_a_name(spark):
    def keyword(key, name, start):
        return (key, json.dumps({"eligibility": {"name": name, "start_period": {"$date": start}}}))

    keywords = spark.createDataFrame([keyword("1", "A", 10), keyword("2", "A", 20)], "_id string, document string")
    events = spark.createDataFrame([("1", "A"), ("2", "B"), (None, "A")], "transaction_id string, keyword string")
    joined = lookup.redeem_periods(events, keywords).collect()
    assert sorted((r["transaction_id"], r["start_period"] or 0) for r in joined) == [("1", 10), ("1", 20), ("2", 0)]


def test_reason_boundaries(spark):
    rows = spark.createDataFrame(
        [(1, None, 5), (2, 1, None), (3, 10_001, 20_000), (4, 10_000, 10_000), (5, 1, 9_999)],
        "id int, start_period bigint, end_period bigint",
    )
    judged = eligibility.with_reason(rows, F.timestamp_seconds(F.lit(10)))
    assert [r["reason"] for r in judged.orderBy("id").collect()] == [
        eligibility.MISSING, eligibility.MISSING, eligibility.NOT_STARTED, eligibility.ELIGIBLE, eligibility.EXPIRED,
    ]


def test_upsert_delete_verify(spark):
    table = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "x" * 60)], "_id string, document string")
    changes = spark.createDataFrame([("b", "2", 1), ("b", "3", 2), ("d", "4", 1)], "_id string, document string, o int")
    after = tables.upsert(table, changes, ["_id"], F.col("o"))
    assert {r["_id"]: r["document"][:1] for r in after.collect()} == {"a": "1", "b": "3", "c": "x", "d": "4"}
    left = tables.delete_keys(after, changes, ["_id"])
    assert {r["_id"] for r in left.collect()} == {"a", "c"}
    asked = spark.createDataFrame([("c",), ("d",)], "_id string")
    checked = {r["_id"]: (r["found"], r["excerpt"]) for r in tables.verify_written(asked, left).collect()}
    assert checked == {"c": (True, "x" * 50 + "..."), "d": (False, None)}


def test_merge_statement():
    sql = tables.merge_statement("t", "t_staging", ["_id", "document"], "_id")
    assert "ON t._id = s._id" in sql and "SET document = s.document" in sql and "VALUES (s._id, s.document)" in sql


def test_append_and_layout(spark, tmp_path):
    rows = spark.range(100).selectExpr("id % 3 AS oem", "id AS zip")
    tables.append_rows(rows, str(tmp_path / "t"))
    tables.append_rows(rows, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200
    shards.lay_out(rows, str(tmp_path / "s"), "oem", ["zip"], 4)
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert stored.count() == 100
    assert stored.filter(F.col("shard") != shards.hashed_shard(F.col("oem"), 4)).count() == 0


def test_keyed_message(spark):
    rows = spark.createDataFrame([("1", None), ("2", "x")], "transaction_id string, reason string")
    sent = lookup.keyed_message(rows, "transaction_id", F.col("reason").isNull())
    assert {tuple(r) for r in sent.collect()} == {
        ('{"transaction_id":"1"}', None),
        ('{"transaction_id":"2"}', '{"transaction_id":"2","reason":"x"}'),
    }


def test_unnest_by_the_declared_type(spark):
    """Null and empty arrays keep a row at each level; arrays in arrays, and arrays beside the path."""
    ddl = specs.spark_type("ROW<id INT, a ARRAY<ROW<x ROW<y INT>, b ARRAY<ROW<z STRING>>, c ARRAY<INT>>>, m ARRAY<ARRAY<INT>>>")
    texts = [
        '{"id":1,"a":[{"x":{"y":5},"b":[{"z":"p"},{"z":null}],"c":[1]},{"b":[]},null],"m":[[1,2],[],null]}',
        '{"id":2,"a":[]}',
        '{"id":3}',
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "value string").select(F.from_json("value", ddl).alias("r")).select("r.*")
    assert specs.array_paths(rows.schema) == [("a",), ("a", "b"), ("a", "c"), ("m",), ("m",)]
    assert specs.unnest(rows).columns == ["id"]
    inner = specs.unnest(rows, ("a", "b"))
    assert inner.columns == ["id", "a_pos", "a_x_y", "a_b_pos", "a_b_z"]
    assert sorted(map(tuple, inner.collect()), key=str) == sorted(
        [(1, 0, 5, 0, "p"), (1, 0, 5, 1, None), (1, 1, None, None, None), (1, 2, None, None, None), (2, None, None, None, None), (3, None, None, None, None)],
        key=str,
    )
    deep = specs.unnest(rows.filter("id = 1"), ("m",))
    assert deep.columns == ["id", "m_pos", "m_item_pos", "m_item"]
    assert sorted(map(tuple, deep.collect()), key=str) == sorted([(1, 0, 0, 1), (1, 0, 1, 2), (1, 1, None, None), (1, 2, None, None)], key=str)
    with pytest.raises(ValueError):
        specs.unnest(rows, ("a", "nothing"))
