"""Lookup tables and joins that follow change streams."""

import json
import random
from datetime import datetime

from tidemark.operators import fold, lookup
from tidemark.streaming import io
from tidemark.streaming.lookups import FollowingJoin, Lookups, enrich_following

LOG = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"
T0 = datetime(2024, 1, 1)


def change(op, key, document=None):
    event = {"operationType": op, "documentKey": {"_id": {"$oid": key}}}
    if op in ("insert", "replace"):
        event["fullDocument"] = document
    if op == "update":
        event["updateDescription"] = {"updatedFields": document}
    return json.dumps(event)


def keyword(name, program, start=None):
    return {"eligibility": {"name": name, "program_id": {"_id": {"$oid": program}}, "start_period": {"$date": start}}}


class Log:
    """Records written batch by batch, each taken by one run of the stream."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.offset = spark, str(folder), 0

    def write(self, *records):
        rows = []
        for topic, value in records:
            rows.append((None, value, topic, 0, self.offset, T0))
            self.offset += 1
        self.spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(self.folder)

    def stream(self):
        return self.spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(self.folder)


def redeem(transaction, name):
    return "redeem", json.dumps({"data": {"keyword": name, "transaction_id": transaction}})


def test_a_program_change_between_batches_shows(spark, tmp_path):
    log, tables = Log(spark, tmp_path / "in"), Lookups(spark, str(tmp_path / "tables"), 4)

    def run():
        io.finish(enrich_following(log.stream(), tables, str(tmp_path / "out"), str(tmp_path / "cp"), "with_event", ["transaction_id"]))

    log.write(redeem("0", "A"))  # before any table
    run()
    log.write(("program", change("insert", "p", {"name": "old"})), ("keyword", change("insert", "2", keyword("A", "p"))), redeem("1", "A"))
    log.write(("program", change("update", "p", {"name": "new"})), redeem("2", "A"))
    run()
    log.write(("keyword", change("insert", "1", keyword("A", "q"))), redeem("3", "A"))  # its program is missing
    log.write(("program", change("insert", "q", {"name": "other"})), ("program", change("delete", "p")), redeem("4", "A"))
    log.write(("keyword", change("update", "1", {"eligibility": {"name": "B"}})), redeem("5", "A"), redeem("6", "B"))
    run()
    sent = [json.loads(r["value"]) for r in io.read_batches(spark, str(tmp_path / "out")).collect()]
    got = {m["event"]["transaction_id"]: m["program"]["name"] for m in sent}
    assert got == {"1": "old", "2": "new", "3": "new", "4": "other"}
    plan = tables.first_per_name()._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "json" not in plan and "variant" not in plan  # unchanged documents are not parsed


def test_lookup_equals_the_batch_one(spark, tmp_path):
    draw, log, tables = random.Random(2), Log(spark, tmp_path / "in"), Lookups(spark, str(tmp_path / "tables"), 4)
    everything = []
    for _ in range(4):
        records = []
        for _ in range(25):
            key = str(draw.randrange(12))
            if draw.random() < 0.3:
                records.append(("program", change(draw.choice(["insert", "insert", "update", "delete"]), str(draw.randrange(6)), {"name": f"p{draw.randrange(9)}"})))
            else:
                document = keyword(draw.choice(["A", "B", "C", None]), str(draw.randrange(6)), draw.randrange(99))
                records.append(("keyword", change(draw.choice(["insert", "insert", "update", "delete"]), key, document)))
        log.write(*records)
        everything += records
    io.finish(enrich_following(log.stream(), tables, str(tmp_path / "out"), str(tmp_path / "cp")))
    from tidemark.sources.envelope import accepted, parse_changes

    def state(topic):
        rows = [(None, value, t, 0, i, T0) for i, (t, value) in enumerate(everything) if t == topic]
        return fold.fold(accepted(parse_changes(spark.createDataFrame(rows, LOG), "offset")))

    want = lookup.first_per_name(state("keyword"), state("program")).select("name", "keyword_id", "program_id", "documents")
    got = tables.first_per_name().select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.count() > 1


def test_following_join_sends_differences(spark, tmp_path):
    log, join = Log(spark, tmp_path / "in"), FollowingJoin(spark, str(tmp_path / "join"), 4)

    def run():
        io.finish(join.start(log.stream(), str(tmp_path / "cp")))
        out = spark.read.parquet(str(tmp_path / "join" / "out"))
        newest = out.agg({"batch": "max"}).first()[0]
        sent = {}
        for r in out.filter(out.batch == newest).collect():
            key = json.loads(r["key"])
            value = json.loads(r["value"]) if r["value"] else None
            sent[key["transaction_id"], key["keyword_id"]] = value and value["start_period"]
        return sent

    log.write(redeem("1", "A"), redeem("2", "B"), redeem(None, "A"))
    assert run() == {("1", None): None, ("2", None): None}
    assert len(join.result().collect()) == 2
    log.write(("keyword", change("insert", "k", keyword("A", "p", 5))), ("keyword", change("insert", "l", keyword("A", "p", 6))))
    assert run() == {("1", None): None, ("1", "k"): 5, ("1", "l"): 6}
    log.write(("keyword", change("update", "k", {"other": 1})), redeem("3", "A"))  # nothing that the join reads
    assert run() == {("3", "k"): 5, ("3", "l"): 6}
    log.write(("keyword", change("update", "k", keyword("B", "p", 7))), ("keyword", change("delete", "l")))
    assert run() == {("1", "k"): None, ("1", "l"): None, ("1", None): None, ("3", "k"): None, ("3", "l"): None, ("3", None): None, ("2", "k"): 7, ("2", None): None}
    last = {(v["transaction_id"], v["keyword_id"], v["start_period"]) for v in (json.loads(r["value"]) for r in join.result().collect())}
    assert last == {("1", None, None), ("2", "k", 7), ("3", None, None)}
