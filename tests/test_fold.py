"""The fold against a walk through the log in order."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import fold
from tidemark.sources import envelope

LOG = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"


def records(spark, events, start=0):
    rows = [(e["documentKey"]["_id"]["$oid"], json.dumps(e), "t", 0, start + i, None) for i, e in enumerate(events)]
    return spark.createDataFrame(rows, LOG)


def parsed(spark, events, start=0):
    return envelope.accepted(envelope.parse_changes(records(spark, events, start), "offset"))


def event(op, key, doc=None, updated=None, removed=None):
    made = {"operationType": op, "documentKey": {"_id": {"$oid": key}}}
    if doc is not None:
        made["fullDocument"] = doc
    if op == "update":
        made["updateDescription"] = {"updatedFields": updated or {}, "removedFields": removed or []}
    return made


def walk(events, removal="intended", state=None):
    state = {k: dict(v) for k, v in (state or {}).items()}
    for e in events:
        key, op = e["documentKey"]["_id"]["$oid"], e["operationType"]
        if op == "insert":
            state[key] = dict(e.get("fullDocument") or {})
        elif op == "delete":
            state.pop(key, None)
        elif key in state:
            if op == "replace":
                state[key].update(e.get("fullDocument") or {})
            else:
                change = e["updateDescription"]
                fields = dict(change["updatedFields"])
                if removal == "as_written":
                    fields = {k: v for k, v in fields.items() if k not in change["removedFields"]}
                state[key].update(fields)
                if removal == "intended":
                    for name in change["removedFields"]:
                        state[key].pop(name, None)
    return state


def documents(frame):
    return {row["_id"]: json.loads(row["document"]) for row in frame.collect()}


def random_log(seed, size=600):
    rng = random.Random(seed)
    names = ["a", "b", "c", "a.b", 'qu"ote', "d"]
    values = [1, -2.5, "x", "", None, True, [1, {"z": None}], {"n": {"m": 1}}, {}]

    def doc():
        return {rng.choice(names): rng.choice(values) for _ in range(rng.randint(0, 4))}

    log = []
    for _ in range(size):
        key = f"id{rng.randint(0, 25)}"
        op = rng.choice(["insert", "replace", "update", "update", "update", "delete"])
        removed = rng.sample(names, rng.randint(0, 2))
        log.append(event(op, key, doc() if op in ("insert", "replace") else None, doc(), removed))
    return log


@pytest.mark.parametrize("removal", fold.REMOVAL_MODES)
@pytest.mark.parametrize("seed", [1, 2])
def test_random_log(spark, seed, removal):
    log = random_log(seed)
    assert documents(fold.fold(parsed(spark, log), removal=removal)) == walk(log, removal)


@pytest.mark.parametrize("removal", fold.REMOVAL_MODES)
def test_batches_over_a_snapshot(spark, removal):
    log = random_log(3)
    snapshot = spark.createDataFrame([], "_id string, document string")
    for start in (0, 200, 400):
        batch = parsed(spark, log[start : start + 200], start)
        rows = fold.fold(batch, snapshot, removal).collect()
        snapshot = spark.createDataFrame(rows, "_id string, document string")
    assert documents(snapshot) == walk(log, removal)


def test_replay_over_the_final_state_changes_nothing(spark):
    log = random_log(4)
    final = fold.fold(parsed(spark, log))
    again = fold.fold(parsed(spark, log[300:], 300), final)
    assert documents(again) == walk(log)


def test_entries_written_in_batches(spark, tmp_path):
    log = random_log(5)
    path, compact = str(tmp_path / "entries"), str(tmp_path / "compact")
    for batch_id, start in enumerate((0, 200)):
        fold.write_entries(parsed(spark, log[start : start + 200], start), path, batch_id)
    fold.write_entries(parsed(spark, log[200:400], 200), path, 1)  # the batch again
    fold.compact_entries(spark, path, compact)
    fold.write_entries(parsed(spark, log[400:], 400), path, 2)
    fold.write_entries(parsed(spark, log[400:], 400), compact, 2)
    for folder in (path, compact):
        reduced = fold.reduce_entries(fold.read_entries(spark, folder))
        assert documents(fold.state_from_entries(reduced)) == walk(log)


def test_hand_made_cases(spark):
    log = [
        event("update", "early", updated={"x": 1}),
        event("insert", "early", {"y": 1}),
        event("insert", "gone", {"y": 1}),
        event("delete", "gone"),
        event("update", "gone", updated={"x": 1}),
        event("insert", "kept", {"old": 1, "both": 1}),
        event("replace", "kept", {"both": 2}),
        event("insert", "empty"),
        event("insert", "dotted", {"a": {"b": 1}}),
        event("update", "dotted", updated={"a.b": 2}),
        event("insert", "null", {"n": 1}),
        event("update", "null", updated={"n": None}),
        event("replace", "missing", {"n": 1}),
        event("insert", "explicit"),
    ]
    log[-1]["fullDocument"] = None
    assert documents(fold.fold(parsed(spark, log))) == {
        "early": {"y": 1},
        "kept": {"old": 1, "both": 2},
        "empty": {},
        "dotted": {"a": {"b": 1}, "a.b": 2},
        "null": {"n": None},
        "explicit": {},
    }


def test_removal_modes_differ(spark):
    log = [event("insert", "k", {"a": 1, "b": 1}), event("update", "k", updated={"a": 2, "b": 2}, removed=["b"])]
    events = parsed(spark, log)
    assert documents(fold.fold(events, removal="intended")) == {"k": {"a": 2}}
    assert documents(fold.fold(events, removal="as_written")) == {"k": {"a": 2, "b": 1}}
    with pytest.raises(ValueError):
        fold.change_entries(events, "other")


def test_last_of_repeated_fields_wins(spark):
    text = '{"operationType":"insert","documentKey":{"_id":{"$oid":"k"}},"fullDocument":{"a":1,"b":{"x":1,"x":2},"a":3}}'
    log = spark.createDataFrame([("k", text, "t", 0, 0, None)], LOG)
    events = envelope.accepted(envelope.parse_changes(log))
    assert documents(fold.fold(events)) == {"k": {"a": 3, "b": {"x": 2}}}


def test_order_is_the_log_position_not_the_row_order(spark):
    log = [event("insert", "k", {"a": 1}), event("update", "k", updated={"a": 2}), event("update", "k", updated={"a": 3})]
    shuffled = records(spark, log).orderBy(F.col("offset").desc())
    events = envelope.accepted(envelope.parse_changes(shuffled))
    assert documents(fold.fold(events)) == {"k": {"a": 3}}


def test_duplicate_delivery(spark):
    log = random_log(6, 200)
    twice = records(spark, log).unionByName(records(spark, log))
    events = envelope.accepted(envelope.parse_changes(twice, "offset"))
    assert documents(fold.fold(events)) == walk(log)


def set_path(document, path, value=None, gone=False):
    steps = path.split(".")
    for step in steps[:-1]:
        if not isinstance(document.get(step), dict):
            if gone:
                return
            document[step] = {}
        document = document[step]
    if gone:
        document.pop(steps[-1], None)
    else:
        document[steps[-1]] = value


@pytest.mark.parametrize("seed", [7, 8])
def test_paths(spark, seed):
    rng = random.Random(seed)
    paths = ["a", "a.b", "a.b.c", "a.d", "e.f", "g"]
    log, want = [], {}
    for _ in range(400):
        key = f"id{rng.randint(0, 12)}"
        if rng.random() < 0.1:
            log.append(event("insert", key, {"g": 0}))
            want[key] = {"g": 0}
            continue
        fields = {rng.choice(paths): rng.choice([1, {"x": 1}, {}, "s"])}
        removed = [p for p in rng.sample(paths, rng.randint(0, 1)) if p not in fields]
        log.append(event("update", key, updated=fields, removed=removed))
        if key in want:
            for path, value in fields.items():
                set_path(want[key], path, json.loads(json.dumps(value)))
            for path in removed:
                set_path(want[key], path, gone=True)
    assert documents(fold.fold_paths(parsed(spark, log))) == want


def test_paths_into_arrays(spark):
    log = [
        event("insert", "k", {"list": [{"n": 1}, {"n": 2}]}),
        event("update", "k", updated={"list.1.n": 5, "list.3": 7}),
    ]
    assert documents(fold.fold_paths(parsed(spark, log))) == {"k": {"list": [{"n": 1}, {"n": 5}, None, 7]}}


def test_reducing_is_associative(spark):
    log = random_log(9, 300)
    entries = fold.change_entries(parsed(spark, log))
    halves = fold.reduce_entries(entries.filter("at.seq % 2 = 0")).unionByName(
        fold.reduce_entries(entries.filter("at.seq % 2 = 1"))
    )
    assert documents(fold.state_from_entries(fold.reduce_entries(halves))) == walk(log)


def test_latest_per_key(spark):
    log = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, "y"), ("b", 3, "z")], "k string, o int, v string")
    assert {tuple(r) for r in fold.latest_per_key(log, ["k"], "o").collect()} == {("a", 2, None), ("b", 3, "z")}
    live = fold.latest_per_key(log, ["k"], "o", F.col("v").isNull())
    assert [tuple(r) for r in live.collect()] == [("b", 3, "z")]


def test_older_events_after_compaction(spark, tmp_path):
    """An event that arrives late but is older in the log gives the same with and without compaction."""
    log = [event("insert", "a", {"x": 1}), event("update", "b", updated={"y": 1}), event("delete", "a")]
    log += [event("insert", "c", {"x": 1, "z": 1}), event("update", "c", removed=["x"])]
    late = [event("insert", "a", {"x": 9}), event("insert", "b", {"x": 2}), event("update", "c", updated={"x": 5})]
    path, compact = str(tmp_path / "entries"), str(tmp_path / "compact")
    fold.write_entries(parsed(spark, log, 10), path, 0)
    fold.compact_entries(spark, path, compact)
    got = []
    for folder in (path, compact):
        fold.write_entries(parsed(spark, late, 1), folder, 1)
        reduced = fold.reduce_entries(fold.read_entries(spark, folder))
        got.append(documents(fold.state_from_entries(reduced)))
    assert got[0] == got[1] == {"b": {"x": 2, "y": 1}, "c": {"z": 1}}


def test_stored_rows(spark):
    stored = [("same", '{ "x" : 1.10 }'), ("bad", '{"x":1'), ("worse", "[1]"), ("new", "{oops"), ("sound", '{"x":1}')]
    snapshot = spark.createDataFrame(stored, "_id string, document string")
    log = [event("update", "bad", updated={"y": 1}), event("insert", "new", {"y": 1}), event("update", "sound", updated={"y": 1})]
    got = {row["_id"]: row["document"] for row in fold.fold(parsed(spark, log), snapshot).collect()}
    assert got == {**dict(stored), "new": '{"y":1}', "sound": '{"x":1,"y":1}'}
    assert {row["_id"] for row in fold.damaged_rows(snapshot).collect()} == {"bad", "worse", "new"}


def test_steps_into_lists(spark):
    log = [
        event("insert", "l", {"l": [1, {"a": 2}]}),
        event("update", "l", updated={"l.foo": 1, "l.99999999999": 1, "l.7000000": 1, "l.2": 3, "l.1.a": 5}),
        event("update", "l", removed=["l.0", "l.9"]),
    ]
    assert documents(fold.fold_paths(parsed(spark, log))) == {"l": {"l": [None, {"a": 5}, 3]}}


def test_no_window_in_the_plan(spark):
    frame = fold.state_fields(fold.reduce_entries(fold.change_entries(parsed(spark, random_log(6)))))
    assert "Window" not in frame._jdf.queryExecution().toString()


def test_values_keep_their_characters(spark):
    """Numbers, strings that look like numbers or markers, escapes, and nesting."""
    big = "1234567890" * 5
    document = (
        '{"a":1.10,"b":' + big + ',"c":{"x":-0.50,"y":[1e2,null,"1.10",{"z":7E-3,"q":"a\\"1.5\\""}]},"d":null,'
        '"e.f":"t\\"2.50\\\\","g":"\ue0001.5","h":true,"i":"[1.0]","j":-0,"1.50":"","k":[],"l":{}}'
    )
    value = '{"operationType": "insert", "fullDocument": ' + document + ', "documentKey": {"_id": {"$oid": "a"}}}'
    rows = spark.createDataFrame([("a", value, "t", 0, 1, None)], LOG)
    state = fold.fold(envelope.accepted(envelope.parse_changes(rows, "offset")))
    text = state.first()["document"]
    fields = {"a": "1.10", "b": big, "j": "-0", "c": '{"x":-0.50,"y":[1e2,null,"1.10",{"z":7E-3,"q":"a\\"1.5\\""}]}'}
    for name, want in fields.items():
        assert f'"{name}":{want}' in text
    assert json.loads(text) == json.loads(document)
    # A stored document keeps them too when a later event touches it.
    change = '{"operationType":"update","updateDescription":{"updatedFields":{"m":0.10}},"documentKey":{"_id":{"$oid":"a"}}}'
    events = envelope.accepted(envelope.parse_changes(spark.createDataFrame([("a", change, "t", 0, 2, None)], LOG), "offset"))
    again = fold.fold(events, state).first()["document"]
    assert all(f'"{name}":{want}' in again for name, want in (fields | {"m": "0.10"}).items())


@pytest.mark.parametrize("document,reject", [("5", "invalid_document"), ("[1]", "invalid_document"), ('"x"', "invalid_document"), ("null", None), ("{}", None)])
def test_documents_that_are_no_objects(spark, document, reject):
    value = '{"operationType":"insert","fullDocument":' + document + ',"documentKey":{"_id":{"$oid":"a"}}}'
    rows = spark.createDataFrame([("a", value, "t", 0, 1, None)], LOG)
    assert envelope.parse_changes(rows, "offset").first()["reject"] == reject


def set_place(document, path, value=None, gone=False):
    """A walk with lists: numbers are places in them, other steps are ignored, and so is an empty last step."""
    *outer, last = path.split(".")
    where = document
    for step in outer:
        if isinstance(where, list):
            if not step.isdigit() or (gone and int(step) >= len(where)):
                return
            where += [None] * (int(step) + 1 - len(where))
            step = int(step)
        inside = where[step] if isinstance(where, list) else where.get(step)
        if not isinstance(inside, (dict, list)):
            if gone:
                return
            inside = where[step] = {}
        where = inside
    if not last:
        return
    if isinstance(where, list):
        if not last.isdigit() or (gone and int(last) >= len(where)):
            return
        where += [None] * (int(last) + 1 - len(where))
        where[int(last)] = None if gone else value
    elif gone:
        where.pop(last, None)
    else:
        where[last] = value


@pytest.mark.parametrize("seed", [31, 32])
def test_places_among_objects_and_lists(spark, seed):
    """Written objects with fields that later entries reach into, names with dots and blanks inside them, and some lists."""
    rng = random.Random(seed)
    paths = ["a", "a.b", "a.b.c", "a.b.c.d", "a..e", "f.g", "f", "h.", "", "l", "l.0", "l.2.x"]
    values = [1, "s", None, {"b": {"c": {"d": 1, "z.z": 2}, "y": 0}, "": {"e": 5}}, {"c": 3}, {}, {"b": 7}, {"g": {"": 1}}]
    log, want = [], {}
    for _ in range(500):
        key = f"id{rng.randint(0, 14)}"
        if rng.random() < 0.08:
            log.append(event("insert", key, {"f": {"g": 0, "k": 1}}))
            want[key] = {"f": {"g": 0, "k": 1}}
            continue
        some = paths if key in ("id0", "id1") else paths[:-3]
        path = rng.choice(some)
        fields = {path: [1, {"x": 2}] if path == "l" and rng.random() < 0.5 else rng.choice(values)}
        removed = [p for p in rng.sample(some, rng.randint(0, 1)) if p not in fields]
        log.append(event("update", key, updated=fields, removed=removed))
        if key in want:
            for name, value in fields.items():
                set_place(want[key], name, json.loads(json.dumps(value)))
            for name in removed:
                set_place(want[key], name, gone=True)
    got = documents(fold.fold_paths(parsed(spark, log)))
    assert got == want


def test_places_keep_numbers(spark):
    value = '{"operationType":"insert","fullDocument":{"a":{"b":1.10,"c":{"d":2.50}}},"documentKey":{"_id":{"$oid":"k"}}}'
    change = '{"operationType":"update","updateDescription":{"updatedFields":{"a.c.e":0.30}},"documentKey":{"_id":{"$oid":"k"}}}'
    rows = spark.createDataFrame([("k", value, "t", 0, 1, None), ("k", change, "t", 0, 2, None)], LOG)
    state = fold.fold_paths(envelope.accepted(envelope.parse_changes(rows, "offset")))
    assert state.first()["document"] == '{"a":{"b":1.10,"c":{"d":2.50,"e":0.30}}}'
