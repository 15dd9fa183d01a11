"""Folding an ordered change log into current state.

The sequential rule per document id is: an insert replaces the document, a
replace or update merges its top-level fields into an existing document, an
update also removes fields, a delete removes the document, and a replace or
update of a missing document does nothing.

It is computed without walking a log in order. Every event is split into
entries, one per touched field, plus one entry without a field name for each
insert and delete (a "barrier", which starts the document afresh). Keeping the
newest entry per (id, field) is an associative maximum, so Spark combines it
before the shuffle and a document with any number of events costs no task more
than its number of distinct fields. A field is alive if its newest entry is at
or after the newest barrier of its id.
"""

from __future__ import annotations

import json
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import session
from tidemark.functions.jsondoc import json_fields, object_from_entries, without_keys

REMOVAL_MODES = ("intended", "as_written")

# Columns of an entry table: the associative form of a change log.
ENTRY_COLUMNS = ["_id", "field", "at", "gone", "value"]

_ENTRY = "struct<field: string, phase: int, pos: int, gone: boolean, value: string>"


def change_entries(events: DataFrame, removal: str = "intended") -> DataFrame:
    """Split events (``_id, op, seq, patch, removed``) into entries.

    The values of ``patch`` are JSON texts, or variants. ``removal='intended'`` removes the named fields from the stored document
    after the update's own fields are merged; ``'as_written'`` only takes them
    out of the update's own fields before the merge.
    """
    if removal not in REMOVAL_MODES:
        raise ValueError(f"removal must be one of {REMOVAL_MODES}")

    op, patch, removed = F.col("op"), F.col("patch"), F.col("removed")
    if removal == "as_written":
        patch = without_keys(patch, removed)

    def entry(field: Column, phase: int, pos: Column, gone: Column, value: Column) -> Column:
        return F.struct(
            field.alias("field"),
            F.lit(phase).alias("phase"),
            pos.cast("int").alias("pos"),
            gone.alias("gone"),
            value.alias("value"),
        )

    opened = "variant" in events.schema["patch"].dataType.simpleString()
    none, no = F.lit(None).cast("string"), F.lit(False)
    barrier = F.when(
        op.isin("insert", "delete"), F.array(entry(none, 0, F.lit(0), op == "delete", none))
    )
    # pos keeps the last of several equal keys of one document.
    sets = F.when(
        op != "delete",
        F.transform(
            F.map_entries(patch),
            lambda pair, pos: entry(pair["key"], 0, pos, no, F.to_json(pair["value"]) if opened else pair["value"]),
        ),
    )
    parts = [barrier, sets]
    if removal == "intended":
        parts.append(
            F.when(
                op == "update",
                F.transform(removed, lambda name: entry(name, 1, F.lit(0), F.lit(True), none)),
            )
        )
    empty = F.array().cast(f"array<{_ENTRY}>")
    entries = F.concat(*[F.coalesce(part, empty) for part in parts])
    return events.select("_id", "seq", F.explode(entries).alias("e")).select(
        "_id",
        F.col("e.field").alias("field"),
        F.struct("seq", "e.phase", "e.pos").alias("at"),
        F.col("e.gone").alias("gone"),
        F.col("e.value").alias("value"),
    )


def reduce_entries(entries: DataFrame) -> DataFrame:
    """The newest entry per (id, field). Reducing twice changes nothing."""
    newest = F.max(F.struct("at", "gone", "value")).alias("e")
    return entries.groupBy("_id", "field").agg(newest).select("_id", "field", "e.*")


def with_barriers(reduced: DataFrame) -> DataFrame:
    """Add the newest barrier of each id as ``barrier`` (seq, gone), null where it has none.

    There is one barrier row per id at most after the reduction, so this is a
    join that AQE can split where an id has very many fields. The condition
    names ``gone`` so that it is not pushed below the reduction, which both sides
    then share.
    """
    own = F.when(F.col("gone").isNotNull(), F.col("field")).isNull()
    barriers = reduced.filter(own).select("_id", F.struct("at.seq", "gone").alias("barrier"))
    return reduced.join(barriers, "_id", "left")


def _since_barrier() -> Column:
    # A row of an earlier snapshot has no seq and precedes everything.
    return F.col("field").isNull() | F.col("barrier.seq").isNull() | (F.col("at.seq") >= F.col("barrier.seq"))


def live_entries(reduced: DataFrame) -> DataFrame:
    """Entries of existing documents only; the barrier stays, so ``{}`` survives."""
    exists = F.col("barrier").isNotNull() & ~F.col("barrier.gone")
    shown = F.col("field").isNull() | ~F.col("gone")
    return with_barriers(reduced).filter(exists & shown & _since_barrier()).drop("barrier")


def state_from_entries(reduced: DataFrame) -> DataFrame:
    """Current state ``(_id, document)``, the document as JSON text."""
    member = F.when(
        F.col("field").isNotNull(), F.struct(F.col("field").alias("key"), F.col("value"))
    )
    return (
        live_entries(reduced)
        .groupBy("_id")
        .agg(object_from_entries(F.collect_list(member)).alias("document"))
    )


def state_fields(reduced: DataFrame) -> DataFrame:
    """Current state in long form ``(_id, field, value)``, values as JSON text."""
    return live_entries(reduced).filter(F.col("field").isNotNull()).select("_id", "field", "value")


def damaged_rows(snapshot: DataFrame) -> DataFrame:
    """Rows of a state table whose document is not a JSON object."""
    return snapshot.filter(F.from_json("document", "map<string,variant>").isNull())


def snapshot_entries(snapshot: DataFrame, like: DataFrame) -> DataFrame:
    """An existing state table as inserts that precede every event of ``like``."""
    seq = F.lit(None).cast(like.schema["seq"].dataType)
    events = snapshot.select(
        "_id",
        F.lit("insert").alias("op"),
        seq.alias("seq"),
        json_fields("document").alias("patch"),
        F.lit(None).cast("array<string>").alias("removed"),
    )
    return change_entries(events)


def fold(events: DataFrame, snapshot: DataFrame | None = None, removal: str = "intended") -> DataFrame:
    """Events over an optional earlier state to the new state ``(_id, document)``.

    Stored rows without an event pass through with their text as it is. A stored
    document that is damaged (see ``damaged_rows``) keeps its text unless an
    insert or delete replaces it. Events are read for their entries and their ids,
    and the state for three outcomes, so both are written to the shared folder once.
    """
    if snapshot is None:
        return state_from_entries(reduce_entries(change_entries(events, removal)))
    events = session.kept(events.select("_id", "op", "seq", "patch", "removed"), "events")
    renews = F.max(F.coalesce(F.col("op").isin("insert", "delete"), F.lit(False))).alias("renewed")
    stored = snapshot.select("_id", "document").join(events.groupBy("_id").agg(renews), "_id", "left")
    stored = session.kept(stored, "stored")
    touched = stored.filter(F.col("renewed").isNotNull())
    sound = F.from_json("document", "map<string,variant>").isNotNull()
    old = snapshot_entries(touched.filter(sound).drop("renewed"), events)
    untouched = stored.filter(F.col("renewed").isNull())
    held_back = damaged_rows(touched).filter(~F.col("renewed"))
    folded = state_from_entries(reduce_entries(change_entries(events, removal).unionByName(old)))
    return folded.unionByName(untouched.drop("renewed")).unionByName(held_back.drop("renewed"))


def latest_per_key(log: DataFrame, keys: list[str], order: Column, tombstone: Column | None = None) -> DataFrame:
    """Log compaction: the last row per key; a tombstone removes the key."""
    newest = log.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in log.columns if c not in keys]), order).alias("row")
    )
    rows = newest.select(*keys, "row.*")
    return rows if tombstone is None else rows.filter(~tombstone)


def write_entries(events: DataFrame, path: str, batch_id: int, removal: str = "intended") -> None:
    """Keep one batch of a change log as reduced entries under ``path``.

    The folder of a batch is overwritten as a whole, so a batch that is run
    again after a failure leaves the same files. A batch costs its own size;
    the state so far is not rewritten.
    """
    entries = reduce_entries(change_entries(events, removal))
    entries.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch")


def compacted(reduced: DataFrame) -> DataFrame:
    """Entries that can still matter: from the newest barrier of their id on.

    Deletes and removed fields stay, one row each, so that an event which comes
    later but is older in the log cannot revive what they removed.
    """
    return with_barriers(reduced).filter(_since_barrier()).drop("barrier")


def compact_entries(spark: SparkSession, path: str, target: str) -> None:
    """Write what still matters of all batches as one batch into another folder."""
    rows = compacted(reduce_entries(read_entries(spark, path)))
    rows.write.mode("overwrite").parquet(f"{target}/batch=-1")


def _apply_paths(ordered: Column) -> Column:
    """One document per row from its surviving path entries, given in order.

    The helpers are local so that they travel to the executors with the UDF.
    """

    def set_path(document: dict, path: str, gone: bool, value: object) -> None:
        steps = path.split(".")
        place: dict | list = document
        for step, last in [(s, False) for s in steps[:-1]] + [(steps[-1], True)]:
            if last and not step:
                return
            slot: str | int = step
            if isinstance(place, list):
                # Not a place, or one so far out that filling up would be absurd.
                if not (step.isascii() and step.isdigit() and len(step) < 10):
                    return
                slot = int(step)
                if slot >= len(place) + (0 if gone else 1_500_000):
                    return
                place.extend([None] * (slot + 1 - len(place)))
            if not last:
                inside = place[slot] if isinstance(place, list) else place.get(slot)
                if not isinstance(inside, (dict, list)):
                    if gone:
                        return
                    inside = place[slot] = {}
                place = inside
            elif not gone:
                place[slot] = value
            elif isinstance(place, list):
                place[slot] = None
            else:
                place.pop(slot, None)

    def build(entries) -> str:
        document: dict = {}
        for entry in entries:
            value = None if entry["value"] is None else json.loads(entry["value"])
            set_path(document, entry["field"], entry["gone"], value)
        return json.dumps(document, separators=(",", ":"), sort_keys=True, ensure_ascii=False)

    def documents(batch: pd.Series) -> pd.Series:
        return batch.map(build)

    return F.pandas_udf(documents, "string")(ordered)


def _place_entries(events: DataFrame) -> DataFrame:
    """What still matters of dotted fields: ``_id, field, at, gone, value``, and per document a row without a field.

    A nested write also leaves an entry ``outer.`` for each object around it, which then exists even if the field itself
    is removed again.
    """
    steps = F.split("field", "\\.")
    outer = F.transform(
        F.sequence(F.lit(1), F.size(steps) - 1),
        lambda depth: F.concat(F.array_join(F.slice(steps, F.lit(1), depth), "."), F.lit(".")),
    )
    nested = F.col("field").contains(".") & ~F.col("gone")
    fields = F.when(nested, F.concat(F.array("field"), outer)).otherwise(F.array("field"))
    # A field name that ends in a dot names no place, so its removal does nothing.
    nothing = F.coalesce(F.col("gone") & (F.col("field").endswith(".") | (F.col("field") == "")), F.lit(False))
    entries = change_entries(events).filter(~nothing).select(
        "_id", F.explode(fields).alias("field"), "at", "gone", "value"
    )
    exists = F.col("barrier").isNotNull() & ~F.col("barrier.gone")
    return with_barriers(reduce_entries(entries)).filter(exists & _since_barrier()).drop("barrier")


def _through_lists(entries: DataFrame) -> DataFrame:
    """Documents built entry by entry, for those with steps into lists."""
    entry = F.when(F.col("field").isNotNull(), F.struct("at", "field", "gone", "value"))
    kept = entries.groupBy("_id").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    ordered = F.transform("entries", lambda e: F.struct(e["field"], e["gone"], e["value"]))
    return kept.select("_id", _apply_paths(ordered).alias("document"))


_PLACE = ["_id", "steps"]


def _heads(rows: DataFrame, own: bool) -> DataFrame:
    """``_id, steps`` of every place around the given places, and with ``own`` of these too, as ``head``."""
    last = F.size("steps") if own else F.size("steps") - 1
    lengths = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return rows.select(*_PLACE, F.explode(lengths).alias("n")).select(
        *_PLACE, F.slice("steps", F.lit(1), F.col("n")).alias("head")
    )


def _opened(sets: DataFrame, inner: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """Written values, objects replaced by their fields where another entry lies inside them; and those that are lists there."""
    parts, lists = [], []
    for level in range(depth):
        inside = sets.join(inner, _PLACE, "left_semi")
        lists.append(inside.filter(F.col("value").startswith("[")).select("_id"))
        is_open = F.col("value").startswith("{")
        opened = inside.filter(is_open)
        parts.append(sets.join(opened.select(*_PLACE, "at"), [*_PLACE, "at"], "left_anti").withColumn("is_object", F.lit(False)))
        if level == depth - 1:
            break
        parts.append(opened.withColumn("is_object", F.lit(True)))
        fields = opened.select("_id", "steps", "at", F.explode(json_fields("value")).alias("key", "value"))
        sets = fields.select("_id", F.concat("steps", F.array("key")).alias("steps"), "at", "value")
    return reduce(DataFrame.unionByName, parts), reduce(DataFrame.unionByName, lists).distinct()


def _assembled(nodes: DataFrame, documents: DataFrame, depth: int) -> DataFrame:
    """Documents from their places, the deepest first: one aggregation per depth."""
    below = None
    for level in range(depth, 0, -1):
        here = nodes.filter(F.size("steps") == level)
        text = F.when(F.col("is_object"), "{}").otherwise(F.col("value"))
        if below is not None:
            here = here.join(below, _PLACE, "left")
            text = F.when(F.col("is_object"), F.coalesce("inside", F.lit("{}"))).otherwise(F.col("value"))
        member = F.struct(F.element_at("steps", -1).alias("key"), text.alias("value"))
        parent = F.slice("steps", 1, level - 1).alias("steps")
        below = here.groupBy("_id", parent).agg(object_from_entries(F.collect_list(member)).alias("inside"))
    if below is None:
        return documents.select("_id", F.lit("{}").alias("document"))
    whole = documents.join(below.select("_id", "inside"), "_id", "left")
    return whole.select("_id", F.coalesce("inside", F.lit("{}")).alias("document"))


def fold_paths(events: DataFrame) -> DataFrame:
    """As ``fold``, but a dotted field name means a place inside the document.

    Entries are reduced per (id, path) as before. A written object is replaced by its fields where another entry lies
    inside it, an entry is dead if its place or one around it was written or removed later, and what is alive is put
    together from the deepest place up. A later write to an outer object replaces what was set inside it before; a
    nested write makes an object of what is around it. Documents with a step into a list are built entry by entry
    instead: a step that is no number, or lies more than 1.5 million places behind the end, is ignored there, and numbers
    are rewritten. The entries are written to the shared folder once, since they are read for each depth.
    """
    spark = events.sparkSession
    path = session.scratch_dir(spark, "places")
    _place_entries(events).write.parquet(path)
    entries = spark.read.parquet(path)
    documents = entries.filter(F.col("field").isNull()).select("_id")
    touch = F.col("field").endswith(".")
    name = F.when(touch, F.expr("left(field, length(field) - 1)")).otherwise(F.col("field"))
    placed = entries.filter(F.col("field").isNotNull() & (F.col("field") != "")).select(
        "_id", F.split(name, "\\.").alias("steps"), "at", "gone", touch.alias("touch"), "value"
    )
    depth = placed.agg(F.max(F.size("steps"))).first()[0] or 0
    if depth == 0:
        return documents.select("_id", F.lit("{}").alias("document"))
    own = placed.filter(~F.col("touch"))
    inner = _heads(own.select(*_PLACE).distinct(), own=False).select("_id", F.col("head").alias("steps")).distinct()
    sets, lists = _opened(own.filter(~F.col("gone")).select(*_PLACE, "at", "value"), inner, depth)
    touches = placed.filter("touch").select(*_PLACE, "at", F.lit(None).cast("string").alias("value"), F.lit(True).alias("is_object"))
    found = sets.select(*_PLACE, "at", "value", "is_object").unionByName(touches)
    written = own.groupBy("_id", F.col("steps").alias("head")).agg(F.max("at").alias("written"))
    resets = _heads(found.select(*_PLACE).distinct(), own=True).join(written, ["_id", "head"])
    resets = resets.groupBy(*_PLACE).agg(F.max("written").alias("reset"))
    alive = found.join(resets, _PLACE, "left").filter(F.col("reset").isNull() | (F.col("at") >= F.col("reset")))
    nodes = alive.groupBy(*_PLACE).agg(F.max("is_object").alias("is_object"), F.max_by("value", "at").alias("value"))
    if lists.isEmpty():
        return _assembled(nodes, documents, depth)
    plain = documents.join(lists, "_id", "left_anti")
    listed = _through_lists(entries.join(lists, "_id", "left_semi"))
    return _assembled(nodes.join(plain, "_id", "left_semi"), plain, depth).unionByName(listed)
