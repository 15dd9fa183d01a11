"""Lookup tables kept by their own change streams, and the joins that follow them.

A table holds, besides the entries of its change log, one row per document with the columns that lookups read. These
are made when a document changes; a lookup reads columns and never parses a document that has not changed. Every
batch first takes in the changes it carries, so its events see the tables as of that batch, again if it is repeated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.once import with_once
from tidemark.operators import fold, lookup
from tidemark.sources.envelope import accepted, parse_changes, parse_redeems
from tidemark.streaming.io import start_batches, write_batch
from tidemark.streaming.state import merged_entries
from tidemark.streaming.store import Store


def _newest(keys: list[str]) -> Callable[[DataFrame, bool], DataFrame]:
    def merge(rows: DataFrame, last: bool) -> DataFrame:
        newest = fold.latest_per_key(rows, keys, F.col("at")).select(*rows.columns)
        return newest.filter(~F.col("gone")) if last else newest

    return merge


class DocumentTable:
    """Documents of one change stream with their lookup columns, at ``path``."""

    def __init__(self, spark: SparkSession, path: str, columns: Callable[[DataFrame], DataFrame], buckets: int = 64):
        self.columns, self.now = columns, 0
        self.entries = Store(spark, f"{path}/entries", ["_id"], merged_entries, buckets)
        self.rows = Store(spark, f"{path}/rows", ["_id"], self._merge, buckets)

    def _merge(self, rows: DataFrame, last: bool) -> DataFrame:
        """The newest row of a document; that it is gone is kept through the batch that tells so."""
        newest = fold.latest_per_key(rows, ["_id"], F.col("at")).select(*rows.columns)
        return newest.filter(~F.col("gone") | (F.col("at") >= self.now)) if last else newest

    def add(self, events: DataFrame, batch_id: int) -> DataFrame | None:
        """Take in change events; the rows of the changed documents before and after, or None without changes.

        Columns: ``_id``, and as structs ``old`` and ``new`` the lookup columns; null where there is no document.
        The events are read for their ids and their entries, so they are kept meanwhile.
        """
        events = events.select("_id", "op", "seq", "patch", "removed").persist()
        try:
            return self._add(events, batch_id)
        finally:
            events.unpersist()

    def _add(self, events: DataFrame, batch_id: int) -> DataFrame | None:
        if events.isEmpty():
            return None
        before, self.now = self.rows.head(batch_id), batch_id
        # One key per changed document; its entries are read from its bucket alone.
        ids = events.select("_id").distinct()
        head = self.entries.commit(batch_id, fold.reduce_entries(fold.change_entries(events)))
        touched = self.entries.touched(ids)
        entries = self.entries.read(head, touched).join(ids, "_id", "left_semi")
        documents = self.columns(fold.state_from_entries(fold.reduce_entries(entries)))
        named = [name for name in documents.columns if name != "_id"]
        changed = ids.join(documents, "_id", "left").select(
            "_id", *named, F.lit(batch_id).cast("long").alias("at"), F.col("document").isNull().alias("gone")
        )
        now = self.rows.commit(batch_id, changed)
        fresh = self.rows.read(now, touched).filter(F.col("at") == batch_id)  # as written, not computed again
        row = F.when(~F.col("gone"), F.struct(*named))
        out = fresh.select("_id", row.alias("new"))
        if before.schema is None:
            return out.withColumn("old", F.lit(None).cast(out.schema["new"].dataType))
        old = fold.latest_per_key(self.rows.read(before, touched), ["_id"], F.col("at"))
        return out.join(old.select("_id", row.alias("old")), "_id", "left")

    def current(self) -> DataFrame | None:
        """``_id`` and the lookup columns of every document."""
        stored = self.rows.read()
        if stored is None:
            return None
        return fold.latest_per_key(stored, ["_id"], F.col("at")).filter(~F.col("gone")).drop("at", "gone")


def keyword_columns(documents: DataFrame) -> DataFrame:
    return lookup.with_lookup_keys(documents)


class Lookups:
    """Keywords and programs at ``path``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.keywords = DocumentTable(spark, f"{path}/keywords", keyword_columns, buckets)
        self.programs = DocumentTable(spark, f"{path}/programs", lambda documents: documents, buckets)

    def first_per_name(self) -> DataFrame | None:
        """``lookup.first_per_name`` from stored columns: no document is parsed, their texts are put together."""
        keywords, programs = self.keywords.current(), self.programs.current()
        if keywords is None or programs is None:
            return None
        with_program = keywords.filter(F.col("name").isNotNull()).join(
            programs.select(F.col("_id").alias("program_id")), "program_id", "left_semi"
        )
        first = with_program.groupBy("name").agg(F.min_by(F.struct("_id", "program_id", "document"), "_id").alias("k"))
        program = programs.select(F.col("_id").alias("program_id"), F.col("document").alias("program_doc"))
        both = first.select("name", F.col("k._id").alias("keyword_id"), "k.program_id", F.col("k.document").alias("keyword_doc"))
        text = F.concat(F.lit('{"keyword":'), "keyword_doc", F.lit(',"program":'), "program_doc", F.lit(',"customer":null}'))
        return with_once(both.join(program, "program_id"), "documents", text).drop("keyword_doc", "program_doc")

    def add(self, batch: DataFrame, batch_id: int, order: str = "offset") -> DataFrame | None:
        """Take in the changes among some log records; the changed keywords as ``DocumentTable.add`` gives them."""
        topic = F.col("topic")
        self.programs.add(accepted(parse_changes(batch.filter(topic == "program"), order)), batch_id)
        return self.keywords.add(accepted(parse_changes(batch.filter(topic == "keyword"), order)), batch_id)


def enrich_following(
    records: DataFrame,
    lookups: Lookups,
    path: str,
    checkpoint: str,
    mode: str = "documents_only",
    event_columns: list[str] | None = None,
    continuous: bool = False,
) -> StreamingQuery:
    """Redeem, keyword and program records of one log to outgoing messages, by the tables as of each batch."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        lookups.add(batch, batch_id)
        table = lookups.first_per_name()
        if table is None:
            return
        events = accepted(parse_redeems(batch.filter(F.col("topic") == "redeem")))
        write_batch(lookup.message(lookup.matched(lookup.enrich(events, table)), mode, event_columns), path, batch_id)

    return start_batches(records, apply, checkpoint, continuous, reused=True)


_PERIOD = ["keyword_id", "start_period", "end_period"]


class FollowingJoin:
    """Redeems left-joined with every keyword of their name, as a changing result at ``path``.

    A result row has the key (transaction_id, keyword_id), where keyword_id is null for a redeem without a keyword. Each
    batch sends what changed, as key and value text: new redeems with the keywords of the moment, and for the redeems
    of every name that a changed keyword has or had, the rows that are new or different, and a null value for rows
    that are gone. Redeems and keywords are stored by name, so only the buckets of changed names are read.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path = spark, path
        self.lookups = Lookups(spark, f"{path}/lookups", buckets)
        self.redeems = Store(spark, f"{path}/redeems", ["keyword"], lambda rows, last: rows.distinct(), buckets)
        self.named = Store(spark, f"{path}/named", ["keyword"], _newest(["keyword", "keyword_id"]), buckets)

    def _keywords(self, head, names: DataFrame | None = None) -> DataFrame:
        rows = self.named.read(head, None if names is None else self.named.touched(names))
        if rows is None:
            return self.spark.createDataFrame([], "keyword string, keyword_id string, start_period long, end_period long")
        return fold.latest_per_key(rows, ["keyword", "keyword_id"], F.col("at")).filter(~F.col("gone")).drop("at", "gone")

    def add_batch(self, batch: DataFrame, batch_id: int) -> None:
        changed = self.lookups.add(batch, batch_id)
        before, stored = self.named.head(batch_id), self.redeems.head(batch_id)
        new = accepted(parse_redeems(batch.filter(F.col("topic") == "redeem")))
        new = new.filter(F.col("transaction_id").isNotNull()).select("keyword", "transaction_id").distinct().persist()
        after, sent, cached = before, [], [new]
        try:
            if changed is not None:
                changed = changed.persist()
                after = self.named.commit(batch_id, self._moved(changed, batch_id))
                names = changed.select(F.explode(F.array("old.name", "new.name")).alias("keyword")).dropna().distinct().persist()
                cached += [changed, names]
                if stored.schema is not None:
                    affected = self.redeems.read(stored, self.redeems.touched(names)).join(names, "keyword", "left_semi")
                    sent.append(self._difference(affected.distinct(), self._keywords(before, names), self._keywords(after, names)))
            sent.append(new.join(self._keywords(after), "keyword", "left").withColumn("gone", F.lit(False)))
            messages = sent[0] if len(sent) == 1 else sent[0].unionByName(sent[1])
            key = F.to_json(F.struct("transaction_id", "keyword_id"), {"ignoreNullFields": "false"})
            value = F.to_json(F.struct("transaction_id", "keyword", *_PERIOD), {"ignoreNullFields": "false"})
            out = messages.select(key.alias("key"), F.when(~F.col("gone"), value).alias("value"))
            write_batch(out, f"{self.path}/out", batch_id)
            self.redeems.commit(batch_id, new)
        finally:
            for rows in cached:
                rows.unpersist()

    def _moved(self, changed: DataFrame, batch_id: int) -> DataFrame:
        """Changed keywords under their names: what one leaves is marked gone there."""

        def under(side: str, gone) -> DataFrame:
            columns = [F.col(f"{side}.name").alias("keyword"), F.col("_id").alias("keyword_id")]
            periods = [F.col(f"{side}.{name}").alias(name) for name in _PERIOD[1:]]
            return changed.filter(F.col(f"{side}.name").isNotNull()).select(
                *columns, *periods, F.lit(batch_id).cast("long").alias("at"), gone.alias("gone")
            )

        left = under("old", F.lit(True)).filter(~F.col("old.name").eqNullSafe(F.col("new.name")))
        return left.unionByName(under("new", F.lit(False)))

    def _difference(self, redeems: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
        """Result rows of these redeems that changed between two states, and those that are gone."""
        key = ["transaction_id", "keyword", "keyword_id"]
        now = redeems.join(after, "keyword", "left").withColumn("now", F.lit(1))
        then = redeems.join(before, "keyword", "left").withColumn("now", F.lit(0))
        both = now.unionByName(then).groupBy(*key).agg(
            F.max("now").alias("last"),
            F.min("now").alias("first"),
            F.max_by(F.struct(*_PERIOD[1:]), "now").alias("new"),
            F.min_by(F.struct(*_PERIOD[1:]), "now").alias("old"),
        )
        moved = (F.col("last") == 0) | (F.col("first") == 1) | ~F.col("old").eqNullSafe(F.col("new"))
        return both.filter(moved).select(*key, "new.*", (F.col("last") == 0).alias("gone"))

    def start(self, records: DataFrame, checkpoint: str, continuous: bool = False) -> StreamingQuery:
        return start_batches(records, self.add_batch, checkpoint, continuous, reused=True)

    def result(self) -> DataFrame:
        """The last message of every key: what a reader of the messages holds."""
        sent = self.spark.read.parquet(f"{self.path}/out")
        return fold.latest_per_key(sent, ["key"], F.col("batch"), F.col("value").isNull()).select("key", "value")
