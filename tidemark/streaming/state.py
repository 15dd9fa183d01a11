"""A maintained table of current state: entries of the change log, and readable documents.

    <path>/entries     reduced entries by bucket of the document id (see ``store``)
    <path>/documents   ``(_id, document)`` by the same buckets, as of the last renewal

A batch adds its entries. Every so many batches the documents of the buckets touched since are made anew, and of
those only; a reader folds what was touched after that. Runs and pointers that are no longer needed are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import fold
from tidemark.streaming.store import Head, Store

_NONE = "_id string, document string"


def merged_entries(entries: DataFrame, last: bool) -> DataFrame:
    """Without older runs what a barrier hides can go; otherwise its rows may still be hidden by it."""
    reduced = fold.reduce_entries(entries)
    return fold.compacted(reduced) if last else reduced


def stores(spark: SparkSession, path: str, buckets: int = 64) -> tuple[Store, Store]:
    entries = Store(spark, f"{path}/entries", ["_id"], merged_entries, buckets)
    return entries, Store(spark, f"{path}/documents", ["_id"], lambda rows, last: rows, buckets)


def _folded(entries: Store, head: Head, buckets: list[int]) -> DataFrame:
    return fold.state_from_entries(fold.reduce_entries(entries.read(head, buckets)))


def add_batch(
    spark: SparkSession, path: str, events: DataFrame, batch_id: int, every: int, removal: str = "intended", buckets: int = 64
) -> None:
    """Keep one batch of events; every ``every`` batches the documents of touched buckets are renewed."""
    entries, documents = stores(spark, path, buckets)
    before = entries.head(batch_id).note

    def note(written: list[int]) -> dict:
        since = before.get("since", 0) + 1
        touched = sorted({*before.get("touched", []), *written})
        # The renewal follows the pointer; a batch run again after it finds the documents' own pointer and skips it.
        return {"since": since % every, "touched": touched if since < every else [], "renew": touched if since >= every else []}

    head = entries.commit(batch_id, fold.reduce_entries(fold.change_entries(events, removal)), note)
    if head.batch == batch_id and head.note["renew"]:
        documents.replace(batch_id, _folded(entries, head, head.note["renew"]), head.note["renew"])


def current(spark: SparkSession, path: str, buckets: int = 64) -> DataFrame:
    """``(_id, document)`` as of the last batch; only buckets changed since their renewal are folded."""
    entries, documents = stores(spark, path, buckets)
    head, stored = entries.head(), documents.head()
    if head.schema is None:
        return spark.createDataFrame([], _NONE)
    changed = set(head.note["touched"])
    if head.note["renew"] and stored.batch < head.batch:
        changed |= set(head.note["renew"])  # the renewal of the last batch has not ended
    found = _folded(entries, head, sorted(changed))
    still = documents.read(stored, set(stored.buckets) - changed)
    return found if still is None else still.select("_id", "document").unionByName(found)
