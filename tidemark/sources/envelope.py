"""Log records to typed events, with everything unusable kept aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.jsondoc import exact_fields, is_json, marked, marked_name, unwrap_id
from tidemark.functions.once import with_once
from tidemark.functions.times import epoch_ms, resolve_event_ms
from tidemark.sources import schemas

# The documents of a change event, read from marked text.
_DOCUMENTS = f"""
    `{marked_name("fullDocument")}` map<string, string>,
    `{marked_name("updateDescription")}` struct<`{marked_name("updatedFields")}`: map<string, string>>,
    _malformed string
"""

OPERATIONS = ("insert", "replace", "update", "delete")


def parse_json(records: DataFrame, ddl: str, malformed: str | None = "_malformed") -> DataFrame:
    """Decode ``value`` into the struct column ``event``.

    A field of the wrong type becomes null and the others survive, also in text
    that breaks off later; either fills ``malformed``.
    """
    options = {"mode": "PERMISSIVE"}
    if malformed:
        options["columnNameOfCorruptRecord"] = malformed
    return with_once(records, "event", F.from_json("value", ddl, options))


def parse_changes(records: DataFrame, order: Column | str | None = None, now: Column | None = None) -> DataFrame:
    """Change events of a log, one row per record, nothing dropped.

    Columns: ``_id``, ``op``, ``seq`` (total order per id, by default the place
    in the log), ``event_ms``, ``patch`` (document of an insert or replace, the
    changed fields of an update: names and JSON texts, numbers as they are written), ``removed``, ``db``, ``coll``, ``reject``
    (null for a usable event, else the reason) and the raw ``value``.
    """
    event, documents = F.col("event"), F.col("documents")
    whole_document = documents[marked_name("fullDocument")]
    changed_fields = documents[marked_name("updateDescription")][marked_name("updatedFields")]
    seq = F.struct("partition", "offset") if order is None else F.col(order) if isinstance(order, str) else order
    op = event["operationType"]
    document_id = unwrap_id(event["documentKey"]["_id"])
    whole = op.isin("insert", "replace")
    cluster = F.coalesce(event["clusterTime"]["$timestamp"]["t"], event["clusterTime"]["t"])
    broken, unread = event["_malformed"].isNotNull(), documents["_malformed"].isNotNull()
    reject = (
        F.when(broken & ((op.isNull() & document_id.isNull()) | ~is_json(F.col("value"))), "malformed_json")
        .when(document_id.isNull(), "missing_key")
        .when(op.isNull() | ~op.isin(*OPERATIONS), "unknown_operation")
        .when(unread & whole & whole_document.isNull(), "invalid_document")
        .when(unread & (op == "update") & changed_fields.isNull(), "invalid_document")
    )
    parsed = parse_json(records, schemas.CHANGE_HEAD)
    read = F.from_json(marked("value"), _DOCUMENTS, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"})
    return with_once(parsed, "documents", read).select(
        document_id.alias("_id"),
        op.alias("op"),
        seq.alias("seq"),
        resolve_event_ms(epoch_ms(event["wallTime"]["$date"]), cluster, now).alias("event_ms"),
        exact_fields(F.when(whole, whole_document).when(op == "update", changed_fields)).alias("patch"),
        F.when(op == "update", event["updateDescription"]["removedFields"]).alias("removed"),
        event["ns"]["db"].alias("db"),
        event["ns"]["coll"].alias("coll"),
        reject.alias("reject"),
        "value",
    )


def accepted(events: DataFrame) -> DataFrame:
    return events.filter(F.col("reject").isNull()).drop("reject", "value")


def rejected(events: DataFrame) -> DataFrame:
    """The side table: position, reason and raw text of every unusable record."""
    return events.filter(F.col("reject").isNotNull()).select("seq", "_id", "op", "reject", "value")


def full_documents(records: DataFrame, ddl: str) -> DataFrame:
    """Unwrap the envelope: only the document, typed by ``ddl``, where there is one."""
    parsed = parse_json(records, f"fullDocument struct<{ddl}>", malformed=None)
    return parsed.filter(F.col("event.fullDocument").isNotNull()).select("event.fullDocument.*")


def parse_redeems(records: DataFrame, now: Column | None = None) -> DataFrame:
    """Redeem events with the record metadata as columns.

    ``keyword`` also accepts the older field name; the business key is the
    transaction id inside ``data``. Event time is the time of arrival.
    """
    event = F.col("event")
    data = event["data"]
    keyword = F.coalesce(data["keyword"], data["keyword_id"])
    reject = (
        F.when(event["_malformed"].isNotNull() & (data.isNull() | ~is_json(F.col("value"))), "malformed_json")
        .when(keyword.isNull(), "missing_keyword")
    )
    return parse_json(records, schemas.REDEEM_EVENT).select(
        data["transaction_id"].alias("transaction_id"),
        keyword.alias("keyword"),
        data["msisdn"].alias("msisdn"),
        data["locale"].alias("locale"),
        data["channel_id"].alias("channel_id"),
        data["callback_url"].alias("callback_url"),
        data["transaction_source"].alias("transaction_source"),
        data["send_notification"].alias("send_notification"),
        data["additional"].alias("additional"),
        unwrap_id(event["account"]["_id"]).alias("account_id"),
        event["account"]["user_id"].alias("user_id"),
        event["token"].alias("token"),
        event["transaction_id"].alias("request_id"),
        event["path"].alias("path"),
        event["keyword_priority"].alias("keyword_priority"),
        F.col("timestamp").alias("kafka_timestamp"),
        "partition",
        "offset",
        (F.current_timestamp() if now is None else now).alias("event_time"),
        reject.alias("reject"),
        "value",
    )
