"""Registered queries over the change log."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import session
from tidemark.functions.jsondoc import document_text, fields_text, merge_objects, unwrap_id, without_keys
from tidemark.operators import fold, lookup, tables
from tidemark.plans import fixtures
from tidemark.sources import envelope, schemas, specs

OFFSET = "offset"


def _events(spark, folder, **options):
    records = fixtures.change_log(spark, folder, **options)
    return envelope.accepted(envelope.parse_changes(records, OFFSET))


def fold_state(spark, folder):
    return fold.fold(_events(spark, folder, removals=False))


def fold_intended(spark, folder):
    return fold.fold(_events(spark, folder), removal="intended")


def fold_as_written(spark, folder):
    return fold.fold(_events(spark, folder), removal="as_written")


def fold_fields(spark, folder):
    return fold.state_fields(fold.reduce_entries(fold.change_entries(_events(spark, folder))))


def fold_guarded(spark, folder):
    return fold.fold(_events(spark, folder, broken=True))


def fold_snapshot(spark, folder):
    """The log up to a moment as snapshot, then the rest over it."""
    events = session.kept(_events(spark, folder), "log")
    moment = F.unix_millis(F.lit("2024-01-15 00:00:00").cast("timestamp"))
    earlier, later = F.col("event_ms") < moment, F.col("event_ms") >= moment
    return fold.fold(events.filter(later), fold.fold(events.filter(earlier)))


def fold_paths(spark, folder):
    return fold.fold_paths(fixtures.nested_change_log(spark, folder))


def latest_per_key(spark, folder):
    records = fixtures.change_log(spark, folder).select("key", "offset", "value")
    deleted = F.get_json_object("value", "$.operationType") == "delete"
    tombstoned = records.withColumn("value", F.when(~deleted, F.col("value")))
    latest = fold.latest_per_key(tombstoned, ["key"], OFFSET, F.col("value").isNull())
    return latest.select("key", "offset")


def _documents(spark, folder):
    parsed = envelope.parse_json(fixtures.change_log(spark, folder), schemas.CHANGE_EVENT)
    return parsed.select(
        unwrap_id(F.col("event.documentKey._id")).alias("_id"),
        F.to_json("event.fullDocument", {"ignoreNullFields": "false"}).alias("document"),
        F.col("event.operationType").alias("operationType"),
        "offset",
    )


def upsert_filter(spark, folder):
    """Inserts and updates into the keyed table of customers."""
    rows = _documents(spark, folder).filter(F.col("operationType").isin("insert", "update"))
    table = fixtures.keywords(spark, folder).withColumn("operationType", F.lit("insert"))
    return tables.upsert(table, rows, ["_id"], OFFSET)


def delete_semi(spark, folder):
    gone = _documents(spark, folder).filter(F.col("operationType") == "delete")
    return tables.delete_keys(fixtures.keywords(spark, folder), gone, ["_id"])


def conditional_document(spark, folder):
    """Keyed messages of inserts, updates and deletes; a delete has a null document."""
    rows = _documents(spark, folder).filter(F.col("operationType").isin("insert", "update", "delete"))
    document = F.when(F.col("operationType") == "delete", None).otherwise(F.col("document"))
    return rows.select("_id", document.alias("document"), "offset")


def keyed_messages(spark, folder):
    rows = _documents(spark, folder).select("_id", "operationType", "offset")
    return lookup.keyed_message(rows, "_id", F.col("operationType") == "delete")


def event_time(spark, folder):
    now = F.lit("2030-01-01 00:00:00").cast("timestamp")
    events = envelope.parse_changes(fixtures.change_log(spark, folder), OFFSET, now)
    return events.select(F.col("seq").alias("event_id"), "event_ms")


def event_time_now(spark, folder):
    """Events without any time take that of their processing."""
    now = F.lit("2030-01-01 00:00:00").cast("timestamp")
    events = envelope.parse_changes(fixtures.change_log(spark, folder, timeless=True), OFFSET, now)
    return events.select(F.col("seq").alias("event_id"), "event_ms")


def rejects(spark, folder):
    events = envelope.parse_changes(fixtures.change_log(spark, folder, broken=True), OFFSET)
    return envelope.rejected(events).select(F.col("seq").alias("event_id"), "reject")


def full_document(spark, folder):
    records = fixtures.change_log(spark, folder)
    return envelope.full_documents(records, "cents: bigint, k: bigint, last_type: string")


def points_rows(spark, folder):
    return specs.points_rows(fixtures.points_log(spark, folder), schemas.POINTS_EVENT)


_SPEC = """{"table": {
  "identifier": {"catalog": "lake", "database": "default", "table": "user_changes"},
  "schema": {"columns": [
    {"name": "operationType", "type": "STRING"},
    {"name": "wallTime", "type": "ROW<`$date` BIGINT>"},
    {"name": "fullDocument", "type": "ROW<`k` BIGINT, `last_type` STRING>"},
    {"name": "documentKey", "type": "ROW<`_id` ROW<`$oid` STRING>>"}]},
  "options": {"connector": "kafka", "topic": "users", "properties.bootstrap.servers": "broker:9092"},
  "comment": "User change events"}}"""


def declared_table(spark, folder):
    decoded = specs.decode(specs.load_spec(_SPEC), fixtures.change_log(spark, folder))
    return decoded.select(
        F.col("documentKey._id.`$oid`").alias("_id"),
        "operationType",
        F.col("wallTime.`$date`").alias("wall_ms"),
        F.col("fullDocument.k").alias("k"),
        F.col("fullDocument.last_type").alias("last_type"),
    )


_NESTED_SPEC = """{"table": {
  "identifier": {"database": "default", "table": "customer_orders"},
  "schema": {"columns": [
    {"name": "id", "type": "BIGINT"},
    {"name": "profile", "type": "ROW<nation ROW<`key` INT>>"},
    {"name": "orders", "type": "ARRAY<ROW<`key` BIGINT, `lines` ARRAY<ROW<`no` INT, part ROW<`key` BIGINT>, flags ARRAY<ROW<kind STRING, codes ARRAY<STRING>>>>>>>"}]}}}"""


def nested_rows(spark, folder):
    """Arrays of rows five levels deep, decoded by the declared type and unnested down to the last."""
    decoded = specs.decode(specs.load_spec(_NESTED_SPEC), fixtures.nested_records(spark, folder))
    return specs.unnest(decoded, ("orders", "lines", "flags", "codes"))


def verify_written(spark, folder):
    """Look every inserted id up in the folded state."""
    events = session.kept(_events(spark, folder).select("_id", "op", "seq", "patch", "removed"), "log")
    return tables.verify_written(events.filter(F.col("op") == "insert"), fold.fold(events))


def fold_exact(spark, folder):
    """Values come out with the digits they were written with."""
    return fold.fold(envelope.accepted(envelope.parse_changes(fixtures.exact_change_log(spark, folder), "offset")))


def update_documents(spark, folder):
    """Changed fields as JSON text, an absent document as ``{}``."""
    events = _events(spark, folder)
    return events.select(F.col("seq").alias("event_id"), fields_text(F.col("patch")).alias("document"))


def merge_remove(spark, folder):
    """Shallow merge of two objects, right side winning, less one field."""
    rows = fixtures.table(spark, folder, "events").selectExpr(
        "event_id",
        "concat('{\"a\":', event_id, ',\"b\":{\"x\":', user_id, '}}') AS l",
        "concat('{\"b\":\"', event_type, '\",\"c\":null}') AS r",
    )
    left, right = F.from_json("l", "map<string,variant>"), F.from_json("r", "map<string,variant>")
    merged = merge_objects(left, right)
    less = without_keys(merged, F.when(F.col("event_id") % 2 == 0, F.array(F.lit("a"))))
    return rows.select("event_id", document_text(merged).alias("merged"), document_text(less).alias("less"))


_EV = """ev AS (
  SELECT event_id AS seq, cast(user_id AS varchar) AS id, event_type,
         cast(json_extract_string(props, '$.k') AS bigint) AS k,
         cast(round(value * 100) AS bigint) AS cents,
         CASE event_type WHEN 'signup' THEN 'insert' WHEN 'purchase' THEN 'replace'
              WHEN 'error' THEN 'delete' ELSE 'update' END AS op
  FROM events {where})"""

_GOOD = "WHERE event_id % 101 <> 0 AND event_id % 103 <> 0 AND event_id % 107 <> 0 AND event_id % 109 <> 0"


def _state_sql(mode: str, fields: bool = False, where: str = "") -> str:
    """Barrier per id, then the last writer per (id, field)."""
    keep_k = "AND event_type <> 'view'" if mode == "as_written" else ""
    gone_k = "UNION ALL SELECT id, 'k', NULL, 2 * seq + 1, true FROM ev WHERE event_type = 'view'"
    head = f"""WITH {_EV.format(where=where)},
    barrier AS (SELECT id, max(seq) AS bseq, arg_max(op, seq) AS bop FROM ev WHERE op IN ('insert', 'delete') GROUP BY id),
    sets AS (
      SELECT id, 'k' AS field, cast(k AS varchar) AS v, 2 * seq AS o, false AS gone FROM ev
        WHERE op NOT IN ('delete', 'replace') {keep_k}
      UNION ALL SELECT id, 'cents', cast(cents AS varchar), 2 * seq, false FROM ev WHERE op <> 'delete'
      UNION ALL SELECT id, 'last_type', '"' || event_type || '"', 2 * seq, false FROM ev WHERE op <> 'delete'
      {gone_k if mode == "intended" else ""}),
    newest AS (SELECT id, field, arg_max(v, o) AS v, arg_max(gone, o) AS gone, max(o) AS o FROM sets GROUP BY id, field),
    live AS (SELECT b.id, n.field, n.v FROM barrier b
             LEFT JOIN newest n ON n.id = b.id AND n.o >= 2 * b.bseq AND NOT n.gone WHERE b.bop = 'insert')"""
    if fields:
        return head + " SELECT id AS _id, field, v AS value FROM live WHERE field IS NOT NULL"
    return head + """ SELECT id AS _id,
      '{' || coalesce(string_agg('"' || field || '":' || v, ',' ORDER BY field), '') || '}' AS document
    FROM live GROUP BY id"""


_DOC_SQL = """'{"cents":' || cents || CASE WHEN op = 'replace' THEN '' ELSE ',"k":' || k END ||
   ',"last_type":"' || event_type || '"}'"""

_KEYWORD_DOC = """'{"eligibility":{' ||
   CASE WHEN c_custkey % 11 = 0 THEN '' ELSE '"end_period":{"$date":' || (820454400000 + (c_custkey % 1000) * 86400000 + 365 * 86400000::bigint) || '},' END ||
   '"name":"KW' || (c_custkey % 1000) || '","program_id":{"_id":{"$oid":"' ||
   CASE WHEN c_custkey % 17 = 0 THEN 99 ELSE c_nationkey END || '"}}' ||
   CASE WHEN c_custkey % 11 = 0 THEN '' ELSE ',"start_period":{"$date":' || (820454400000 + (c_custkey % 1000) * 86400000) || '}' END ||
   '},"segment":"' || c_mktsegment || '"}'"""

_PATHS_SQL = """WITH ev AS (
  SELECT event_id AS seq, cast(user_id AS varchar) AS id, event_type, cast(round(value * 100) AS bigint) AS cents FROM events),
barrier AS (SELECT id, max(seq) AS bseq FROM ev WHERE event_type = 'signup' GROUP BY id),
sets AS (
  SELECT e.id, CASE event_type WHEN 'purchase' THEN 'purchase' ELSE 'click' END AS obj,
         CASE event_type WHEN 'error' THEN 'reset' ELSE 'f' || (cents % 3) END AS leaf,
         e.seq, event_type = 'view' AS gone, cents
  FROM ev e JOIN barrier b ON b.id = e.id AND e.seq > b.bseq WHERE event_type IN ('purchase', 'click', 'error', 'view')),
wiped AS (SELECT id, max(seq) AS wseq FROM sets WHERE leaf = 'reset' GROUP BY id),
newest AS (
  SELECT s.id, obj, leaf, arg_max(gone, s.seq) AS gone, arg_max(cents, s.seq) AS cents
  FROM sets s LEFT JOIN wiped w ON w.id = s.id AND s.obj = 'click'
  WHERE w.wseq IS NULL OR s.seq >= w.wseq GROUP BY s.id, obj, leaf),
made AS (SELECT DISTINCT id, obj FROM sets WHERE NOT gone),
objects AS (
  SELECT m.id, m.obj, '"' || m.obj || '":{' ||
         coalesce(string_agg('"' || leaf || '":' || cents, ',' ORDER BY leaf) FILTER (WHERE NOT gone), '') || '}' AS text
  FROM made m LEFT JOIN newest n ON n.id = m.id AND n.obj = m.obj GROUP BY m.id, m.obj)
SELECT b.id AS _id, '{' || coalesce(string_agg(text, ',' ORDER BY obj), '') || '}' AS document
FROM barrier b LEFT JOIN objects o ON o.id = b.id GROUP BY b.id"""

QUERIES = {
    "cdc_fold_state": fold_state,
    "cdc_fold_removed_intended": fold_intended,
    "cdc_fold_removed_as_written": fold_as_written,
    "cdc_fold_fields": fold_fields,
    "cdc_fold_guarded": fold_guarded,
    "cdc_fold_over_snapshot": fold_snapshot,
    "cdc_fold_paths": fold_paths,
    "cdc_latest_per_key": latest_per_key,
    "cdc_upsert_filter": upsert_filter,
    "cdc_delete_semi": delete_semi,
    "cdc_conditional_document": conditional_document,
    "cdc_keyed_messages": keyed_messages,
    "cdc_event_time": event_time,
    "cdc_event_time_now": event_time_now,
    "cdc_rejects": rejects,
    "cdc_full_document": full_document,
    "cdc_points_rows": points_rows,
    "cdc_declared_table": declared_table,
    "cdc_verify_written": verify_written,
    "cdc_update_documents": update_documents,
    "json_merge_remove": merge_remove,
    "cdc_fold_exact": fold_exact,
    "cdc_nested_rows": nested_rows,
}

_INTENDED = _state_sql("intended")

ORACLE = {
    "cdc_fold_state": _state_sql("none"),
    "cdc_fold_removed_intended": _INTENDED,
    "cdc_fold_removed_as_written": _state_sql("as_written"),
    "cdc_fold_fields": _state_sql("intended", fields=True),
    "cdc_fold_guarded": _state_sql("intended", where=_GOOD),
    "cdc_fold_over_snapshot": _INTENDED,
    "cdc_fold_paths": _PATHS_SQL,
    "cdc_latest_per_key": """SELECT cast(user_id AS varchar) AS key, max(event_id) AS "offset" FROM events
        GROUP BY user_id HAVING arg_max(event_type, event_id) <> 'error'""",
    "cdc_upsert_filter": f"""WITH {_EV.format(where="")},
        newest AS (SELECT id, arg_max(op, seq) AS op, max(seq) AS seq FROM ev WHERE op IN ('insert', 'update') GROUP BY id)
        SELECT n.id AS _id, CASE WHEN n.op = 'insert' THEN {_DOC_SQL.replace("WHEN op", "WHEN ev.op")} END AS document, n.op AS "operationType"
        FROM newest n JOIN ev ON ev.seq = n.seq
        UNION ALL
        SELECT cast(c_custkey AS varchar), {_KEYWORD_DOC}, 'insert' FROM customer
        WHERE cast(c_custkey AS varchar) NOT IN (SELECT id FROM newest)""",
    "cdc_delete_semi": f"""SELECT cast(c_custkey AS varchar) AS _id, {_KEYWORD_DOC} AS document FROM customer
        WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'error')""",
    "cdc_conditional_document": f"""WITH {_EV.format(where="")}
        SELECT id AS _id, CASE WHEN op = 'insert' THEN {_DOC_SQL} END AS document, seq AS "offset"
        FROM ev WHERE op <> 'replace'""",
    "cdc_keyed_messages": f"""WITH {_EV.format(where="")}
        SELECT '{{"_id":"' || id || '"}}' AS key, CASE WHEN op <> 'delete' THEN
          '{{"_id":"' || id || '","operationType":"' || op || '","offset":' || seq || '}}' END AS value FROM ev""",
    "cdc_event_time": """SELECT event_id,
        CASE WHEN event_id % 7 = 0 THEN cast(floor(epoch(ts)) AS bigint) * 1000 ELSE epoch_us(ts) // 1000 END AS event_ms FROM events""",
    "cdc_event_time_now": """SELECT event_id, CASE WHEN event_id % 14 = 0 THEN epoch_ms(timestamp '2030-01-01')
        WHEN event_id % 7 = 0 THEN cast(floor(epoch(ts)) AS bigint) * 1000 ELSE epoch_us(ts) // 1000 END AS event_ms FROM events""",
    "cdc_rejects": """SELECT event_id, CASE WHEN event_id % 107 = 0 THEN 'malformed_json'
             WHEN event_id % 101 = 0 THEN 'missing_key' ELSE 'unknown_operation' END AS reject
        FROM events WHERE event_id % 101 = 0 OR event_id % 103 = 0 OR event_id % 107 = 0 OR event_id % 109 = 0""",
    "cdc_full_document": f"""WITH {_EV.format(where="")}
        SELECT cents, CASE WHEN op = 'insert' THEN k END AS k, event_type AS last_type
        FROM ev WHERE op IN ('insert', 'replace')""",
    "cdc_points_rows": """SELECT cast(c_custkey AS varchar) AS id, 'KW' || (c_custkey % 1000) AS keyword,
        c_nationkey AS points FROM customer WHERE c_custkey % 17 <> 0""",
    "cdc_declared_table": f"""WITH {_EV.format(where="")}
        SELECT id AS _id, op AS "operationType",
          CASE WHEN event_id % 7 <> 0 THEN epoch_us(ts) // 1000 END AS wall_ms,
          CASE WHEN op = 'insert' THEN k END AS k,
          CASE WHEN op IN ('insert', 'replace') THEN ev.event_type END AS last_type
        FROM ev JOIN events ON events.event_id = ev.seq""",
    "cdc_verify_written": f"""WITH state AS ({_INTENDED}),
        ids AS (SELECT DISTINCT cast(user_id AS varchar) AS _id FROM events WHERE event_type = 'signup')
        SELECT ids._id, state._id IS NOT NULL AS found,
          CASE WHEN length(document) > 50 THEN substr(document, 1, 50) || '...' ELSE document END AS excerpt
        FROM ids LEFT JOIN state ON state._id = ids._id""",
    "cdc_nested_rows": """WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus,
          row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) - 1 AS pos
          FROM lineitem WHERE l_returnflag = 'R'),
        o AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pos FROM orders),
        f AS (SELECT l_orderkey, pos, 0 AS fpos, 'return' AS kind, 0 AS cpos, l_returnflag AS code FROM l
          UNION ALL SELECT l_orderkey, pos, 1, 'status', c.cpos, CASE c.cpos WHEN 0 THEN l_linestatus WHEN 1 THEN 'x' END
          FROM l JOIN (VALUES (0), (1), (NULL)) c(cpos) ON (l_linenumber = 2) = (c.cpos IS NULL))
        SELECT c_custkey AS id, c_nationkey::INTEGER AS profile_nation_key, o.pos::INTEGER AS orders_pos, o_orderkey AS orders_key,
          l.pos::INTEGER AS orders_lines_pos, l_linenumber::INTEGER AS orders_lines_no, l_partkey AS orders_lines_part_key,
          fpos::INTEGER AS orders_lines_flags_pos, kind AS orders_lines_flags_kind,
          cpos::INTEGER AS orders_lines_flags_codes_pos, code AS orders_lines_flags_codes
        FROM customer LEFT JOIN o ON o_custkey = c_custkey LEFT JOIN l ON l.l_orderkey = o_orderkey
          LEFT JOIN f ON f.l_orderkey = l.l_orderkey AND f.pos = l.pos""",
    "cdc_fold_exact": r"""WITH b AS (SELECT user_id, max(event_id) AS at, arg_max(event_type, event_id) AS kind FROM events
          WHERE event_type IN ('signup', 'error') GROUP BY user_id),
        e AS (SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id,
          arg_max(cast(round(value * 100) AS bigint), event_id) AS cents FROM events GROUP BY user_id)
        SELECT cast(user_id AS varchar) AS _id, '{"amount":' || event_id || '.10,"big":' || repeat('9', 40) ||
          lpad(cast(event_id AS varchar), 10, '0') || ',"dotted.key":"a\"' || event_type || '","nested":{"x":' || cents ||
          '.50,"y":[1e2,null,"1.10"]},"none":null,"text":"1.10"}' AS document
        FROM e JOIN b USING (user_id) WHERE kind = 'signup'""",
    "json_merge_remove": """WITH m AS (SELECT event_id, '"b":"' || event_type || '","c":null}' AS rest FROM events)
        SELECT event_id, '{"a":' || event_id || ',' || rest AS merged,
          CASE WHEN event_id % 2 = 0 THEN '{' || rest ELSE '{"a":' || event_id || ',' || rest END AS less FROM m""",
    "cdc_update_documents": f"""WITH {_EV.format(where="")}
        SELECT seq AS event_id, CASE WHEN op = 'delete' THEN '{{}}' ELSE {_DOC_SQL} END AS document FROM ev""",
}
