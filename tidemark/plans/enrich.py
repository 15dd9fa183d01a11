"""Registered queries over redeem events and their lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.jsondoc import json_text
from tidemark.operators import asof, eligibility, fold, lookup
from tidemark.plans import fixtures
from tidemark.plans.cdc import _KEYWORD_DOC
from tidemark.sources import envelope

AS_OF = "1997-06-01 00:00:00"


def _redeems(spark, folder, **options):
    return envelope.accepted(envelope.parse_redeems(fixtures.redeem_log(spark, folder, **options)))


def _states(spark, folder):
    return fixtures.keywords(spark, folder), fixtures.programs(spark, folder)


def join_pairs(spark, folder):
    pairs = lookup.keyword_programs(*_states(spark, folder))
    return pairs.select("name", "_id", "program_id", json_text("program_doc", "name").alias("program"))


def enrich(spark, folder):
    found = lookup.enrich(_redeems(spark, folder), lookup.first_per_name(*_states(spark, folder)))
    return lookup.matched(found).select("transaction_id", "keyword", "keyword_id", "program_id")


def message(spark, folder):
    found = lookup.enrich(_redeems(spark, folder), lookup.first_per_name(*_states(spark, folder)))
    return lookup.message(lookup.matched(found))


def message_with_event(spark, folder):
    found = lookup.enrich(_redeems(spark, folder), lookup.first_per_name(*_states(spark, folder)))
    return lookup.message(lookup.matched(found), "with_event", ["transaction_id", "msisdn"])


def left_regular(spark, folder):
    """Regular left join; every keyword of the name counts, here there is one at most."""
    joined = lookup.redeem_periods(_redeems(spark, folder, names=None), fixtures.keywords(spark, folder, None))
    return joined.select("transaction_id", "keyword", "start_period", "end_period")


def left_many(spark, folder):
    """Three keywords a name, some redeems without an id (dropped) or keyword, some keywords without a name or period."""
    log = fixtures.changing_log(spark, folder).drop("phase")
    redeems = envelope.accepted(envelope.parse_redeems(log.filter("topic = 'redeem'")))
    changes = envelope.accepted(envelope.parse_changes(log.filter("topic = 'keyword'"), "offset"))
    joined = lookup.redeem_periods(redeems, fold.fold(changes))
    return joined.select("transaction_id", "keyword", "start_period", "end_period")


def arrival(spark, folder):
    """The time of a redeem event is that of its processing."""
    now = F.lit("2024-03-01 12:00:00").cast("timestamp")
    redeems = envelope.accepted(envelope.parse_redeems(fixtures.redeem_log(spark, folder), now))
    return redeems.select("transaction_id", F.unix_millis("event_time").alias("event_ms"))


def exists(spark, folder):
    flagged = lookup.with_existence(_redeems(spark, folder), fixtures.keywords(spark, folder))
    return flagged.select("transaction_id", "found")


def redeem_rejects(spark, folder):
    redeems = envelope.parse_redeems(fixtures.redeem_log(spark, folder, broken=True))
    return redeems.filter(F.col("reject").isNotNull()).select("offset", "reject")


def flat(redeems):
    """Nested fields and record metadata as flat columns."""
    return redeems.select(
        "transaction_id", "request_id", "msisdn", "account_id", "user_id", "send_notification",
        F.col("additional")["priority"].alias("priority"), "partition", "offset",
        F.unix_millis("kafka_timestamp").alias("kafka_ms"),
    )


def redeem_columns(spark, folder):
    return flat(_redeems(spark, folder))


def reason(spark, folder):
    redeems = lookup.redeem_periods(_redeems(spark, folder, names=None), fixtures.keywords(spark, folder, None))
    judged = eligibility.with_reason(redeems, F.lit(AS_OF).cast("timestamp"))
    return judged.select("transaction_id", "keyword", "start_period", "end_period", "reason")


def reason_views(spark, folder):
    """The same judgement as SQL text over temporary views."""
    _redeems(spark, folder, names=None).createOrReplaceTempView("redeem")
    lookup.with_lookup_keys(fixtures.keywords(spark, folder, None)).createOrReplaceTempView("keyword")
    spark.sql("""
        CREATE OR REPLACE TEMP VIEW redeem_period AS
        SELECT r.transaction_id, r.keyword, r.kafka_timestamp, k.start_period, k.end_period
        FROM redeem r LEFT JOIN keyword k ON r.keyword = k.name
        WHERE r.transaction_id IS NOT NULL""")
    return spark.sql(f"""
        SELECT transaction_id, keyword, start_period, end_period,
          CASE WHEN start_period IS NULL OR end_period IS NULL THEN '{eligibility.MISSING}'
               WHEN timestamp '{AS_OF}' < timestamp_millis(start_period) THEN '{eligibility.NOT_STARTED}'
               WHEN timestamp '{AS_OF}' > timestamp_millis(end_period) THEN '{eligibility.EXPIRED}'
               ELSE '{eligibility.ELIGIBLE}' END AS reason
        FROM redeem_period""")


def latency(spark, folder):
    """All event columns and the milliseconds until a fixed moment."""
    events = fixtures.table(spark, folder, "events").drop("props")
    now = F.lit("2024-03-01 00:00:00").cast("timestamp")
    return eligibility.with_latency(events, "ts", now).drop("ts")


def _joined(spark, folder, how):
    return asof.asof_join(
        fixtures.probes(spark, folder),
        fixtures.versions(spark, folder, "signup"),
        ["user_id"],
        "probe_ts",
        "version_ts",
        how=how,
        tie_order=F.col("version_id"),
    )


def asof_inner(spark, folder):
    return _joined(spark, folder, "inner").select("probe_id", "version_id", "cents")


def asof_left(spark, folder):
    return _joined(spark, folder, "left").select("probe_id", "version_id", "cents")


def asof_two(spark, folder):
    """Two lookups in a row, both as of the event."""
    once = _joined(spark, folder, "left").select(
        "probe_id", "user_id", "probe_ts", F.col("version_id").alias("signup_id")
    )
    views = fixtures.versions(spark, folder, "view").select("user_id", "version_ts", "version_id")
    twice = asof.asof_join(once, views, ["user_id"], "probe_ts", "version_ts", tie_order=F.col("version_id"))
    return twice.select("probe_id", "signup_id", F.col("version_id").alias("view_id"))


def asof_two_keys(spark, folder):
    """Two lookups in a row by different keys: the user's signup, and the newest view of the user's tenth."""
    tenth = (F.col("user_id") % 10).alias("tenth")
    once = _joined(spark, folder, "left").select("probe_id", "probe_ts", tenth, F.col("version_id").alias("signup_id"))
    views = fixtures.versions(spark, folder, "view").select(tenth, "version_ts", "version_id")
    twice = asof.asof_join(once, views, ["tenth"], "probe_ts", "version_ts", tie_order=F.col("version_id"))
    return twice.select("probe_id", "signup_id", F.col("version_id").alias("view_id"))


def asof_closed(spark, folder):
    """Errors end the validity of a user's signup version."""
    versions = fixtures.versions(spark, folder, "signup").withColumn("ended", F.lit(False)).unionByName(
        fixtures.versions(spark, folder, "error").withColumn("ended", F.lit(True))
    )
    joined = asof.asof_join(
        fixtures.probes(spark, folder), versions, ["user_id"], "probe_ts", "version_ts",
        how="inner", tie_order=F.col("version_id"), closed_by=F.col("ended"),
    )
    return joined.select("probe_id", "version_id")


_KW = """k AS (SELECT cast(c_custkey AS varchar) AS id, 'KW' || (c_custkey % 1000) AS name,
    CASE WHEN c_custkey % 17 = 0 THEN '99' ELSE cast(c_nationkey AS varchar) END AS program_id,
    CASE WHEN c_custkey % 11 <> 0 THEN 820454400000 + (c_custkey % 1000) * 86400000 END AS start_period,
    CASE WHEN c_custkey % 11 <> 0 THEN 820454400000 + (c_custkey % 1000) * 86400000 + 365 * 86400000::bigint END AS end_period,
    KEYWORD_DOC AS doc FROM customer)""".replace("KEYWORD_DOC", _KEYWORD_DOC)
_P = """p AS (SELECT cast(n_nationkey AS varchar) AS id, n_name AS name,
    '{"name":"' || n_name || '","region":' || n_regionkey || '}' AS doc FROM nation)"""
_R = """r AS (SELECT cast(o_orderkey AS varchar) AS transaction_id, cast(o_custkey AS varchar) AS msisdn,
    CASE WHEN o_orderkey % 13 = 0 THEN 'NONE' || o_orderkey ELSE 'KW' || (o_custkey % 1000) END AS keyword FROM orders)"""
# One keyword per customer instead of a thousand names.
_OWN_KW, _OWN_R = _KW.replace("c_custkey % 1000) AS name", "c_custkey) AS name"), _R.replace("o_custkey % 1000", "o_custkey")
_FIRST = """f AS (SELECT k.name, arg_min(k.id, k.id) AS keyword_id, arg_min(p.id, k.id) AS program_id,
    arg_min(k.doc, k.id) AS keyword_doc, arg_min(p.doc, k.id) AS program_doc
    FROM k JOIN p ON k.program_id = p.id GROUP BY k.name)"""
_DOCS = """'"keyword":' || keyword_doc || ',"program":' || program_doc || ',"customer":null}'"""

_REASON = f"""WITH {_OWN_KW}, {_OWN_R}
    SELECT transaction_id, keyword, start_period, end_period,
      CASE WHEN start_period IS NULL OR end_period IS NULL THEN '{eligibility.MISSING}'
           WHEN epoch_ms(timestamp '{AS_OF}') < start_period THEN '{eligibility.NOT_STARTED}'
           WHEN epoch_ms(timestamp '{AS_OF}') > end_period THEN '{eligibility.EXPIRED}' ELSE '{eligibility.ELIGIBLE}' END AS reason
    FROM r LEFT JOIN k ON r.keyword = k.name"""

_PROBE = "(SELECT event_id AS probe_id, user_id, ts FROM events WHERE event_type = 'purchase')"


def _version(kind: str) -> str:
    return f"""(SELECT user_id, ts, max(event_id) AS version_id, arg_max(cast(round(value * 100) AS bigint), event_id) AS cents
        FROM events WHERE event_type = '{kind}' GROUP BY user_id, ts)"""


# The changing log: keywords and programs after each phase, redeems in theirs.
PHASES = """ph AS (SELECT unnest([0, 1, 2]) AS phase),
  kp AS (SELECT phase, cast(c_custkey AS varchar) AS id, CASE WHEN phase > 0 AND c_custkey % 5 = 0 THEN 1 ELSE 0 END AS moved,
      c_custkey, c_nationkey, c_mktsegment, 820454400000 + (c_custkey % 1000) * 86400000 AS start_ms
    FROM customer, ph WHERE NOT (phase = 2 AND c_custkey % 19 = 0)),
  k AS (SELECT phase, id, CASE WHEN c_custkey % 23 <> 0 THEN 'KW' || ((c_custkey + 3 * moved) // 3) END AS name,
      CASE WHEN c_custkey % 17 = 0 THEN '99' ELSE cast((c_nationkey + moved) % 25 AS varchar) END AS program_id,
      CASE WHEN c_custkey % 11 <> 0 THEN start_ms END AS start_period,
      CASE WHEN c_custkey % 11 <> 0 THEN start_ms + 365 * 86400000::bigint END AS end_period, c_mktsegment FROM kp),
  kd AS (SELECT *, '{"eligibility":{' || coalesce('"end_period":{"$date":' || end_period || '},', '') ||
      coalesce('"name":"' || name || '",', '') || '"program_id":{"_id":{"$oid":"' || program_id || '"}}' ||
      coalesce(',"start_period":{"$date":' || start_period || '}', '') || '},"segment":"' || c_mktsegment || '"}' AS doc FROM k),
  p AS (SELECT phase, cast(n_nationkey AS varchar) AS id, '{"name":"' ||
      CASE WHEN phase = 2 AND n_nationkey % 6 = 0 THEN lower(n_name) ELSE n_name END || '","region":' || n_regionkey || '}' AS doc
    FROM nation, ph WHERE phase > 0 OR n_nationkey % 5 <> 4),
  r AS (SELECT cast(o_orderkey % 3 AS integer) AS phase, CASE WHEN o_orderkey % 97 <> 0 THEN cast(o_orderkey AS varchar) END AS tx,
      CASE WHEN o_orderkey % 13 = 0 THEN 'NONE' || o_orderkey ELSE 'KW' || (o_custkey // 3) END AS keyword FROM orders)"""

QUERIES = {
    "lookup_join_pairs": join_pairs,
    "lookup_enrich": enrich,
    "lookup_message": message,
    "lookup_message_with_event": message_with_event,
    "lookup_left_regular": left_regular,
    "lookup_left_many": left_many,
    "redeem_arrival": arrival,
    "asof_left_two_keys": asof_two_keys,
    "lookup_exists": exists,
    "redeem_rejects": redeem_rejects,
    "redeem_columns": redeem_columns,
    "eligibility_reason": reason,
    "eligibility_views": reason_views,
    "latency_ms": latency,
    "asof_inner": asof_inner,
    "asof_left": asof_left,
    "asof_left_two": asof_two,
    "asof_closed": asof_closed,
}

ORACLE = {
    "lookup_join_pairs": f"""WITH {_KW}, {_P}
        SELECT k.name, k.id AS _id, k.program_id, p.name AS program FROM k JOIN p ON k.program_id = p.id""",
    "lookup_enrich": f"""WITH {_KW}, {_P}, {_R}, {_FIRST}
        SELECT transaction_id, keyword, keyword_id, program_id FROM r JOIN f ON r.keyword = f.name""",
    "lookup_message": f"""WITH {_KW}, {_P}, {_R}, {_FIRST}
        SELECT '{{' || {_DOCS} AS value FROM r JOIN f ON r.keyword = f.name""",
    "lookup_message_with_event": f"""WITH {_KW}, {_P}, {_R}, {_FIRST}
        SELECT '{{"event":{{"transaction_id":"' || transaction_id || '","msisdn":"' || msisdn || '"}},' || {_DOCS} AS value
        FROM r JOIN f ON r.keyword = f.name""",
    "lookup_left_regular": f"""WITH {_OWN_KW}, {_OWN_R}
        SELECT transaction_id, keyword, start_period, end_period FROM r LEFT JOIN k ON r.keyword = k.name""",
    "lookup_left_many": f"""WITH {PHASES} SELECT tx AS transaction_id, keyword, start_period, end_period
        FROM r LEFT JOIN k ON k.phase = 2 AND k.name = r.keyword WHERE tx IS NOT NULL""",
    "redeem_arrival": """SELECT cast(o_orderkey AS varchar) AS transaction_id, epoch_ms(timestamp '2024-03-01 12:00:00') AS event_ms
        FROM orders""",
    "asof_left_two_keys": f"""SELECT probe_id, v.version_id AS signup_id, w.version_id AS view_id FROM {_PROBE} b
        ASOF LEFT JOIN {_version("signup")} v ON b.user_id = v.user_id AND b.ts >= v.ts
        ASOF LEFT JOIN (SELECT user_id % 10 AS tenth, ts, max(event_id) AS version_id FROM events WHERE event_type = 'view'
          GROUP BY ALL) w ON b.user_id % 10 = w.tenth AND b.ts >= w.ts""",
    "lookup_exists": f"""WITH {_KW}, {_R}
        SELECT transaction_id, EXISTS (SELECT 1 FROM k WHERE k.name = r.keyword) AS found FROM r""",
    "redeem_rejects": """SELECT o_orderkey AS "offset",
        CASE WHEN o_orderkey % 107 = 0 THEN 'malformed_json' ELSE 'missing_keyword' END AS reject
        FROM orders WHERE o_orderkey % 107 = 0 OR o_orderkey % 101 = 0""",
    "redeem_columns": """SELECT cast(o_orderkey AS varchar) AS transaction_id, 'R' || o_orderkey AS request_id,
        cast(o_custkey AS varchar) AS msisdn, cast(o_custkey AS varchar) AS account_id, 'u' || o_custkey AS user_id,
        o_orderkey % 2 = 0 AS send_notification, o_orderpriority AS priority, 0 AS "partition",
        o_orderkey AS "offset", epoch_ms(o_orderdate) AS kafka_ms FROM orders""",
    "eligibility_reason": _REASON,
    "eligibility_views": _REASON,
    "latency_ms": """SELECT event_id, user_id, event_type, value,
        cast(trunc((epoch_us(timestamp '2024-03-01') - epoch_us(ts)) / 1000) AS bigint) AS latency_ms FROM events""",
    "asof_inner": f"""SELECT probe_id, version_id, cents FROM {_PROBE} b ASOF JOIN {_version("signup")} v
        ON b.user_id = v.user_id AND b.ts >= v.ts""",
    "asof_left": f"""SELECT probe_id, version_id, cents FROM {_PROBE} b ASOF LEFT JOIN {_version("signup")} v
        ON b.user_id = v.user_id AND b.ts >= v.ts""",
    "asof_left_two": f"""SELECT probe_id, v.version_id AS signup_id, w.version_id AS view_id FROM {_PROBE} b
        ASOF LEFT JOIN {_version("signup")} v ON b.user_id = v.user_id AND b.ts >= v.ts
        ASOF LEFT JOIN {_version("view")} w ON b.user_id = w.user_id AND b.ts >= w.ts""",
    "asof_closed": f"""SELECT probe_id, version_id FROM {_PROBE} b ASOF JOIN (
          SELECT user_id, ts, max(event_id) AS version_id, arg_max(event_type, event_id) AS kind
          FROM events WHERE event_type IN ('signup', 'error') GROUP BY user_id, ts) v
        ON b.user_id = v.user_id AND b.ts >= v.ts WHERE kind = 'signup'""",
}
