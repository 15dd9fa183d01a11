"""The library's inputs, derived from the TPC-H-like tables of a data folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators.rulebook import OVERVIEW_RULES, RECORDING_RULES


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    session.configure(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(spark: SparkSession, folder: str, name: str, key: str) -> DataFrame:
    """A table in even parts for all cores. The records made of its rows cost far more than their few bytes on disk tell."""
    return table(spark, folder, name).repartition(key)


# One record per event: signups insert, purchases replace, clicks and views
# update, errors delete. A view also removes field k. A replacement does not
# name k, so what was stored under it tells a merge from an overwrite.
_DOCUMENT = "named_struct('cents', cents, 'k', if(op = 'replace', null, k), 'last_type', event_type)"


def change_log(
    spark: SparkSession, folder: str, removals: bool = True, broken: bool = False, timeless: bool = False
) -> DataFrame:
    """``timeless``: every fourteenth event carries no time at all."""
    cluster = "named_struct('$timestamp', named_struct('t', unix_seconds(cast(ts AS timestamp)), 'i', 1))"
    if timeless:
        cluster = f"if(event_id % 14 = 0, null, {cluster})"
    events = spread(spark, folder, "events", "event_id").selectExpr(
        "*",
        "cast(get_json_object(props, '$.k') as bigint) AS k",
        "cast(round(value * 100) as bigint) AS cents",
        """CASE event_type WHEN 'signup' THEN 'insert' WHEN 'purchase' THEN 'replace'
                WHEN 'error' THEN 'delete' ELSE 'update' END AS op""",
    )
    removed = "if(event_type = 'view', array('k'), cast(array() AS array<string>))"
    operation, key, text = "op", "named_struct('_id', named_struct('$oid', cast(user_id AS string)))", "json"
    if broken:
        operation = "CASE WHEN event_id % 103 = 0 THEN 'rename' WHEN event_id % 109 = 0 THEN null ELSE op END"
        key = f"CASE WHEN event_id % 101 = 0 THEN null ELSE {key} END"
        text = "CASE WHEN event_id % 107 = 0 THEN substring(json, 1, length(json) - 2) ELSE json END"
    event = f"""named_struct(
        'operationType', {operation},
        'clusterTime', {cluster},
        'wallTime', if(event_id % 7 = 0, null, named_struct('$date', unix_millis(cast(ts AS timestamp)))),
        'fullDocument', CASE WHEN op IN ('insert', 'replace') THEN {_DOCUMENT} END,
        'updateDescription', CASE WHEN op = 'update' THEN named_struct(
            'updatedFields', {_DOCUMENT},
            'removedFields', {removed if removals else "cast(array() AS array<string>)"}) END,
        'ns', named_struct('db', 'shop', 'coll', 'users'),
        'documentKey', {key})"""
    return events.selectExpr("*", f"to_json({event}) AS json").selectExpr(
        "cast(user_id AS string) AS key",
        f"{text} AS value",
        "'changes' AS topic",
        "0 AS partition",
        "event_id AS offset",
        "cast(ts AS timestamp) AS timestamp",
    )


def exact_change_log(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as texts whose values a reader of JSON numbers would change: decimals, fifty digits, nested ones."""
    document = """concat('{"amount":', event_id, '.10,"big":', repeat('9', 40), lpad(event_id, 10, '0'),
        ',"nested":{"x":', cents, '.50,"y":[1e2,null,"1.10"]},"none":null,"dotted.key":"a\\\\"', event_type, '","text":"1.10"}')"""
    events = spread(spark, folder, "events", "event_id").selectExpr("*", "cast(round(value * 100) as bigint) AS cents")
    return events.selectExpr("*", f"{document} AS document").selectExpr(
        "cast(user_id AS string) AS key",
        """concat('{"operationType":"', CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END, '"',
             CASE event_type WHEN 'signup' THEN concat(',"fullDocument":', document) WHEN 'error' THEN ''
                  ELSE concat(',"updateDescription":{"updatedFields":', document, '}') END,
             ',"documentKey":{"_id":{"$oid":"', user_id, '"}}}') AS value""",
        "'changes' AS topic",
        "0 AS partition",
        "event_id AS offset",
        "cast(ts AS timestamp) AS timestamp",
    )


def nested_change_log(spark: SparkSession, folder: str) -> DataFrame:
    """Every user document holds one object per event type, set field by field.

    A signup inserts an empty document, a view removes one nested field, an
    error replaces the whole ``click`` object, other types set a nested field.
    """
    return table(spark, folder, "events").selectExpr(
        "cast(user_id AS string) AS _id",
        "if(event_type = 'signup', 'insert', 'update') AS op",
        "event_id AS seq",
        "cast(round(value * 100) as bigint) AS cents",
        "event_type",
    ).selectExpr(
        "_id",
        "op",
        "seq",
        """CASE event_type
             WHEN 'signup' THEN from_json('{}', 'map<string,variant>')
             WHEN 'view' THEN from_json('{}', 'map<string,variant>')
             WHEN 'error' THEN from_json(to_json(named_struct('click', named_struct('reset', cents))), 'map<string,variant>')
             ELSE from_json(to_json(map(concat(event_type, '.', 'f', cents % 3), cents)), 'map<string,variant>')
           END AS patch""",
        "CASE WHEN event_type = 'view' THEN array(concat('click.f', cents % 3)) END AS removed",
    )


def points_log(spark: SparkSession, folder: str) -> DataFrame:
    """Minimal change events of the customers: id, keyword and points."""
    return table(spark, folder, "customer").selectExpr(
        "cast(c_custkey AS string) AS key",
        """to_json(named_struct(
             'operationType', 'insert',
             'fullDocument', if(c_custkey % 17 = 0, null, named_struct(
                 '_id', named_struct('$oid', cast(c_custkey AS string)),
                 'keyword', concat('KW', c_custkey % 1000),
                 'points', cast(c_nationkey AS int))),
             'documentKey', named_struct('_id', named_struct('$oid', cast(c_custkey AS string))))) AS value""",
    )


def nested_records(spark: SparkSession, folder: str) -> DataFrame:
    """A record per customer with its orders, their returned lines, and the flags and codes of those: arrays of rows."""
    lines = table(spark, folder, "lineitem").filter("l_returnflag = 'R'").selectExpr(
        "l_orderkey",
        """named_struct('no', l_linenumber, 'part', named_struct('key', l_partkey), 'flags', array(
             named_struct('kind', 'return', 'codes', array(l_returnflag)),
             named_struct('kind', 'status', 'codes', if(l_linenumber = 2, cast(array() AS array<string>), array(l_linestatus, 'x')))
           )) AS line""",
    )
    lines = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    orders = table(spark, folder, "orders").join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left").selectExpr(
        "o_custkey", "named_struct('key', o_orderkey, 'lines', lines) AS o"
    )
    orders = orders.groupBy("o_custkey").agg(F.array_sort(F.collect_list("o")).alias("orders"))
    customers = table(spark, folder, "customer").join(orders, F.col("o_custkey") == F.col("c_custkey"), "left")
    record = "to_json(named_struct('id', c_custkey, 'profile', named_struct('nation', named_struct('key', c_nationkey)), 'orders', orders))"
    return customers.selectExpr("cast(c_custkey AS string) AS key", f"{record} AS value")


def programs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").selectExpr(
        "cast(n_nationkey AS string) AS _id",
        "to_json(named_struct('name', n_name, 'region', n_regionkey)) AS document",
    )


def keywords(spark: SparkSession, folder: str, names: int | None = 1000) -> DataFrame:
    """Some periods and some programs are missing.

    There are ``names`` keyword names, so they repeat and a lookup has to choose
    one; with None every keyword has its own.
    """
    number = "c_custkey" if names is None else f"c_custkey % {names}"
    start = "820454400000 + (c_custkey % 1000) * 86400000"
    return table(spark, folder, "customer").selectExpr("*", f"{start} AS start_ms").selectExpr(
        "cast(c_custkey AS string) AS _id",
        f"""to_json(named_struct('eligibility', named_struct(
             'end_period', if(c_custkey % 11 = 0, null, named_struct('$date', start_ms + 365 * 86400000L)),
             'name', concat('KW', {number}),
             'program_id', named_struct('_id', named_struct('$oid',
                 cast(if(c_custkey % 17 = 0, 99, c_nationkey) AS string))),
             'start_period', if(c_custkey % 11 = 0, null, named_struct('$date', start_ms))),
             'segment', c_mktsegment)) AS document""",
    )


def redeem_log(
    spark: SparkSession, folder: str, broken: bool = False, names: int | None = 1000
) -> DataFrame:
    number = "o_custkey" if names is None else f"o_custkey % {names}"
    keyword = f"if(o_orderkey % 13 = 0, concat('NONE', o_orderkey), concat('KW', {number}))"
    if broken:
        keyword = f"if(o_orderkey % 101 = 0, null, {keyword})"
    text = "if(o_orderkey % 107 = 0, substring(json, 1, 40), json)" if broken else "json"
    return spread(spark, folder, "orders", "o_orderkey").selectExpr(
        "*",
        f"""to_json(named_struct(
              'data', named_struct(
                  'locale', 'en', 'msisdn', cast(o_custkey AS string), 'keyword', {keyword},
                  'transaction_id', cast(o_orderkey AS string), 'send_notification', o_orderkey % 2 = 0,
                  'additional', map('priority', o_orderpriority)),
              'account', named_struct('_id', cast(o_custkey AS string), 'user_id', concat('u', o_custkey)),
              'transaction_id', concat('R', o_orderkey),
              'path', '/redeem',
              'keyword_priority', 'DEFAULT')) AS json""",
    ).selectExpr(
        "cast(o_orderkey AS string) AS key",
        f"{text} AS value",
        "'redeem' AS topic",
        "0 AS partition",
        "o_orderkey AS offset",
        "cast(o_orderdate AS timestamp) AS timestamp",
    )


def changing_log(spark: SparkSession, folder: str) -> DataFrame:
    """Redeems and the changes of keywords and programs in one log of three phases (column ``phase``).

    Three keywords have one name. Every fifth moves to the next name and program in phase 1, every nineteenth is
    deleted in phase 2, every twenty-third has no name. A fifth of the programs appear in phase 1, every sixth is
    renamed in phase 2. Redeems come in all phases; some have no transaction id.
    """

    def event(op: str, key: str, document: str) -> str:
        return f"""to_json(named_struct('operationType', '{op}',
            'fullDocument', {document if op == "insert" else "null"},
            'updateDescription', {f"named_struct('updatedFields', {document})" if op == "update" else "null"},
            'documentKey', named_struct('_id', named_struct('$oid', cast({key} AS string)))))"""

    def eligibility(moved: int) -> str:
        return f"""named_struct(
            'end_period', if(c_custkey % 11 = 0, null, named_struct('$date', start_ms + 365 * 86400000L)),
            'name', if(c_custkey % 23 = 0, null, concat('KW', (c_custkey + {3 * moved}) div 3)),
            'program_id', named_struct('_id', named_struct('$oid',
                cast(if(c_custkey % 17 = 0, 99, (c_nationkey + {moved}) % 25) AS string))),
            'start_period', if(c_custkey % 11 = 0, null, named_struct('$date', start_ms)))"""

    def records(rows: DataFrame, topic: str, key: str, phase: str, value: str) -> DataFrame:
        return rows.selectExpr(
            f"cast({key} AS string) AS key", f"{value} AS value", f"'{topic}' AS topic", "0 AS partition",
            f"{phase} * 1000000000L + {key} AS offset", "timestamp '2024-01-01 00:00:00' AS timestamp", f"{phase} AS phase",
        )

    customers = table(spark, folder, "customer").selectExpr("*", "820454400000 + (c_custkey % 1000) * 86400000 AS start_ms")
    nations, orders = table(spark, folder, "nation"), spread(spark, folder, "orders", "o_orderkey")
    whole = f"named_struct('eligibility', {eligibility(0)}, 'segment', c_mktsegment)"
    program = "named_struct('name', n_name, 'region', n_regionkey)"
    keyword = "if(o_orderkey % 13 = 0, concat('NONE', o_orderkey), concat('KW', o_custkey div 3))"
    redeem = f"""to_json(named_struct('data', named_struct('keyword', {keyword},
        'transaction_id', if(o_orderkey % 97 = 0, null, cast(o_orderkey AS string)))))"""
    parts = [
        records(customers, "keyword", "c_custkey", "0", event("insert", "c_custkey", whole)),
        records(customers.filter("c_custkey % 5 = 0"), "keyword", "c_custkey", "1",
                event("update", "c_custkey", f"named_struct('eligibility', {eligibility(1)})")),
        records(customers.filter("c_custkey % 19 = 0"), "keyword", "c_custkey", "2", event("delete", "c_custkey", "null")),
        records(nations, "program", "n_nationkey", "if(n_nationkey % 5 = 4, 1, 0)", event("insert", "n_nationkey", program)),
        records(nations.filter("n_nationkey % 6 = 0"), "program", "n_nationkey", "2",
                event("update", "n_nationkey", "named_struct('name', lower(n_name))")),
        records(orders, "redeem", "o_orderkey", "cast(o_orderkey % 3 AS int)", redeem),
    ]
    return reduce(DataFrame.unionByName, parts)


def versions(spark: SparkSession, folder: str, event_type: str) -> DataFrame:
    return (
        table(spark, folder, "events")
        .filter(F.col("event_type") == event_type)
        .selectExpr("user_id", "ts AS version_ts", "event_id AS version_id", "cast(round(value * 100) as bigint) AS cents")
    )


def probes(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "events")
        .filter("event_type = 'purchase'")
        .selectExpr("event_id AS probe_id", "user_id", "ts AS probe_ts")
    )


def slipped_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the third of the time range in which they arrive; every tenth arrives one third late."""
    events = table(spark, folder, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    low, high = events.agg(F.min("us"), F.max("us")).first()
    third = f"cast((us - {low or 0}) * 3 div {(high or 0) - (low or 0) + 1} AS int)"
    return events.selectExpr(
        "event_id", "cast(ts AS timestamp) AS ts", f"least({third} + if(event_id % 10 = 0, 1, 0), 2) AS phase"
    )


METRICS = tuple(dict.fromkeys(rule.metric for rule in (*RECORDING_RULES, *OVERVIEW_RULES)))


def partition_vector(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as daily partition metrics; the part key picks the metric."""
    names = ", ".join(f"'{name}'" for name in METRICS)
    return table(spark, folder, "lineitem").selectExpr(
        f"element_at(array({names}), cast(l_partkey % {len(METRICS)} + 1 AS int)) AS metric",
        """map('topic', if(l_returnflag = 'R', '__cluster_metadata', l_returnflag),
               'partition', cast(l_linenumber AS string),
               'kafka_broker_id', cast(l_suppkey % 3 AS string),
               'kafka_cluster_id', 'c1',
               'job', if(l_suppkey % 2 = 0, 'kafka-brokers', 'other')) AS labels""",
        "if(l_discount = 0, 0.0D, if(l_tax = 0, 1.0D, round(l_extendedprice * 100))) AS value",
        "cast(l_shipdate AS timestamp) AS eval_ts",
    )


def event_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Events as samples, a series per type and tenth of the users, labelled by half too."""
    return table(spark, folder, "events").selectExpr(
        "event_type AS metric",
        "map('grp', cast(user_id % 10 AS string), 'half', cast(user_id % 2 AS string), 'empty', '') AS labels",
        "round(value * 100) AS value",
        "cast(ts AS timestamp) AS ts",
    )


# The alert metrics, one per order priority.
ALERT_METRICS = {
    "1-URGENT": "kafka_server_broker_state",
    "2-HIGH": "kafka_cluster_partition_under_replicated",
    "3-MEDIUM": "kafka_cluster_partition_offline",
    "4-NOT SPECIFIED": "kafka_server_log_flush_rate",
    "5-LOW": "kafka_controller_active_controller_count",
}
DAY = 86_400


def daily_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per priority and status and day, minus one, as a vector on a day grid."""
    names = " ".join(f"WHEN '{p}' THEN '{m}'" for p, m in ALERT_METRICS.items())
    return (
        table(spark, folder, "orders")
        .groupBy("o_orderpriority", "o_orderstatus", "o_orderdate")
        .agg(F.count("*").alias("n"))
        .selectExpr(
            f"CASE o_orderpriority {names} END AS metric",
            "map('broker', o_orderstatus, 'state', 'NotRunning') AS labels",
            "cast(n - 1 AS double) AS value",
            "cast(o_orderdate AS timestamp) AS eval_ts",
        )
    )
