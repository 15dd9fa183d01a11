"""Registered queries over metric samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import alerts, metrics, rulebook
from tidemark.operators.alerts import AlertRule
from tidemark.operators.metrics import Matcher
from tidemark.plans import fixtures
from tidemark.plans.fixtures import DAY, METRICS

AS_OF = "1998-08-02 00:00:00"


def _flat(rules, *labels):
    columns = [F.col("labels")[name].alias(name) for name in labels]
    return rules.select("record", *columns, F.col("value").cast("bigint").alias("value"), _day())


def _day():
    return F.date_format("eval_ts", "yyyy-MM-dd").alias("day")


def recording(spark, folder):
    result = metrics.evaluate_rules(fixtures.partition_vector(spark, folder), rulebook.RECORDING_RULES)
    return _flat(result, "kafka_broker_id", "kafka_cluster_id", "topic")


def overview(spark, folder):
    return _flat(metrics.evaluate_rules(fixtures.partition_vector(spark, folder), rulebook.OVERVIEW_RULES))


def topic_count(spark, folder):
    record, metric, by = rulebook.OVERVIEW_TOPICS
    counts = metrics.count_by_count(fixtures.partition_vector(spark, folder), metric, by)
    return counts.select(F.lit(record).alias("record"), F.col("value").cast("bigint").alias("value"), _day())


def instant(spark, folder):
    """Hourly evaluation, samples visible for three hours."""
    vector = metrics.instant_vector(fixtures.event_samples(spark, folder), 3600, 10800)
    return vector.select(
        "metric",
        F.col("labels")["grp"].alias("grp"),
        F.col("value").cast("bigint").alias("value"),
        F.unix_seconds("eval_ts").alias("eval_s"),
    )


SUMS = (metrics.RecordingRule("sum_by_grp", "click", ("grp",)), metrics.RecordingRule("total", "view", ()))


def recording_over_instant(spark, folder):
    """Samples to instant vector to a sum per series group, as the rules run in sequence."""
    vector = metrics.instant_vector(fixtures.event_samples(spark, folder), 3600, 10800)
    return flat_sums(metrics.evaluate_rules(vector, SUMS))


def flat_sums(result):
    return result.select(
        "record",
        F.col("labels")["grp"].alias("grp"),
        F.col("value").cast("bigint").alias("value"),
        F.unix_seconds("eval_ts").alias("eval_s"),
    )


def matchers(spark, folder):
    """Label matchers; a label that no series has equals the empty text."""
    chosen = metrics.select_series(
        fixtures.partition_vector(spark, folder),
        METRICS[0],
        [Matcher("topic", "!=", "A"), Matcher("missing", "=", ""), Matcher("partition", "=~", "1|2"),
         Matcher("kafka_broker_id", "!~", "[12]")],
    ).filter(metrics.compare(F.col("value"), ">", 0))
    return chosen.select(
        F.col("labels")["topic"].alias("topic"),
        F.col("labels")["partition"].alias("partition"),
        F.col("value").cast("bigint").alias("value"),
        _day(),
    )


def _beans(spark, folder):
    return fixtures.table(spark, folder, "part").selectExpr(
        "p_partkey",
        """CASE p_partkey % 9
             WHEN 0 THEN concat('kafka.server<type=Broker-', p_type, ', name=', p_name, '><>Count')
             WHEN 1 THEN concat('kafka.server<type=', p_type, ', name=', p_name, '><>OneMinuteRate')
             WHEN 2 THEN concat('kafka.controller<type=', p_type, ', name=', p_name, '><>Value')
             WHEN 3 THEN concat('kafka.network<type=', p_type, ', name=', p_name, '><>AverageIdlePercent')
             WHEN 4 THEN concat('kafka.log<type=Log, name=Size, topic=', p_brand, ', partition=', p_size, '><>Value')
             WHEN 5 THEN concat('kafka.server<type=ReplicaManager, name=Lag, topic=', p_brand, ', partition=', p_size, '><>Value')
             WHEN 6 THEN concat('kafka.server<type=KafkaServer, name=', p_name, '><>Value')
             WHEN 7 THEN concat('io.confluent.telemetry.http.exporter<type=', p_type, ', name=', p_name, '><>Count')
             ELSE concat('other<type=', p_type, '><>Count') END AS bean""",
    )


def _renamed(spark, folder, order):
    rows = metrics.rename_metrics(_beans(spark, folder), rulebook.RENAME_RULES, order=order)
    labels = [F.col("labels")[name].alias(name) for name in ("topic", "partition")]
    return rows.select("p_partkey", "metric", *labels)


def rename_given(spark, folder):
    return _renamed(spark, folder, "as_given")


def rename_specific(spark, folder):
    return _renamed(spark, folder, "most_specific_first")


def include(spark, folder):
    named = fixtures.table(spark, folder, "part").selectExpr(
        "p_partkey",
        """CASE p_partkey % 4
             WHEN 0 THEN concat('io.confluent.kafka.server.request.', p_name)
             WHEN 1 THEN concat('io.confluent.kafka.server.request.delta.', p_name)
             WHEN 2 THEN 'io.confluent.kafka.server.log.size'
             ELSE concat('io.confluent.kafka.server.log.size.', p_name) END AS metric""",
    )
    return metrics.include_metrics(named, rulebook.INCLUDED_METRICS)


def promote(spark, folder):
    rows = fixtures.table(spark, folder, "supplier").selectExpr(
        "s_suppkey",
        "map('name', s_name) AS labels",
        """map('host.hostname', concat('h', s_nationkey), 'kafka.broker.id', cast(s_suppkey % 3 AS string),
               'process.pid', cast(s_suppkey AS string)) AS attributes""",
    )
    promoted = metrics.promote_attributes(rows, rulebook.PROMOTED_ATTRIBUTES)
    return promoted.select(
        "s_suppkey",
        F.col("labels")["name"].alias("name"),
        F.col("labels")["host_hostname"].alias("host"),
        F.col("labels")["kafka_broker_id"].alias("broker"),
        F.size("labels").alias("n_labels"),
    )


def streak(spark, folder):
    """Runs of days with at least one order, per priority and status."""
    active = fixtures.daily_orders(spark, folder).select(
        "metric", F.col("labels")["broker"].alias("status"), "value", "eval_ts"
    )
    runs = alerts.streaks(active, DAY, ["metric", "status"])
    return runs.select(
        "metric", "status", "steps",
        F.unix_seconds("starts_at").alias("starts_s"),
        F.unix_seconds("last_active").alias("last_s"),
        F.col("value").cast("bigint").alias("value"),
    )


def _alert_rows(found):
    return found.select(
        "alert", "severity", "state", "summary", "description",
        F.col("labels")["broker"].alias("broker"),
        F.col("value").cast("bigint").alias("value"),
        F.unix_seconds("starts_at").alias("starts_s"),
        F.unix_seconds("fired_at").alias("fired_s"),
        F.unix_seconds("ends_at").alias("ends_s"),
    )


def states(spark, folder):
    """The standing threshold rules on the daily grid."""
    vector = fixtures.daily_orders(spark, folder)
    as_of = F.lit(AS_OF).cast("timestamp")
    rules = [rule for rule in rulebook.ALERT_RULES if rule.offset_seconds is None]
    found = alerts.evaluate_alerts(
        vector.filter(F.col("eval_ts") <= as_of), rules, as_of, step_seconds=DAY, close_after_seconds=DAY
    )
    return _alert_rows(found)


def _status_counts(spark, folder):
    """Orders per priority and day, under a broker label that changes with the count."""
    return (
        fixtures.table(spark, folder, "orders")
        .groupBy("o_orderpriority", "o_orderdate")
        .agg(F.count("*").alias("n"))
        .selectExpr(
            "'orders' AS metric",
            "map('priority', o_orderpriority, 'broker', cast(n % 2 AS string)) AS labels",
            "cast(n AS double) AS value",
            "cast(o_orderdate AS timestamp) AS eval_ts",
        )
    )


def changed(spark, folder):
    """Counts that differ from the day before; the broker label changes and is ignored."""
    found = metrics.offset_join(_status_counts(spark, folder), "orders", "!=", DAY, ("broker",))
    return found.select(
        F.col("labels")["priority"].alias("priority"),
        F.col("value").cast("bigint").alias("value"),
        F.size("labels").alias("n_labels"),
        F.unix_seconds("eval_ts").alias("eval_s"),
    )


def changed_alert(spark, folder):
    rule = AlertRule(
        "CountChanged", "orders", "!=", None, for_seconds=2 * DAY, severity="warning",
        offset_seconds=DAY, ignoring=("broker",), summary="changed", description="Changed by {{ $value }}.",
    )
    as_of = F.lit("2030-01-01 00:00:00").cast("timestamp")
    found = alerts.evaluate_alerts(_status_counts(spark, folder), [rule], as_of, DAY, DAY)
    return _alert_rows(found.withColumn("labels", F.map_concat("labels", F.create_map(F.lit("broker"), "labels.priority"))))


def _partition_counts(spark, folder):
    """Partitions per topic on a one-minute grid, a minute a ship date, under a broker label that changes with the count."""
    return (
        fixtures.table(spark, folder, "lineitem")
        .groupBy(F.concat("l_returnflag", "l_linestatus").alias("topic"), "l_shipdate")
        .agg(F.countDistinct("l_linenumber").alias("n"))
        .selectExpr(
            "'kafka_server_partition_count' AS metric",
            "map('topic', topic, 'broker', cast(n % 2 AS string)) AS labels",
            "cast(n AS double) AS value",
            "timestamp_seconds(unix_date(cast(l_shipdate AS date)) * 60L) AS eval_ts",
        )
    )


def minute_vector(spark, folder):
    """The metrics of all alert rules on a one-minute grid, a minute a day."""
    minute = F.timestamp_seconds(F.unix_date(F.col("eval_ts").cast("date")) * F.lit(60).cast("long"))
    daily = fixtures.daily_orders(spark, folder).withColumn("eval_ts", minute)
    return daily.unionByName(_partition_counts(spark, folder))


def minute_alert_rows(found):
    """The topic of a partition count is shown as broker."""
    shown = F.coalesce(F.col("labels")["broker"], F.col("labels")["topic"])
    return _alert_rows(found.withColumn("labels", F.create_map(F.lit("broker"), shown)))


def partition_count_alert(spark, folder):
    """The configured rule over its own past; the topic is shown as broker."""
    rules = [rule for rule in rulebook.ALERT_RULES if rule.offset_seconds is not None]
    as_of = F.lit("2030-01-01 00:00:00").cast("timestamp")
    found = alerts.evaluate_alerts(_partition_counts(spark, folder), rules, as_of, 60, 60)
    return _alert_rows(found.withColumn("labels", F.map_concat("labels", F.create_map(F.lit("broker"), "labels.topic"))))


def _vector_sql() -> str:
    names = ", ".join(f"'{m}'" for m in METRICS)
    return f"""v AS (SELECT ([{names}])[l_partkey % {len(METRICS)} + 1] AS metric,
        CASE WHEN l_returnflag = 'R' THEN '__cluster_metadata' ELSE l_returnflag END AS topic,
        cast(l_linenumber AS varchar) AS partition_no, cast(l_suppkey % 3 AS varchar) AS kafka_broker_id,
        'c1' AS kafka_cluster_id, l_suppkey % 2 = 0 AS is_broker_job,
        cast(CASE WHEN l_discount = 0 THEN 0 WHEN l_tax = 0 THEN 1 ELSE round(l_extendedprice * 100) END AS bigint) AS value,
        strftime(l_shipdate, '%Y-%m-%d') AS day FROM lineitem)"""


def _recording_sql() -> str:
    def one(record, metric, by, agg="sum(value)", where="true", source="v"):
        shown = [c if c in by else f"NULL::varchar AS {c}" for c in ("kafka_broker_id", "kafka_cluster_id", "topic")]
        return f"""SELECT '{record}' AS record, {", ".join(shown)}, cast({agg} AS bigint) AS value, day
            FROM {source} WHERE metric = '{metric}' AND {where} GROUP BY day, {", ".join(by)}"""

    user_topics = "topic <> '__cluster_metadata'"
    parts = []
    for rule in rulebook.RECORDING_RULES:
        if rule.inner_by:
            parts.append(one(rule.record, rule.metric, rule.by, source="mx"))
        elif rule.agg == "count":
            parts.append(one(rule.record, rule.metric, rule.by, "count(*)", "value > 0"))
        else:
            parts.append(one(rule.record, rule.metric, rule.by, where=user_topics if rule.matchers else "true"))
    inner = "mx AS (SELECT metric, partition_no, topic, kafka_cluster_id, day, max(value) AS value FROM v GROUP BY ALL)"
    return f"WITH {_vector_sql()}, {inner} " + " UNION ALL ".join(parts)


_SAMPLES = """s AS (SELECT event_type AS metric, cast(user_id % 10 AS varchar) AS grp,
    cast(round(value * 100) AS bigint) AS value, epoch_us(ts) AS us FROM events),
  spread AS (SELECT metric, grp, value, us, unnest(generate_series(
      cast(ceil(us / 3600000000.0) AS bigint) * 3600, (us + 10800000000 - 1) // 3600000000 * 3600, 3600)) AS eval_s FROM s),
  iv AS (SELECT metric, grp, eval_s, arg_max(value, us) AS value FROM spread GROUP BY ALL)"""


def _rename_sql(specific: bool) -> str:
    def name(text):
        return f"lower(regexp_replace({text}, '[^a-zA-Z0-9:]+', '_', 'g'))"

    replica = """CASE p_partkey % 9 WHEN 5 THEN 'io_confluent_kafka_server_ReplicaManager_Lag, topic=' || p_brand || ', partition=' || p_size
        WHEN 6 THEN 'io_confluent_kafka_server_KafkaServer_' || p_name END"""
    if specific:
        replica = """CASE p_partkey % 9 WHEN 5 THEN 'io_confluent_kafka_server_partition_Lag'
            WHEN 6 THEN 'io_confluent_kafka_server_' || p_name END"""
    labelled = "p_partkey % 9 IN (4, 5)" if specific else "p_partkey % 9 = 4"
    raw = f"""CASE p_partkey % 9
        WHEN 0 THEN 'io_confluent_kafka_server_Broker-' || p_type || '_' || p_name
        WHEN 1 THEN 'io_confluent_kafka_server_' || p_type || '_' || p_name || '_rate'
        WHEN 2 THEN 'io_confluent_kafka_server_controller_' || p_type || '_' || p_name
        WHEN 3 THEN 'io_confluent_kafka_server_network_' || p_type || '_' || p_name
        WHEN 4 THEN 'io_confluent_kafka_server_log_Log_Size'
        WHEN 7 THEN 'io_confluent_telemetry_http_exporter_' || p_type || '_' || p_name
        ELSE {replica} END"""
    return f"""SELECT p_partkey, {name(raw)} AS metric, CASE WHEN {labelled} THEN p_brand END AS topic,
        CASE WHEN {labelled} THEN cast(p_size AS varchar) END AS "partition" FROM part WHERE p_partkey % 9 <> 8"""


_DAILY = """d AS (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'kafka_server_broker_state'
      WHEN '2-HIGH' THEN 'kafka_cluster_partition_under_replicated' WHEN '3-MEDIUM' THEN 'kafka_cluster_partition_offline'
      WHEN '4-NOT SPECIFIED' THEN 'kafka_server_log_flush_rate' WHEN '5-LOW' THEN 'kafka_controller_active_controller_count' END AS metric,
    o_orderstatus AS status, cast(floor(epoch(o_orderdate)) AS bigint) AS s, count(*) - 1 AS value
    FROM orders GROUP BY o_orderpriority, o_orderstatus, o_orderdate)"""


def _runs_sql(source: str, keys: str, step: int = DAY) -> str:
    return f"""SELECT {keys}, min(s) AS starts_s, max(s) AS last_s, count(*) AS steps, arg_max(value, s) AS value
        FROM (SELECT *, s // {step} - row_number() OVER (PARTITION BY {keys} ORDER BY s) AS run FROM {source})
        GROUP BY {keys}, run"""


def _states_sql(source: str, as_of: str, step: int, waits: dict[str, int]) -> str:
    """The threshold rules over ``source`` (metric, status, s, value); ``waits`` in steps, 1 by default."""
    rows = {
        "kafka_server_broker_state": ("BrokerDown", "critical", "value = 1",
            "'Kafka broker ' || status || ' is down'", "'Kafka broker ' || status || ' is not running.'"),
        "kafka_cluster_partition_under_replicated": ("UnderReplicatedPartitions", "warning", "value > 0",
            "'Under-replicated partitions detected'", "'There are ' || value || ' under-replicated partitions in the cluster.'"),
        "kafka_cluster_partition_offline": ("OfflinePartitions", "critical", "value > 0",
            "'Offline partitions detected'", "'There are ' || value || ' offline partitions in the cluster.'"),
        "kafka_server_log_flush_rate": ("SlowLogFlush", "warning", "value < 1",
            "'Kafka broker ' || status || ' has low log flush rate'", "'Log flush rate is below threshold: ' || value"),
        "kafka_controller_active_controller_count": ("ControllerNotActive", "critical", "value <> 1",
            "'Kafka controller is not active'", "'No active Kafka controller detected in the cluster.'"),
    }
    parts = []
    for metric, (alert, severity, where, summary, description) in rows.items():
        wait = waits.get(alert, 1) * step
        runs = _runs_sql(f"(SELECT * FROM {source} WHERE metric = '{metric}' AND s <= {as_of} AND {where})", "status", step)
        parts.append(f"""SELECT '{alert}' AS alert, '{severity}' AS severity,
            CASE WHEN last_s + {step} <= {as_of} THEN 'resolved' WHEN starts_s + {wait} <= last_s THEN 'firing' ELSE 'pending' END AS state,
            {summary} AS summary, {description} AS description, status AS broker, value, starts_s,
            CASE WHEN starts_s + {wait} <= last_s THEN starts_s + {wait} END AS fired_s,
            CASE WHEN last_s + {step} <= {as_of} THEN last_s + {step} END AS ends_s
            FROM ({runs}) WHERE last_s + {step} > {as_of} OR starts_s + {wait} <= last_s""")
    return " UNION ALL ".join(parts)


_CHANGES = """c AS (SELECT l_returnflag || l_linestatus AS topic,
      datediff('day', date '1970-01-01', cast(l_shipdate AS date)) * 60 AS s, count(DISTINCT l_linenumber) AS value
      FROM lineitem GROUP BY ALL),
    ch AS (SELECT a.topic, a.s, a.value FROM c a JOIN c b ON a.topic = b.topic AND a.s = b.s + 60 WHERE a.value <> b.value)"""


def minute_alerts_sql() -> str:
    """All six rules on the one-minute grid, as of its newest step."""
    as_of = "(SELECT max(s) FROM (SELECT s FROM m UNION ALL SELECT s FROM c))"
    changed = _runs_sql("ch", "topic", 60)
    return f"""WITH {_DAILY}, {_CHANGES}, m AS (SELECT metric, status, s // 86400 * 60 AS s, value FROM d)
        {_states_sql("m", as_of, 60, {"SlowLogFlush": 5})}
        UNION ALL SELECT 'PartitionCountChanged', 'warning',
          CASE WHEN last_s + 60 <= {as_of} THEN 'resolved' WHEN starts_s + 60 <= last_s THEN 'firing' ELSE 'pending' END,
          'Partition count change detected', 'Partition count changed by ' || value || ' in the last minute.', topic, value,
          starts_s, CASE WHEN starts_s + 60 <= last_s THEN starts_s + 60 END, CASE WHEN last_s + 60 <= {as_of} THEN last_s + 60 END
        FROM ({changed}) WHERE last_s + 60 > {as_of} OR starts_s + 60 <= last_s"""


_COUNTS = """c AS (SELECT o_orderpriority AS priority, cast(floor(epoch(o_orderdate)) AS bigint) AS s, count(*) AS value
    FROM orders GROUP BY o_orderpriority, o_orderdate),
  ch AS (SELECT a.priority, a.s, a.value FROM c a JOIN c b ON a.priority = b.priority AND a.s = b.s + 86400 WHERE a.value <> b.value)"""

QUERIES = {
    "rule_recording": recording,
    "rule_overview": overview,
    "rule_topic_count": topic_count,
    "rule_over_instant_vector": recording_over_instant,
    "instant_vector": instant,
    "series_matchers": matchers,
    "metric_rename": rename_given,
    "metric_rename_specific": rename_specific,
    "metric_include": include,
    "attribute_promotion": promote,
    "alert_streak": streak,
    "alert_states": states,
    "series_changed_vs_offset": changed,
    "alert_changed_vs_offset": changed_alert,
    "alert_partition_count": partition_count_alert,
}

ORACLE = {
    "rule_recording": _recording_sql(),
    "rule_overview": f"""WITH {_vector_sql()}
        SELECT 'cc_kafka_brokers' AS record, count(*) AS value, day FROM v
        WHERE metric = 'up' AND is_broker_job AND value = 1 GROUP BY day
        UNION ALL SELECT 'cc_kafka_partitions', cast(sum(value) AS bigint), day FROM v
        WHERE metric = 'io_confluent_kafka_server_partition_replicas_count' GROUP BY day
        UNION ALL SELECT 'cc_kafka_leaders', cast(sum(value) AS bigint), day FROM v
        WHERE metric = 'io_confluent_kafka_server_leader_count' GROUP BY day
        UNION ALL SELECT 'cc_kafka_under_replicated', cast(sum(value) AS bigint), day FROM v
        WHERE metric = 'io_confluent_kafka_server_partition_under_replicated' GROUP BY day""",
    "rule_topic_count": f"""WITH {_vector_sql()}
        SELECT 'cc_kafka_topics' AS record, count(DISTINCT topic) AS value, day FROM v
        WHERE metric = 'io_confluent_kafka_server_log_size' GROUP BY day""",
    "rule_over_instant_vector": f"""WITH {_SAMPLES}
        SELECT 'sum_by_grp' AS record, grp, cast(sum(value) AS bigint) AS value, eval_s FROM iv WHERE metric = 'click' GROUP BY ALL
        UNION ALL SELECT 'total', NULL, cast(sum(value) AS bigint), eval_s FROM iv WHERE metric = 'view' GROUP BY eval_s""",
    "instant_vector": f"WITH {_SAMPLES} SELECT metric, grp, value, eval_s FROM iv",
    "series_matchers": f"""WITH {_vector_sql()} SELECT topic, partition_no AS "partition", value, day FROM v
        WHERE metric = '{METRICS[0]}' AND topic <> 'A' AND partition_no IN ('1', '2') AND kafka_broker_id = '0' AND value > 0""",
    "metric_rename": _rename_sql(False),
    "metric_rename_specific": _rename_sql(True),
    "metric_include": """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'io.confluent.kafka.server.request.' || p_name
        ELSE 'io.confluent.kafka.server.log.size' END AS metric FROM part WHERE p_partkey % 4 IN (0, 2)""",
    "attribute_promotion": """SELECT s_suppkey, s_name AS name, 'h' || s_nationkey AS host,
        cast(s_suppkey % 3 AS varchar) AS broker, 3::integer AS n_labels FROM supplier""",
    "alert_streak": f"WITH {_DAILY} {_runs_sql('d', 'metric, status')}",
    "alert_states": f"WITH {_DAILY} " + _states_sql("d", f"cast(epoch(timestamp '{AS_OF}') AS bigint)", DAY, {}),
    "series_changed_vs_offset": f"WITH {_COUNTS} SELECT priority, value, 1::integer AS n_labels, s AS eval_s FROM ch",
    "alert_changed_vs_offset": f"""WITH {_COUNTS}
        SELECT 'CountChanged' AS alert, 'warning' AS severity, 'resolved' AS state, 'changed' AS summary,
          'Changed by ' || value || '.' AS description, priority AS broker, value, starts_s,
          starts_s + 172800 AS fired_s, last_s + 86400 AS ends_s
        FROM ({_runs_sql('ch', 'priority')}) WHERE starts_s + 172800 <= last_s""",
    "alert_partition_count": """WITH c AS (SELECT l_returnflag || l_linestatus AS topic,
          datediff('day', date '1970-01-01', cast(l_shipdate AS date)) * 60 AS s, count(DISTINCT l_linenumber) AS value
          FROM lineitem GROUP BY ALL),
        ch AS (SELECT a.topic, a.s, a.value FROM c a JOIN c b ON a.topic = b.topic AND a.s = b.s + 60 WHERE a.value <> b.value),
        numbered AS (SELECT *, s // 60 - row_number() OVER (PARTITION BY topic ORDER BY s) AS run FROM ch),
        runs AS (SELECT topic, min(s) AS starts_s, max(s) AS last_s, arg_max(value, s) AS value FROM numbered GROUP BY topic, run)
        SELECT 'PartitionCountChanged' AS alert, 'warning' AS severity, 'resolved' AS state,
          'Partition count change detected' AS summary,
          'Partition count changed by ' || value || ' in the last minute.' AS description, topic AS broker, value, starts_s,
          starts_s + 60 AS fired_s, last_s + 60 AS ends_s
        FROM runs WHERE starts_s + 60 <= last_s""",
}
