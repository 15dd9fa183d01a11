"""The standing rules, as data."""

from __future__ import annotations

from tidemark.operators.alerts import AlertRule
from tidemark.operators.metrics import Matcher, RecordingRule, RenameRule

# Metric, label and rule names of the recording rules.
_SERVER = "io_confluent_kafka_server_"
_CLUSTER, _BROKER, _TOPIC, _PARTITION = "kafka_cluster_id", "kafka_broker_id", "topic", "partition"
_USER_TOPICS = (Matcher(_TOPIC, "!=", "__cluster_metadata"),)


def _rule(metric: str, by: str, record: str | None = None, **more) -> RecordingRule:
    labels = {"broker": (_BROKER, _CLUSTER), "topic": (_CLUSTER, _TOPIC), "cluster": (_CLUSTER,)}[by]
    return RecordingRule(f"code:{_SERVER}{record or metric}_by_{by}:total", _SERVER + metric, labels, **more)


RECORDING_RULES = (
    _rule("log_size", "broker", matchers=_USER_TOPICS),
    _rule("log_size", "topic", matchers=_USER_TOPICS),
    _rule("partition_under_min_isr", "broker"),
    _rule("log_tier_size", "broker", matchers=_USER_TOPICS),
    _rule("partition_replicas_count", "topic"),
    _rule("partition_in_sync_replicas_count", "topic"),
    _rule("broker_topic_total_fetch_requests_rate_1_min", "topic"),
    _rule("broker_topic_total_fetch_requests_rate_1_min", "broker"),
    _rule("partition_under_replicated", "broker"),
    _rule("partition_observer_replicas_count", "topic"),
    _rule("partition_under_replicated", "topic"),
    _rule("log_tier_size", "cluster", inner_by=(_PARTITION, _TOPIC, _CLUSTER)),
    _rule("partition_replicas_count", "topic", record="partition_count", agg="count", keep=(">", 0)),
    _rule("partition_caught_up_replicas_count", "topic"),
    _rule("log_tier_size", "topic", inner_by=(_TOPIC, _PARTITION, _CLUSTER)),
)

# The overview rules without grouping; the count of topics is
# metrics.count_by_count over log_size.
OVERVIEW_RULES = (
    RecordingRule("cc_kafka_brokers", "up", (), "count", (Matcher("job", "=", "kafka-brokers"),), ("==", 1)),
    RecordingRule("cc_kafka_partitions", _SERVER + "partition_replicas_count", ()),
    RecordingRule("cc_kafka_leaders", _SERVER + "leader_count", ()),
    RecordingRule("cc_kafka_under_replicated", _SERVER + "partition_under_replicated", ()),
)
OVERVIEW_TOPICS = ("cc_kafka_topics", _SERVER + "log_size", (_TOPIC,))

# The alert rules and their texts.
ALERT_RULES = (
    AlertRule(
        "BrokerDown",
        "kafka_server_broker_state",
        "==",
        1,
        for_seconds=60,
        severity="critical",
        matchers=(Matcher("state", "=", "NotRunning"),),
        summary="Kafka broker {{ $labels.broker }} is down",
        description="Kafka broker {{ $labels.broker }} is not running.",
    ),
    AlertRule(
        "UnderReplicatedPartitions",
        "kafka_cluster_partition_under_replicated",
        ">",
        0,
        for_seconds=60,
        severity="warning",
        summary="Under-replicated partitions detected",
        description="There are {{ $value }} under-replicated partitions in the cluster.",
    ),
    AlertRule(
        "OfflinePartitions",
        "kafka_cluster_partition_offline",
        ">",
        0,
        for_seconds=60,
        severity="critical",
        summary="Offline partitions detected",
        description="There are {{ $value }} offline partitions in the cluster.",
    ),
    AlertRule(
        "SlowLogFlush",
        "kafka_server_log_flush_rate",
        "<",
        1,
        for_seconds=300,
        severity="warning",
        summary="Kafka broker {{ $labels.broker }} has low log flush rate",
        description="Log flush rate is below threshold: {{ $value }}",
    ),
    AlertRule(
        "ControllerNotActive",
        "kafka_controller_active_controller_count",
        "!=",
        1,
        for_seconds=60,
        severity="critical",
        summary="Kafka controller is not active",
        description="No active Kafka controller detected in the cluster.",
    ),
    AlertRule(
        "PartitionCountChanged",
        "kafka_server_partition_count",
        "!=",
        None,
        for_seconds=60,
        severity="warning",
        offset_seconds=60,
        ignoring=("broker",),
        summary="Partition count change detected",
        description="Partition count changed by {{ $value }} in the last minute.",
    ),
)

# The metric rename rules, in their given order.
RENAME_RULES = (
    RenameRule("kafka.server<type=(.+), name=(.+)><>(Count|Value)", "io_confluent_kafka_server_$1_$2"),
    RenameRule(
        "kafka.server<type=(.+), name=(.+)><>(OneMinuteRate|FiveMinuteRate|FifteenMinuteRate|MeanRate)",
        "io_confluent_kafka_server_$1_$2_rate",
    ),
    RenameRule(
        "kafka.controller<type=(.+), name=(.+)><>(Count|Value)", "io_confluent_kafka_server_controller_$1_$2"
    ),
    RenameRule(
        "kafka.network<type=(.+), name=(.+)><>(Count|Value|AverageIdlePercent)",
        "io_confluent_kafka_server_network_$1_$2",
    ),
    RenameRule(
        "kafka.log<type=(.+), name=(.+), topic=(.+), partition=(.+)><>(Count|Value|Rate|Size)",
        "io_confluent_kafka_server_log_$1_$2",
        {"topic": "$3", "partition": "$4"},
    ),
    RenameRule(
        "kafka.server<type=ReplicaManager, name=(.+), topic=(.+), partition=(.+)><>(Count|Value)",
        "io_confluent_kafka_server_partition_$1",
        {"topic": "$2", "partition": "$3"},
    ),
    RenameRule("kafka.server<type=KafkaServer, name=(.+)><>(Count|Value)", "io_confluent_kafka_server_$1"),
    RenameRule(
        "io.confluent.telemetry.http.exporter<type=(.+), name=(.+)><>(Count|Value)",
        "io_confluent_telemetry_http_exporter_$1_$2",
    ),
)

# Resource attributes that become labels.
PROMOTED_ATTRIBUTES = (
    "host.hostname",
    "java.version",
    "kafka.broker.id",
    "kafka.cluster.id",
    "kafka.version",
    "type",
)

# Metrics that are collected at all, as regular expressions.
INCLUDED_METRICS = (
    "io.confluent.kafka.server.request.(?!.*delta).*",
    "io.confluent.kafka.server.server.broker.state",
    "io.confluent.kafka.server.replica.manager.leader.count",
    "io.confluent.kafka.server.request.queue.size",
    "io.confluent.kafka.server.broker.topic.failed.produce.requests.rate.1.min",
    "io.confluent.kafka.server.tier.archiver.total.lag",
    "io.confluent.kafka.server.request.total.time.ms.p99",
    "io.confluent.kafka.server.broker.topic.failed.fetch.requests.rate.1.min",
    "io.confluent.kafka.server.broker.topic.total.fetch.requests.rate.1.min",
    "io.confluent.kafka.server.partition.caught.up.replicas.count",
    "io.confluent.kafka.server.partition.observer.replicas.count",
    "io.confluent.kafka.server.tier.tasks.num.partitions.in.error",
    "io.confluent.kafka.server.broker.topic.bytes.out.rate.1.min",
    "io.confluent.kafka.server.request.total.time.ms.p95",
    "io.confluent.kafka.server.controller.active.controller.count",
    "io.confluent.kafka.server.request.total.time.ms.p999",
    "io.confluent.kafka.server.controller.active.broker.count",
    "io.confluent.kafka.server.request.handler.pool.request.handler.avg.idle.percent.rate.1.min",
    "io.confluent.kafka.server.controller.unclean.leader.elections.rate.1.min",
    "io.confluent.kafka.server.replica.manager.partition.count",
    "io.confluent.kafka.server.controller.unclean.leader.elections.total",
    "io.confluent.kafka.server.partition.replicas.count",
    "io.confluent.kafka.server.broker.topic.total.produce.requests.rate.1.min",
    "io.confluent.kafka.server.controller.offline.partitions.count",
    "io.confluent.kafka.server.socket.server.network.processor.avg.idle.percent",
    "io.confluent.kafka.server.partition.under.replicated",
    "io.confluent.kafka.server.log.log.start.offset",
    "io.confluent.kafka.server.log.tier.size",
    "io.confluent.kafka.server.log.size",
    "io.confluent.kafka.server.tier.fetcher.bytes.fetched.total",
    "io.confluent.kafka.server.request.total.time.ms.p50",
    "io.confluent.kafka.server.tenant.consumer.lag.offsets",
    "io.confluent.kafka.server.log.log.end.offset",
    "io.confluent.kafka.server.broker.topic.bytes.in.rate.1.min",
    "io.confluent.kafka.server.partition.under.min.isr",
    "io.confluent.kafka.server.partition.in.sync.replicas.count",
    "io.confluent.telemetry.http.exporter.batches.dropped",
    "io.confluent.telemetry.http.exporter.items.total",
    "io.confluent.telemetry.http.exporter.items.succeeded",
    "io.confluent.telemetry.http.exporter.send.time.total.millis",
    "io.confluent.kafka.server.controller.leader.election.rate.(?!.*delta).*",
    "io.confluent.telemetry.http.exporter.batches.failed",
)
