"""Registered queries that run as streams and then read their sink.

Each first writes its input as log files in several parts, in order, and lets
the stream take the files of one part per micro-batch.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import fold, lookup
from tidemark.operators.alerts import AlertRule
from tidemark.plans import cdc, enrich, fixtures, rules
from tidemark.plans.fixtures import DAY
from tidemark.sources import files
from tidemark.sources.envelope import accepted, parse_redeems
from tidemark.streaming import io, jobs, state
from tidemark.streaming.lookups import FollowingJoin, Lookups, enrich_following
from tidemark.streaming.versions import VersionedJoin


FILES = 4  # per part, at least
ROWS = 100_000  # a file, so that a batch of many rows is read by many tasks
BUCKETS = 8  # of keyed tables, for inputs of this size


def _parts(rows, by: str, path: str, cuts=(1 / 3, 2 / 3)) -> int:
    """Write rows in consecutive ranges of ``by``, one after the other; the last takes all others too. Gives the files of each."""
    column = F.col(by)
    number = (column.cast("timestamp") if "timestamp" in dict(rows.dtypes)[by] else column).cast("double")
    finite = F.when(~F.isnan(number), number)
    low, high, n = rows.agg(F.min(finite), F.max(finite), F.count("*")).first()
    files = max(FILES, n // ((len(cuts) + 1) * ROWS))
    place = (finite - (low or 0)) / (((high or 0) - (low or 0)) or 1)
    part = F.lit(len(cuts))
    for i in reversed(range(len(cuts))):
        part = F.when(place < cuts[i], i).otherwise(part)
    for i in range(len(cuts) + 1):
        rows.filter(part == i).repartition(files).write.mode("append").parquet(path)
    return files


def _stream(spark, rows, by: str, label: str):
    """Rows written in parts and read back as a stream, with a folder for its outputs."""
    base = session.scratch_dir(spark, label)
    files = _parts(rows, by, f"{base}/in")
    reader = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files)
    return reader.parquet(f"{base}/in"), base


def stream_fold(spark, folder):
    records, base = _stream(spark, fixtures.change_log(spark, folder), "offset", "fold")
    io.finish(jobs.materialize_changes(records, f"{base}/entries", f"{base}/cp", order="offset"))
    return fold.state_from_entries(fold.reduce_entries(fold.read_entries(spark, f"{base}/entries")))


def stream_fold_compacted(spark, folder):
    records, base = _stream(spark, fixtures.change_log(spark, folder), "offset", "fold")
    io.finish(jobs.materialize_changes(records, f"{base}/entries", f"{base}/cp", order="offset"))
    fold.compact_entries(spark, f"{base}/entries", f"{base}/compacted")
    return fold.state_from_entries(fold.reduce_entries(fold.read_entries(spark, f"{base}/compacted")))


def stream_state(spark, folder):
    """The maintained table: documents renewed after the second batch, and one batch since."""
    records, base = _stream(spark, fixtures.change_log(spark, folder), "offset", "state")
    io.finish(jobs.maintain_state(records, f"{base}/state", f"{base}/cp", order="offset", every=2, buckets=BUCKETS))
    return state.current(spark, f"{base}/state", BUCKETS)


def stream_rejects(spark, folder):
    records, base = _stream(spark, fixtures.change_log(spark, folder, broken=True), "offset", "rejects")
    query = jobs.materialize_changes(
        records, f"{base}/entries", f"{base}/cp", rejects=f"{base}/rejects", order="offset"
    )
    io.finish(query)
    return io.read_batches(spark, f"{base}/rejects").select(F.col("seq").alias("event_id"), "reject")


def stream_latest(spark, folder):
    records, base = _stream(spark, fixtures.change_log(spark, folder), "offset", "latest")
    deleted = F.get_json_object("value", "$.operationType") == "delete"
    rows = records.select("key", "offset", F.when(~deleted, F.col("value")).alias("value"))
    io.finish(jobs.upsert_rows(rows, f"{base}/table", f"{base}/cp", ["key"], F.col("offset"), buckets=BUCKETS))
    latest = jobs.latest_rows(spark, f"{base}/table", ["key"], F.col("value").isNull())
    return latest.select("key", "offset")


def stream_enrich(spark, folder):
    records, base = _stream(spark, fixtures.redeem_log(spark, folder), "offset", "enrich")

    def read_lookup():
        return lookup.first_per_name(fixtures.keywords(spark, folder), fixtures.programs(spark, folder))

    io.finish(jobs.enrich_redeems(records, read_lookup, f"{base}/out", f"{base}/cp"))
    return io.read_batches(spark, f"{base}/out")


def _phases(spark, folder, label):
    """The changing log, a phase per batch."""
    records, base = _stream(spark, fixtures.changing_log(spark, folder), "phase", label)
    return records.drop("phase"), base


def stream_enrich_following(spark, folder):
    """Redeems enriched by keyword and program tables that their change streams keep, as of each batch."""
    records, base = _phases(spark, folder, "following")
    tables = Lookups(spark, f"{base}/tables", BUCKETS)
    io.finish(enrich_following(records, tables, f"{base}/out", f"{base}/cp", "with_event", ["transaction_id"]))
    return io.read_batches(spark, f"{base}/out")


def stream_left_following(spark, folder):
    """The last message of every result row of redeems and keywords, both changing."""
    records, base = _phases(spark, folder, "join")
    join = FollowingJoin(spark, f"{base}/join", BUCKETS)
    io.finish(join.start(records, f"{base}/cp"))
    return join.result()


def stream_dedup(spark, folder):
    """Every redeem is sent twice; one of each is kept."""
    redeems = fixtures.redeem_log(spark, folder)
    again = redeems.withColumn("partition", F.lit(1))
    records, base = _stream(spark, redeems.unionByName(again), "timestamp", "dedup")
    rows = io.watermarked(accepted(parse_redeems(records)), "kafka_timestamp", io.TABLE_DELAY)
    once = io.drop_copies(rows, ["transaction_id"])
    out = once.select("transaction_id", "keyword")
    io.finish(io.start_files(out, f"{base}/out", f"{base}/cp"))
    return spark.read.parquet(f"{base}/out")


def _late_split(spark, folder):
    records, base = _stream(spark, fixtures.slipped_events(spark, folder), "phase", "late")
    split = io.LateSplit(f"{base}/split", "ts")
    io.finish(split.start(records, f"{base}/cp"))
    return split


def stream_late_rows(spark, folder):
    """Rows that come after the watermark of the five-second job, and those in time."""
    return _late_split(spark, folder).rows(spark).select("event_id", "late")


def stream_late_counts(spark, folder):
    counts = spark.read.parquet(f"{_late_split(spark, folder).path}/counts")
    return counts.select(
        F.col("batch").cast("bigint").alias("batch"), "n_in_time", "n_late", F.unix_micros("watermark").alias("watermark_us")
    )


def stream_eligibility(spark, folder):
    records, base = _stream(spark, fixtures.redeem_log(spark, folder, names=None), "offset", "eligibility")
    as_of = F.lit(enrich.AS_OF).cast("timestamp")
    io.finish(
        jobs.judge_redeems(records, lambda: fixtures.keywords(spark, folder, None), f"{base}/out", f"{base}/cp", as_of)
    )
    return io.read_batches(spark, f"{base}/out").select(
        "transaction_id", "keyword", "start_period", "end_period", "reason"
    )


def stream_eligibility_keyed(spark, folder):
    """The same as keyed messages, with the latency up to a fixed moment."""
    records, base = _stream(spark, fixtures.redeem_log(spark, folder, names=None), "offset", "eligibility")
    as_of, now = F.lit(enrich.AS_OF).cast("timestamp"), F.lit("2024-03-01 00:00:00").cast("timestamp")
    keywords = lambda: fixtures.keywords(spark, folder, None)
    io.finish(jobs.judge_redeems(records, keywords, f"{base}/out", f"{base}/cp", as_of, keyed=True, now=now))
    return io.read_batches(spark, f"{base}/out")


def stream_redeem_columns(spark, folder):
    """Stateless pipeline: parse, project, append."""
    records, base = _stream(spark, fixtures.redeem_log(spark, folder), "offset", "redeems")
    io.finish(io.start_files(enrich.flat(accepted(parse_redeems(records))), f"{base}/out", f"{base}/cp"))
    return spark.read.parquet(f"{base}/out")


def stream_asof(spark, folder):
    """Both sides stream in parts; the second half of each part's versions comes one batch after its probes."""
    probes, base = _stream(spark, fixtures.probes(spark, folder), "probe_ts", "asof")
    history = fixtures.versions(spark, folder, "signup")
    files = _parts(history, "version_ts", f"{base}/versions", cuts=(1 / 6, 1 / 2))
    reader = spark.readStream.schema(history.schema).option("maxFilesPerTrigger", files)
    join = VersionedJoin(
        spark, f"{base}/join", ["user_id"], "probe_ts", "version_ts", 5, tie_order="version_id", buckets=BUCKETS
    )
    io.finish(join.start(probes, reader.parquet(f"{base}/versions"), f"{base}/cp"))
    return join.answers().select("probe_id", "version_id", "cents")


def _samples(spark, folder):
    """Daily newest event per series, as a stream of finished steps."""
    samples, base = _stream(spark, fixtures.event_samples(spark, folder), "ts", "steps")
    return jobs.step_values(samples, DAY), base


def _kept_back(spark, base):
    """The steps still open when the stream has ended."""
    return jobs.open_steps(spark.read.parquet(f"{base}/in"), DAY)


def stream_steps(spark, folder):
    """Here and below, with the steps that are within the delay of the newest sample when the stream ends."""
    steps, base = _samples(spark, folder)
    io.finish(io.start_files(steps, f"{base}/out", f"{base}/cp"))
    found = spark.read.parquet(f"{base}/out").unionByName(_kept_back(spark, base))
    return found.select(
        "metric", F.col("labels")["grp"].alias("grp"), F.col("value").cast("bigint").alias("value"),
        F.unix_seconds("eval_ts").alias("eval_s"),
    )


def stream_rules(spark, folder):
    steps, base = _samples(spark, folder)
    rule = rules.metrics.RecordingRule("clicks", "click", ("half",))
    io.finish(jobs.record_rules(steps, [rule], f"{base}/out", f"{base}/cp"))
    found = io.read_batches(spark, f"{base}/out")
    found = found.unionByName(rules.metrics.evaluate_rules(_kept_back(spark, base), [rule]))
    return found.select(
        "record", F.col("labels")["half"].alias("half"), F.col("value").cast("bigint").alias("value"),
        F.unix_seconds("eval_ts").alias("eval_s"),
    )


_LOW = AlertRule("LowValue", "click", "<", 3000, for_seconds=DAY, severity="warning")


def stream_alerts(spark, folder):
    steps, base = _samples(spark, folder)
    io.finish(jobs.watch(steps, _LOW, f"{base}/alerts", f"{base}/cp", DAY, DAY))
    found = jobs.watched_to_end(_kept_back(spark, base), _LOW, f"{base}/alerts", DAY, DAY)
    return found.select(
        F.map_from_entries("series")["grp"].alias("grp"), "state", "steps",
        F.col("value").cast("bigint").alias("value"),
        F.unix_seconds("starts_at").alias("starts_s"),
        F.unix_seconds("last_active").alias("last_s"),
    )


HOUR, LOOKBACK = 3600, 10_800


def _vector(spark, folder):
    """Hourly evaluation of the event samples, each visible for three hours, and what is still open in the end."""
    samples, base = _stream(spark, fixtures.event_samples(spark, folder), "ts", "vector")
    return jobs.stream_vector(samples, HOUR, LOOKBACK), base


def _open_vector(spark, base):
    return jobs.open_vector(spark.read.parquet(f"{base}/in"), HOUR, LOOKBACK)


def stream_vector(spark, folder):
    vector, base = _vector(spark, folder)
    io.finish(io.start_files(vector, f"{base}/out", f"{base}/cp"))
    found = spark.read.parquet(f"{base}/out").unionByName(_open_vector(spark, base))
    return found.select(
        "metric", F.col("labels")["grp"].alias("grp"), F.col("value").cast("bigint").alias("value"),
        F.unix_seconds("eval_ts").alias("eval_s"),
    )


def stream_rules_over_vector(spark, folder):
    """Samples to instant vector to recording rules, as the rules run in sequence, with look-back across steps."""
    vector, base = _vector(spark, folder)
    io.finish(jobs.record_rules(vector, rules.SUMS, f"{base}/out", f"{base}/cp"))
    found = io.read_batches(spark, f"{base}/out")
    return rules.flat_sums(found.unionByName(rules.metrics.evaluate_rules(_open_vector(spark, base), rules.SUMS)))


def stream_alert_states(spark, folder):
    """All six configured alert rules in one stream, on a one-minute grid, up to its newest step."""
    vector = rules.minute_vector(spark, folder)
    stream, base = _stream(spark, vector, "eval_ts", "states")
    path = f"{base}/alerts"
    io.finish(jobs.watch(stream, rules.rulebook.ALERT_RULES, path, f"{base}/cp", 60, 60))
    return rules.minute_alert_rows(rules.alerts.described(jobs.watched(spark, path), rules.rulebook.ALERT_RULES))


def stream_logs(spark, folder):
    """Log files written from the documents, collected with labels."""
    base = session.scratch_dir(spark, "logs")
    lines = fixtures.table(spark, folder, "documents").select(F.explode(F.split("text", "\n")).alias("value"))
    lines.write.text(f"{base}/logs")
    collected = files.stream_logs(spark, [files.LogJob(f"{base}/logs/*.txt", {"job": "documents"})])
    io.finish(io.start_files(collected, f"{base}/out", f"{base}/cp"))
    return spark.read.parquet(f"{base}/out").select("value", F.col("labels")["job"].alias("job"))


_STEPS = """s AS (SELECT event_type AS metric, cast(user_id % 10 AS varchar) AS grp,
    cast(round(value * 100) AS bigint) AS value, epoch_us(ts) AS us FROM events),
  steps AS (SELECT metric, grp, cast(ceil(us / 86400000000.0) AS bigint) * 86400 AS eval_s, arg_max(value, us) AS value
    FROM s GROUP BY ALL)"""

_LATE = """e AS (SELECT event_id, epoch_us(ts) AS us FROM events), ends AS (SELECT min(us) AS low, max(us) AS high FROM e),
  p AS (SELECT event_id, us, least((us - low) * 3 // (high - low + 1) + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END, 2) AS phase
    FROM e, ends),
  w AS (SELECT phase, max(max(us)) OVER (ORDER BY phase) - 5000000 AS after FROM p GROUP BY phase),
  l AS (SELECT p.event_id, p.phase, coalesce(p.us <= w.after, false) AS late FROM p LEFT JOIN w ON w.phase = p.phase - 1)"""

QUERIES = {
    "stream_cdc_fold": stream_fold,
    "stream_cdc_fold_compacted": stream_fold_compacted,
    "stream_cdc_state": stream_state,
    "stream_cdc_rejects": stream_rejects,
    "stream_latest_per_key": stream_latest,
    "stream_enrich": stream_enrich,
    "stream_enrich_following": stream_enrich_following,
    "stream_left_following": stream_left_following,
    "stream_dedup": stream_dedup,
    "stream_late_rows": stream_late_rows,
    "stream_late_counts": stream_late_counts,
    "stream_eligibility": stream_eligibility,
    "stream_eligibility_keyed": stream_eligibility_keyed,
    "stream_redeem_columns": stream_redeem_columns,
    "stream_asof": stream_asof,
    "stream_step_values": stream_steps,
    "stream_rules": stream_rules,
    "stream_alerts": stream_alerts,
    "stream_log_collect": stream_logs,
    "stream_step_values_whole": stream_steps,
    "stream_rules_whole": stream_rules,
    "stream_alerts_whole": stream_alerts,
    "stream_instant_vector": stream_vector,
    "stream_rules_over_vector": stream_rules_over_vector,
    "stream_alert_states": stream_alert_states,
}

ORACLE = {
    "stream_cdc_fold": cdc.ORACLE["cdc_fold_removed_intended"],
    "stream_cdc_fold_compacted": cdc.ORACLE["cdc_fold_removed_intended"],
    "stream_cdc_state": cdc.ORACLE["cdc_fold_removed_intended"],
    "stream_cdc_rejects": cdc.ORACLE["cdc_rejects"],
    "stream_latest_per_key": cdc.ORACLE["cdc_latest_per_key"],
    "stream_enrich": enrich.ORACLE["lookup_message"],
    "stream_enrich_following": f"""WITH {enrich.PHASES},
        f AS (SELECT kd.phase, kd.name, arg_min(kd.doc, kd.id) AS keyword_doc, arg_min(p.doc, kd.id) AS program_doc
              FROM kd JOIN p ON p.phase = kd.phase AND p.id = kd.program_id WHERE kd.name IS NOT NULL GROUP BY kd.phase, kd.name)
        SELECT '{{"event":{{"transaction_id":' || coalesce('"' || tx || '"', 'null') || '}},"keyword":' || keyword_doc ||
          ',"program":' || program_doc || ',"customer":null}}' AS value
        FROM r JOIN f ON f.phase = r.phase AND f.name = r.keyword""",
    "stream_left_following": f"""WITH {enrich.PHASES}
        SELECT '{{"transaction_id":"' || tx || '","keyword_id":' || coalesce('"' || k.id || '"', 'null') || '}}' AS key,
          '{{"transaction_id":"' || tx || '","keyword":"' || keyword || '","keyword_id":' || coalesce('"' || k.id || '"', 'null') ||
          ',"start_period":' || coalesce(cast(start_period AS varchar), 'null') ||
          ',"end_period":' || coalesce(cast(end_period AS varchar), 'null') || '}}' AS value
        FROM r LEFT JOIN k ON k.phase = 2 AND k.name = r.keyword WHERE tx IS NOT NULL""",
    "stream_dedup": f"WITH {enrich._R} SELECT transaction_id, keyword FROM r",
    "stream_late_rows": f"WITH {_LATE} SELECT event_id, late FROM l",
    "stream_late_counts": f"""WITH {_LATE} SELECT l.phase AS batch, count(*) FILTER (WHERE NOT late) AS n_in_time,
        count(*) FILTER (WHERE late) AS n_late, any_value(w.after) AS watermark_us
        FROM l JOIN w ON w.phase = l.phase GROUP BY l.phase""",
    "stream_eligibility": enrich.ORACLE["eligibility_reason"],
    "stream_eligibility_keyed": f"""WITH judged AS ({enrich.ORACLE["eligibility_reason"]})
        SELECT '{{"transaction_id":"' || transaction_id || '"}}' AS key,
          '{{"transaction_id":"' || transaction_id || '","keyword":"' || keyword || '","start_period":' ||
          coalesce(cast(start_period AS varchar), 'null') || ',"end_period":' || coalesce(cast(end_period AS varchar), 'null') ||
          ',"reason":"' || reason || '","latency_ms":' ||
          cast(trunc((epoch_us(timestamp '2024-03-01') - epoch_us(o_orderdate)) / 1000) AS bigint) || '}}' AS value
        FROM judged JOIN orders ON cast(o_orderkey AS varchar) = transaction_id""",
    "stream_redeem_columns": enrich.ORACLE["redeem_columns"],
    "stream_asof": enrich.ORACLE["asof_left"],
    "stream_step_values": f"WITH {_STEPS} SELECT metric, grp, value, eval_s FROM steps",
    "stream_rules": f"""WITH {_STEPS} SELECT 'clicks' AS record, cast(cast(grp AS integer) % 2 AS varchar) AS half,
        cast(sum(value) AS bigint) AS value, eval_s FROM steps WHERE metric = 'click' GROUP BY half, eval_s""",
    "stream_alerts": f"""WITH {_STEPS},
        low AS (SELECT grp, eval_s AS s, value FROM steps WHERE metric = 'click' AND value < 3000),
        runs AS ({rules._runs_sql("low", "grp")}),
        now AS (SELECT max(eval_s) AS s FROM steps)
        SELECT grp, CASE WHEN last_s + 86400 <= now.s THEN 'resolved' WHEN steps > 1 THEN 'firing' ELSE 'pending' END AS state,
          steps, value, starts_s, last_s FROM runs, now WHERE steps > 1 OR last_s + 86400 > now.s""",
    "stream_instant_vector": rules.ORACLE["instant_vector"],
    "stream_rules_over_vector": rules.ORACLE["rule_over_instant_vector"],
    "stream_alert_states": rules.minute_alerts_sql(),
    "stream_log_collect": """SELECT unnest(string_split(text, chr(10))) AS value, 'documents' AS job FROM documents""",
}

# The names that earlier told the whole results from trimmed ones.
ORACLE |= {f"{name}_whole": ORACLE[name] for name in ("stream_step_values", "stream_rules", "stream_alerts")}
