"""What an alert stream shows when its last batch leaves nothing open."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.alerts import AlertRule
from tidemark.streaming import io, jobs

START = datetime(2024, 1, 1)
RULE = AlertRule("Low", "m", "<", 5.0, for_seconds=60, severity="warning")
SCHEMA = "metric string, labels map<string,string>, value double, eval_ts timestamp"


def _watched(spark, base, values):
    """One batch per list of values, a minute a value."""
    minute = 0
    for number, batch in enumerate(values):
        rows = []
        for value in batch:
            rows.append(("m", {"x": "a"}, value, START + timedelta(minutes=minute)))
            minute += 1
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{base}/in")
        io.finish(jobs.watch(stream, RULE, f"{base}/alerts", f"{base}/cp", 60, 60))
    found = jobs.watched(spark, f"{base}/alerts").select("state", "steps", F.col("ends_at").isNotNull())
    return sorted(tuple(row) for row in found.collect())


@pytest.mark.parametrize(
    "values, want",
    [
        ([[1.0, 1.0, 1.0], [9.0, 9.0, 9.0]], [("resolved", 3, True)]),  # nothing is open after the last batch
        ([[1.0, 1.0, 1.0], [1.0, 9.0, 9.0]], [("resolved", 4, True)]),
        ([[9.0, 9.0], [1.0, 1.0, 1.0]], [("firing", 3, False)]),
    ],
)
def test_runs_of_an_earlier_batch_are_not_open_in_the_end(spark, tmp_path, values, want):
    assert _watched(spark, str(tmp_path), values) == want
