"""As-of join of two streams: probes wait until no earlier version can come, versions shrink behind the watermark.

The watermark is the lesser of the newest times of the two streams, less the delay. A probe is answered once the
watermark has reached its time, whichever stream its version comes in by then, early or late. Versions up to the
watermark shrink to one per key, the one that is still valid; the state is the waiting probes, one version per key
and the versions after the watermark. A batch reads the versions of the buckets of its answered probes only; a hot
key is cut along time by the batch join itself (``asof``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import asof
from tidemark.streaming.io import start_batches, write_batch
from tidemark.streaming.store import Store

_AT = "__at"


class VersionedJoin:
    """The join and its state at ``path``: ``out`` (answers), ``late`` (rows behind the watermark), two stores."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: list[str],
        probe_time: str,
        version_time: str,
        delay_seconds: int,
        how: str = "left",
        tie_order: str | None = None,
        closed_by: Callable[[], Column] | None = None,
        buckets: int = 64,
    ):
        self.spark, self.path, self.keys = spark, path, keys
        self.probe_time, self.version_time = probe_time, version_time
        self.delay, self.how, self.tie_order, self.closed_by = delay_seconds * 1_000_000, how, tie_order, closed_by
        self.until: int | None = None  # the watermark that merges of the running batch go by
        self.waiting = Store(spark, f"{path}/waiting", keys, self._still_waiting, buckets)
        self.known = Store(spark, f"{path}/known", keys, self._shrunk, buckets)

    def _passed(self, column: str, until: int | None) -> Column:
        return F.lit(False) if until is None else F.unix_micros(F.col(column).cast("timestamp")) <= until

    def _still_waiting(self, probes: DataFrame, last: bool) -> DataFrame:
        return probes.filter(~self._passed(self.probe_time, self.until))

    def _shrunk(self, versions: DataFrame, last: bool) -> DataFrame:
        passed = self._passed(self.version_time, self.until)
        rest = [name for name in versions.columns if name not in self.keys]
        order = F.struct(self.version_time, *([self.tie_order] if self.tie_order else []))
        carried = versions.filter(passed).groupBy(*self.keys).agg(F.max_by(F.struct(*rest), order).alias("row"))
        return carried.select(*self.keys, "row.*").select(*versions.columns).unionByName(versions.filter(~passed))

    def _joined(self, probes: DataFrame, versions: DataFrame) -> DataFrame:
        return asof.asof_join(
            probes, versions, self.keys, self.probe_time, self.version_time, self.how,
            tie_order=F.col(self.tie_order) if self.tie_order else None,
            closed_by=self.closed_by() if self.closed_by else None,
        )

    def tagged(self, probes: DataFrame, versions: DataFrame) -> DataFrame:
        """Both streams as one, so that one batch takes from both."""
        probe, version = (F.struct(*[F.col(c) for c in rows.columns]) for rows in (probes, versions))
        no_probe = F.lit(None).cast(probes.schema.simpleString())
        no_version = F.lit(None).cast(versions.schema.simpleString())
        return probes.select(probe.alias("probe"), no_version.alias("version")).unionByName(
            versions.select(no_probe.alias("probe"), version.alias("version"))
        )

    def add_batch(self, batch: DataFrame, batch_id: int) -> None:
        probes = batch.filter("probe IS NOT NULL").select("probe.*")
        versions = batch.filter("version IS NOT NULL").select("version.*").dropna(subset=[*self.keys, self.version_time])
        waiting, known = self.waiting.head(batch_id), self.known.head(batch_id)
        note = waiting.note
        newest = [
            F.max(F.unix_micros(F.col(f"{side}.{name}").cast("timestamp")))
            for side, name in (("probe", self.probe_time), ("version", self.version_time))
        ]
        seen = [max((x for x in pair if x is not None), default=None) for pair in zip(note.get("seen", [None] * 2), batch.agg(*newest).first(), strict=True)]
        before = note.get("watermark")
        now = before if None in seen else max(min(seen) - self.delay, min(seen) - self.delay if before is None else before)
        self.until = now

        at, late = F.col(self.probe_time), self._passed(self.probe_time, before)
        untimed = at.isNull()  # has no version at any time
        passed = untimed | self._passed(self.probe_time, now)
        in_time = probes.filter(untimed | ~late)
        stored = self.waiting.read(waiting)
        ready = in_time.filter(passed)
        if stored is not None:
            ready = ready.unionByName(stored.filter(~late & passed))
        ready = ready.persist()
        try:
            history = versions
            if known.schema is not None:
                history = history.unionByName(self.known.read(known, self.known.touched(ready)))
            write_batch(self._joined(ready, history), f"{self.path}/out", batch_id)
        finally:
            ready.unpersist()
        behind = self._passed(self.version_time, before)
        refused = probes.filter(~untimed & late).select(F.lit("probe").alias("side"), F.to_json(F.struct("*")).alias("row"))
        noted = versions.filter(behind).select(F.lit("version").alias("side"), F.to_json(F.struct("*")).alias("row"))
        write_batch(refused.unionByName(noted), f"{self.path}/late", batch_id)
        self.known.commit(batch_id, versions)
        # The pointer of the waiting probes carries the watermark and moves last.
        self.waiting.commit(batch_id, in_time.filter(~passed), {"seen": seen, "watermark": now})

    def start(self, probes: DataFrame, versions: DataFrame, checkpoint: str, continuous: bool = False) -> StreamingQuery:
        return start_batches(self.tagged(probes, versions), self.add_batch, checkpoint, continuous, reused=True)

    def remainder(self) -> DataFrame | None:
        """Answers to the probes that still wait when bounded streams have ended."""
        head = self.waiting.head()
        if head.schema is None:
            return None
        probes = self.waiting.read(head).filter(~self._passed(self.probe_time, head.note["watermark"]))
        return self._joined(probes, self.known.read())

    def answers(self) -> DataFrame:
        """All answers of bounded streams that have ended."""
        out = self.spark.read.parquet(f"{self.path}/out").drop("batch")
        return out.unionByName(self.remainder())
