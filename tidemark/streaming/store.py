"""A keyed table of many small writes: runs of rows per key bucket, in levels, behind a pointer.

    <path>/runs/run=NAME/bucket=B   rows of one write, by bucket of their key
    <path>/heads/batch=N            the pointer after batch N, a small file: which runs make up which bucket, and a note

A batch adds one run to the buckets it touches and nothing else. Where a bucket has ``fan`` runs of a level, these are
merged into one run of the next level, the last level into a single run; so a row is written again once per
level, a bucket without changes is never rewritten, and a bucket is read from at most ``fan * levels`` folders.
What a merge does (keep the newest row of a key, shrink old versions) is given by the caller and must not depend on
the order or number of merges.

A batch starts from the pointer before it, so a batch that failed and is run again leaves the same table. Runs
that neither of the last ``keep`` pointers names are deleted, and older pointers with them. All metadata is one
number per bucket and run; rows never pass through the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass
class Head:
    """What a table is made of after a batch."""

    batch: int = -1
    schema: str | None = None
    #: bucket -> [[run, level], ...], oldest first
    buckets: dict[int, list] = field(default_factory=dict)
    note: dict = field(default_factory=dict)

    def runs(self) -> set[str]:
        return {run for runs in self.buckets.values() for run, _ in runs}


class Store:
    """``merge(rows, last)`` reduces rows of whole keys; ``last`` tells that nothing older is left out."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: list[str],
        merge: Callable[[DataFrame, bool], DataFrame],
        buckets: int = 64,
        fan: int = 4,
        levels: int = 3,
        keep: int = 2,
    ):
        if fan < 2 or levels < 1 or keep < 2:
            raise ValueError("fan and keep must be at least 2, levels at least 1")
        self.spark, self.path, self.keys, self.merge = spark, path.rstrip("/"), keys, merge
        self.buckets, self.fan, self.levels, self.keep = buckets, fan, levels, keep

    def _folder(self, name: str):
        """A Hadoop path of the table and its file system, which may be any that Spark writes to."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, name: str, prefix: str) -> list[str]:
        path, files = self._folder(name)
        found = [status.getPath().getName() for status in files.listStatus(path)] if files.exists(path) else []
        return sorted(x.removeprefix(prefix) for x in found if x.startswith(prefix))

    def _heads(self) -> list[Head]:
        heads = []
        for batch in self._names("heads", "batch="):  # ``keep`` small files
            path, files = self._folder(f"heads/batch={batch}")
            stream = files.open(path)
            try:
                text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            head = Head(**json.loads(text))
            head.buckets = {int(bucket): runs for bucket, runs in head.buckets.items()}
            heads.append(head)
        return sorted(heads, key=lambda head: head.batch)

    def head(self, before: int | None = None) -> Head:
        """The newest pointer, or the newest one before a batch."""
        heads = [head for head in self._heads() if before is None or head.batch < before]
        return heads[-1] if heads else Head()

    def read(self, head: Head | None = None, buckets: Iterable[int] | None = None) -> DataFrame | None:
        """Rows of all runs of these buckets, not merged; None before the first write."""
        head = self.head() if head is None else head
        if head.schema is None:
            return None
        wanted = head.buckets if buckets is None else set(buckets) & set(head.buckets)
        return self._rows(head.schema, [(run, bucket) for bucket in sorted(wanted) for run, _ in head.buckets[bucket]])

    def _rows(self, schema: str, places: list[tuple[str, int]]) -> DataFrame:
        typed = StructType.fromJson(json.loads(schema))
        if not places:
            return self.spark.createDataFrame([], typed)
        folders = [f"{self.path}/runs/run={run}/bucket={bucket}" for run, bucket in places]
        rows = self.spark.read.schema(typed).option("basePath", f"{self.path}/runs").parquet(*folders)
        return rows.select(*typed.names)

    def with_bucket(self, rows: DataFrame, name: str = "bucket") -> DataFrame:
        return rows.withColumn(name, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets of the keys of some rows."""
        return [row["bucket"] for row in self.with_bucket(rows.select(*self.keys)).select("bucket").distinct().collect()]

    def _write(self, rows: DataFrame, run: str) -> list[int]:
        """Write one run; adaptive execution cuts a large bucket into several files and leaves a small one whole."""
        out = self.with_bucket(rows).hint("rebalance", "bucket").sortWithinPartitions("bucket", *self.keys)
        out.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/runs/run={run}")
        return sorted(int(bucket) for bucket in self._names(f"runs/run={run}", "bucket="))

    def commit(self, batch_id: int, rows: DataFrame, note: Callable[[list[int]], dict] | dict | None = None) -> Head:
        """Add the rows of a batch, merge what is due, move the pointer, and drop what no pointer needs.

        ``note`` is kept with the pointer; a function of the buckets written gives one that depends on them.
        A batch that the table holds already changes nothing.
        """
        now = self.head()
        if batch_id <= now.batch:
            return now
        head = Head(batch_id, rows.schema.json(), {b: [list(r) for r in runs] for b, runs in now.buckets.items()})
        written = self._write(rows, f"{batch_id}-0")
        head.note = note(written) if callable(note) else note or {}
        for bucket in written:
            head.buckets.setdefault(bucket, []).append([f"{batch_id}-0", 0])
        for level in range(self.levels):
            self._merged(head, level)
        self._point(head)
        self._expire()
        return head

    def replace(self, batch_id: int, rows: DataFrame, buckets: Iterable[int]) -> Head:
        """Put these rows in the place of all rows of the given buckets; other buckets stay as they are."""
        now = self.head()
        if batch_id <= now.batch:
            return now
        gone = set(buckets)
        kept = {b: runs for b, runs in now.buckets.items() if b not in gone}
        name = f"{batch_id}-0"
        kept |= {b: [[name, 0]] for b in self._write(rows, name)}
        head = Head(batch_id, rows.schema.json(), kept)
        self._point(head)
        self._expire()
        return head

    def _merged(self, head: Head, level: int) -> None:
        """Merge this level of the buckets that have ``fan`` runs of it (of the last level: more than one)."""
        last = level == self.levels - 1
        most = 2 if last else self.fan
        due = {b: [run for run, at in runs if at == level] for b, runs in head.buckets.items()}
        due = {b: runs for b, runs in due.items() if len(runs) >= most}
        if not due:
            return
        target = level if last else level + 1
        run = f"{head.batch}-{level + 1}"
        # Only where no other run is left is a merge the whole history of its keys.
        alone = {b for b, runs in due.items() if len(runs) == len(head.buckets[b])}
        for whole, members in ((True, alone), (False, set(due) - alone)):
            some = {b: due[b] for b in members}
            if not some:
                continue
            name = f"{run}{'w' if whole else ''}"
            rows = self._rows(head.schema, [(r, b) for b, runs in some.items() for r in runs])
            left = set(self._write(self.merge(rows, whole), name))
            for bucket, gone in some.items():
                runs = [entry for entry in head.buckets[bucket] if entry[0] not in gone]
                if bucket in left:
                    runs.append([name, target])
                if runs:
                    head.buckets[bucket] = runs
                else:
                    del head.buckets[bucket]

    def _point(self, head: Head) -> None:
        """The pointer appears by a rename, so it is there as a whole or not at all."""
        text = json.dumps({"batch": head.batch, "schema": head.schema, "buckets": head.buckets, "note": head.note})
        making, files = self._folder(f"heads/making-{head.batch}")
        out = files.create(making, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        path, _ = self._folder(f"heads/batch={head.batch}")
        if not files.rename(making, path):
            raise OSError(f"no pointer for batch {head.batch} at {self.path}")

    def _expire(self) -> None:
        heads = self._heads()
        named = set().union(*[head.runs() for head in heads[-self.keep :]])
        for old in heads[: -self.keep]:
            path, files = self._folder(f"heads/batch={old.batch}")
            files.delete(path, False)
        for run in self.folders():
            # A run of a later batch may be in the making; what is older and not named is not needed again.
            if run not in named and int(run.split("-")[0]) <= heads[-1].batch:
                path, files = self._folder(f"runs/run={run}")
                files.delete(path, True)

    def folders(self) -> list[str]:
        """The runs that are stored."""
        return self._names("runs", "run=")
