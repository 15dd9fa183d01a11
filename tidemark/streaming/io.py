"""Starting streams, watermarks and replay-safe sinks."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import session

# How late a row may be, for the three kinds of streams.
TABLE_DELAY = "10 seconds"
JOB_DELAY = "5 seconds"
SAMPLE_DELAY = "10 minutes"
TRIGGER = "10 seconds"

BatchAction = Callable[[DataFrame, int], None]


def watermarked(stream: DataFrame, column: str = "event_time", delay: str = JOB_DELAY) -> DataFrame:
    return stream.withWatermark(column, delay)


def _triggered(writer, continuous: bool):
    return writer.trigger(processingTime=TRIGGER) if continuous else writer.trigger(availableNow=True)


def start_batches(
    stream: DataFrame, action: BatchAction, checkpoint: str, continuous: bool = False, reused: bool = False
) -> StreamingQuery:
    """Run ``action(batch, batch_id)`` per micro-batch, all available data or every 10 s.

    ``reused`` batches are kept while the action runs, since it reads them several times.

    Streams plan without AQE; inside a batch action the joins and aggregations
    are ordinary ones, so it is switched on again there.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        session.configure(batch.sparkSession)
        if not reused:
            action(batch, batch_id)
            return
        batch.persist()
        try:
            action(batch, batch_id)
        finally:
            batch.unpersist()

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    return _triggered(writer, continuous).start()


def start_files(
    stream: DataFrame, path: str, checkpoint: str, continuous: bool = False, fmt: str = "parquet"
) -> StreamingQuery:
    writer = stream.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
    return _triggered(writer, continuous).start(path)


def start_topic(
    messages: DataFrame, options: Mapping[str, str], checkpoint: str, continuous: bool = True
) -> StreamingQuery:
    """Send ``value`` (and ``key``) to the topic named in ``options``."""
    writer = messages.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint)
    return _triggered(writer, continuous).start()


def start_console(rows: DataFrame, checkpoint: str, continuous: bool = False) -> StreamingQuery:
    writer = rows.writeStream.format("console").option("checkpointLocation", checkpoint)
    return _triggered(writer, continuous).start()


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write the rows of one batch; running the batch again replaces them."""
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def drop_batch(spark: SparkSession, path: str, batch_id: int) -> None:
    """Delete the folder of one batch that no later batch reads."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch={batch_id}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(folder):
        files.delete(folder, True)


def kept_batches(spark: SparkSession, path: str) -> list[int]:
    """The batches that have a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]
    return sorted(int(name.removeprefix("batch=")) for name in names if name.startswith("batch="))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch")


class LateSplit:
    """Rows of a stream in two outputs, by the watermark before their batch: what a stateful operator would refuse, and the rest.

    Spark drops late rows without a trace; here ``<path>/in_time`` goes on to the operator, ``<path>/late`` is kept, and
    ``<path>/counts`` has one row per batch with both numbers and the watermark after it. The watermark is the newest time
    of all batches so far, less the delay; a row at it or before it is late, one without a time never is.
    """

    def __init__(self, path: str, column: str, delay: str = JOB_DELAY):
        self.path, self.column, self.delay = path, column, delay

    def add_batch(self, batch: DataFrame, batch_id: int) -> None:
        spark, at = batch.sparkSession, F.col(self.column).cast("timestamp")
        before = None
        if batch_id > 0:
            before = spark.read.parquet(f"{self.path}/counts/batch={batch_id - 1}").first()["watermark"]
        late = F.lit(False) if before is None else F.coalesce(at <= F.lit(before), F.lit(False))
        write_batch(batch.filter(~late), f"{self.path}/in_time", batch_id)
        write_batch(batch.filter(late), f"{self.path}/late", batch_id)
        now = F.max(at) - F.expr(f"interval {self.delay}")
        counts = batch.agg(
            F.count_if(~late).alias("n_in_time"),
            F.count_if(late).alias("n_late"),
            F.greatest(now, F.lit(before).cast("timestamp")).alias("watermark"),
        )
        write_batch(counts, f"{self.path}/counts", batch_id)

    def start(self, stream: DataFrame, checkpoint: str, continuous: bool = False) -> StreamingQuery:
        return start_batches(stream, self.add_batch, checkpoint, continuous, reused=True)

    def rows(self, spark: SparkSession) -> DataFrame:
        """Both outputs, with a column ``late``."""
        in_time = read_batches(spark, f"{self.path}/in_time").withColumn("late", F.lit(False))
        return in_time.unionByName(read_batches(spark, f"{self.path}/late").withColumn("late", F.lit(True)))


def finish(query: StreamingQuery) -> None:
    """Wait until an available-now query has ended; its failure is raised here."""
    query.awaitTermination()


def drop_copies(
    stream: DataFrame, keys: list[str], salt_by: list[str] | None = None, salts: int = 32
) -> DataFrame:
    """Keep one row per key within the watermark delay.

    Where a key may have very many copies, name columns in which they differ (such as
    partition and offset): copies are then first thinned in ``salts`` separate
    groups, so that the key does not pass through one task. This keeps every
    key twice in state and is not done by default.
    """
    if salt_by:
        salted = stream.withColumn("__salt", F.pmod(F.xxhash64(*salt_by), F.lit(salts)))
        stream = salted.dropDuplicatesWithinWatermark([*keys, "__salt"]).drop("__salt")
    return stream.dropDuplicatesWithinWatermark(keys)
