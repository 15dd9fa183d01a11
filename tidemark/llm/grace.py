"""Exact deduplication by a Grace hash table.

Records are dealt to buckets by a hash of their content; each bucket is one task, whose open-addressing
table compares complete contents. A table that has reached its byte budget takes no new content: records
of contents it does not hold are spilled to a shared table and dealt again by the next hash function,
until nothing is spilled. A content is either held from its first record on or spilled with all of its
records, so a group is never torn apart. Copies within one input task are folded before the shuffle by
the same table, so the records of a hot group arrive as one per task and flush.

Groups are handed back under the SHA-256 of the content; two different contents with one digest would
fail the job instead of being merged.

Defined cases: a null text counts as empty; a null doc_id is smaller than any other; of rows that agree
in doc_id and text one stays; one text of any length is held even if it exceeds the budget alone; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import scratch

_RECORD = "sha binary, content binary, keep long, n long"
_ARROW = pa.schema([("sha", pa.binary()), ("content", pa.binary()), ("keep", pa.int64()), ("n", pa.int64())])


class OpenTable:
    """Open addressing with linear probing; equality is equality of the whole content."""

    def __init__(self, budget: int):
        self.budget, self.held = budget, 0
        self.slots = [-1] * 1024
        self.digests: list[bytes] = []
        self.contents: list[bytes] = []
        self.keep: list[int | None] = []
        self.n: list[int] = []

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for entry, digest in enumerate(self.digests):
            at = int.from_bytes(digest[:8], "little") & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry

    def add(self, digest: bytes, content: bytes, keep: int | None, n: int) -> bool:
        """False if the content is new and the budget is used up."""
        mask = len(self.slots) - 1
        at = int.from_bytes(digest[:8], "little") & mask
        while (entry := self.slots[at]) >= 0:
            if self.digests[entry] == digest:
                if self.contents[entry] != content:
                    raise ValueError("two different contents have one SHA-256")
                if self.keep[entry] is None or (keep is not None and keep > self.keep[entry]):
                    self.keep[entry] = keep
                self.n[entry] += n
                return True
            at = (at + 1) & mask
        if self.held and self.held + len(content) > self.budget:
            return False
        self.slots[at] = len(self.digests)
        self.digests.append(digest)
        self.contents.append(content)
        self.keep.append(keep)
        self.n.append(n)
        self.held += len(content)
        if 5 * len(self.digests) > 3 * len(self.slots):
            self._grow()
        return True


def _batches(digests: list, contents: list, keeps: list, counts: list, most: int) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``most`` content bytes, or one record."""
    start, size = 0, 0
    for i, content in enumerate(contents):
        size += len(content or b"") + 64
        if size >= most or i == len(contents) - 1:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(column[start : i + 1], field.type)
                    for column, field in zip((digests, contents, keeps, counts), _ARROW, strict=True)
                ],
                schema=_ARROW,
            )
            start, size = i + 1, 0


def _folded(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    """Copies within a task become one record; a full table is sent on and begun anew."""
    table = OpenTable(budget)
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            content = text.as_buffer().to_pybytes() if text.is_valid else b""
            digest = hashlib.sha256(content).digest()
            if not table.add(digest, content, doc_id, 1):
                yield from _batches(table.digests, table.contents, table.keep, table.n, 8 << 20)
                table = OpenTable(budget)
                table.add(digest, content, doc_id, 1)
    yield from _batches(table.digests, table.contents, table.keep, table.n, 8 << 20)


def _bucket(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    """Groups of the bucket, without content; records that did not fit, with it."""
    table = OpenTable(budget)
    for batch in batches:
        spilled: tuple[list, list, list, list] = ([], [], [], [])
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if not table.add(*row):
                for column, value in zip(spilled, row, strict=True):
                    column.append(value)
        yield from _batches(*spilled, 8 << 20)
    yield from _batches(table.digests, [None] * len(table.n), table.keep, table.n, 8 << 20)


def content_groups(
    records: DataFrame, content_bytes: int, id_column: str = "doc_id", text_column: str = "text", budget: int = 64 << 20
) -> DataFrame:
    """One row per distinct content: sha, keep (largest id), n.

    ``content_bytes``: the size of all contents, for the first fan-out. ``budget``: bytes of content that
    one table holds.
    """
    least = scratch.partitions(records.sparkSession)
    fold_budget = min(budget, 32 << 20)
    waiting = records.select(F.col(id_column).cast("long"), F.col(text_column).cast("string")).mapInArrow(
        lambda batches: _folded(batches, fold_budget), _RECORD
    )
    settled, level, expected = None, 0, content_bytes
    while True:
        fanout = max(least, math.ceil(expected / budget))
        dealt = waiting.repartition(fanout, F.xxhash64(F.lit(level), "sha"))
        out = scratch.keep(dealt.mapInArrow(lambda batches: _bucket(batches, budget), _RECORD), f"bucket{level}")
        groups = out.where("content IS NULL").select("sha", "keep", "n")
        settled = groups if settled is None else settled.unionByName(groups)
        waiting = out.where("content IS NOT NULL")
        expected = waiting.agg(F.sum(F.octet_length("content"))).first()[0]
        if expected is None:
            return settled
        level += 1


def dedup(docs: DataFrame, budget: int = 64 << 20) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    members = scratch.keep(
        docs.select(
            F.col("doc_id").cast("long"), F.sha2(text, 256).alias("text_sha256"), F.octet_length(text).alias("bytes")
        ),
        "members",
    )
    content_bytes = members.agg(F.sum("bytes")).first()[0] or 0
    groups = content_groups(docs, content_bytes, budget=budget).select(
        F.lower(F.hex("sha")).alias("text_sha256"), F.col("keep").alias("keep_id"), F.col("n").alias("group_size")
    )
    # Rows that agree in id and text are one row here, so that exactly one of them stays.
    rows = members.groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("copies"))
    return (
        rows.join(groups, "text_sha256")
        .select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
            "text_sha256",
        )
    )
