"""Removing passages that an earlier document already has, by super-k-mers.

A window is ``size`` consecutive words. Its minimiser is the least code among the grams of ``gram`` words in it.
Consecutive windows of one minimiser place travel together as one packed string, the super-k-mer, to the
bucket of that minimiser; equal windows have equal minimisers and therefore meet. In a bucket, windows are sorted
by a 64-bit code, runs of one code are checked word for word on the packed strings, and each run's least doc_id
tells which of its windows are repeats. Words covered by a repeat are removed.

Skew. Super-k-mers of the same content within an input task are folded: the one of the least doc_id is sent, the
others are repeats already; so a passage that a third of all documents hold arrives once per task and flush.
Around such a passage the contexts differ and cannot be folded, so a minimiser may still be hot: minimisers are counted
first, and those with more than a bucket's worth of super-k-mers have theirs cut into single windows, which are
dealt by the code of the whole window. Super-k-mers are packed and compressed per task and bucket, so the
shuffle moves few large rows.

Defined cases: null and blank texts have no words; texts with fewer words than a window lose none; equal doc_ids
do not count as smaller, and a null doc_id neither removes nor is removed from; rows that agree in doc_id and
text get the same result; a window repeated inside one document only is kept; a very long
text is read whole, as a chunk of its own; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import scratch, texts

_BLANK = np.arange(256, dtype=np.uint8)
_BLANK[9:14] = 32
_RANGE = pa.schema([("doc_id", pa.int64()), ("text_code", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])

#: What one settled range, one more place of an entry and one row take in a task's Python.
_RANGE_BYTES, _PLACE_BYTES, _ROW_BYTES = 200, 70, 200


def _least_places(codes: np.ndarray, width: int) -> np.ndarray:
    """Place of the least code (the first of equals) in every run of ``width`` codes."""
    n = len(codes) - width + 1
    least, place = codes.copy(), np.arange(len(codes))
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        right, other = least[step:], place[step:]
        smaller = right < least[: len(right)]
        least = np.where(smaller, right, least[: len(right)])
        place = np.where(smaller, other, place[: len(right)])
        reach += step
    return place[:n]


def _super_kmers(data: np.ndarray, offsets: np.ndarray, size: int, gram: int) -> tuple:
    """Spans of the words, words before each text, and the super-k-mers: text, first window, windows, minimiser."""
    starts, ends, first = texts.spans(data, offsets)
    none = np.zeros(0, np.int64)
    if len(starts) < size:
        return starts, ends, first, none, none, none, np.zeros(0, np.uint64)
    grams = texts.window_codes(texts.word_codes(data, starts, ends), gram)
    place = _least_places(grams, size - gram + 1)
    counts = np.maximum(np.diff(first) - size + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    window = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + first[owner]
    at = place[window]
    new = np.ones(len(window), bool)
    new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
    head = np.flatnonzero(new)
    return starts, ends, first, owner[head], window[head], np.diff(np.append(head, len(window))), grams[at[head]]


def heavy_minimisers(docs: DataFrame, size: int, gram: int, share: float) -> tuple[int, list[int]]:
    """Bytes of all super-k-mers, and the minimisers of more than ``share`` of them (so at most 1 / share).

    A task reports a minimiser only above a quarter of that share of its own super-k-mers, so what the tasks
    send is bounded by 4 / share each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n, size_of = [], 0, 0
        for _, data, offsets in texts.chunks(batches, 0, 1 << 20):
            starts, ends, _, _, window, windows, least = _super_kmers(data, offsets, size, gram)
            if len(window):
                size_of += int((ends[window + windows + size - 2] - starts[window]).sum())
                found.append(least)
                n += len(least)
        codes, counts = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64),) * 2
        much = counts >= max(16, n * share / 4)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None, None, *codes[much].view(np.int64).tolist()], pa.int64()),
                pa.array([False, True, *[True] * int(much.sum())]),
                pa.array([size_of, n, *counts[much].tolist()], pa.int64()),
            ],
            ["code", "counted", "n"],
        )

    rows = docs.select(F.col("text").cast("string")).mapInArrow(run, "code long, counted boolean, n long")
    totals = scratch.keep(rows.groupBy("code", "counted").agg(F.sum("n").alias("n")), "minimisers")
    whole = {row["counted"]: row["n"] for row in totals.where("code IS NULL").collect()}
    least = max(1.0, (whole.get(True) or 0) * share)
    return whole.get(False) or 0, [r["code"] for r in totals.where(F.col("code").isNotNull() & (F.col("n") > least)).collect()]


class _Packer:
    """Super-k-mers of one task, folded by content; full ones are flushed as one packed row per bucket."""

    def __init__(self, buckets: int, flush: int):
        self.buckets, self.flush_at = buckets, flush
        self.clear()

    def clear(self) -> None:
        self.held = 0
        self.entries: dict[bytes, list] = {}  # content -> bucket, doc_id, then (text_code, first word) pairs
        self.ranges: list[tuple] = []
        self.rows: set[tuple] = set()

    def add(self, content: bytes, bucket: int, doc_id: int, text_code: int, word: int, windows: int, size: int) -> None:
        entry = self.entries.get(content)
        if entry is None:
            self.entries[content] = [bucket, windows, doc_id, text_code, word]
            self.held += len(content) + 350  # with what Python adds
        elif doc_id > entry[2]:
            self.ranges.append((doc_id, text_code, word, word + windows + size - 1))
            self.held += _RANGE_BYTES
        elif doc_id == entry[2]:
            entry += [text_code, word]
            self.held += _PLACE_BYTES
        else:
            for i in range(3, len(entry), 2):
                self.ranges.append((entry[2], entry[i], entry[i + 1], entry[i + 1] + windows + size - 1))
                self.held += _RANGE_BYTES
            self.held -= _PLACE_BYTES * (len(entry) - 5) // 2
            entry[2:] = [doc_id, text_code, word]

    def flush(self) -> Iterator[pa.RecordBatch]:
        """Rows (bucket, blob); ranges that are settled already ride along in any bucket."""
        by: dict[int, list] = {}
        for content, entry in self.entries.items():
            by.setdefault(entry[0], []).append((content, entry))
        out: list[tuple[int, bytes]] = []
        for bucket, members in by.items():
            members.sort(key=lambda member: (member[1][2], member[1][4]))  # by document and place: packs better
            text = b"\n".join(content for content, _ in members)
            heads = np.array([(windows, len(rest) // 2, doc_id) for _, (_, windows, doc_id, *rest) in members], np.int64)
            heads[1:, 2] = np.diff(heads[:, 2])
            places = np.array([x for _, entry in members for x in entry[3:]], np.int64).reshape(-1, 2)
            out.append((bucket, _pack(0, heads, places, text)))
        for start in range(0, len(self.ranges), 50_000):
            ranges = np.array(self.ranges[start : start + 50_000], np.int64)
            out.append((start // 50_000 % self.buckets, _pack(1, np.zeros((0, 3), np.int64), ranges, b"")))
        self.clear()
        for start in range(0, len(out), 64):
            some = out[start : start + 64]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in some], pa.int64()), pa.array([x for _, x in some], pa.binary())], ["bucket", "blob"]
            )


def _pack(kind: int, heads: np.ndarray, places: np.ndarray, text: bytes) -> bytes:
    """Numbers column by column and byte by byte of equal rank, then text, compressed."""
    numbers = [np.ascontiguousarray(column).view(np.uint8).reshape(-1, 8).T.tobytes() for x in (heads, places) for column in x.T]
    head = np.array([kind, len(heads), places.shape[1], len(places)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(b"".join([head, *numbers, text]))


def _unpack(blob: bytes) -> tuple[int, np.ndarray, np.ndarray, bytes]:
    raw, at = zstandard.ZstdDecompressor().decompress(blob), 32
    kind, n_heads, width, n_places = np.frombuffer(raw, np.int64, 4).tolist()

    def columns(n: int, count: int) -> np.ndarray:
        nonlocal at
        planes = np.frombuffer(raw, np.uint8, 8 * n * count, at).reshape(count, 8, n)
        at += planes.nbytes
        return np.ascontiguousarray(planes.transpose(2, 0, 1)).view(np.int64).reshape(n, count)

    heads, places = columns(n_heads, 3), columns(n_places, width)
    return kind, heads, places, raw[at:]


def _packed(docs: DataFrame, size: int, gram: int, buckets: int, hot: list[int], flush: int) -> DataFrame:
    heavy = np.sort(np.array(hot, np.int64).view(np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(buckets, flush)
        for rows, data, offsets in texts.chunks(batches, 2, 1 << 20):
            starts, ends, first, owner, window, windows, least = _super_kmers(data, offsets, size, gram)
            if len(heavy) and len(least):
                place = np.minimum(np.searchsorted(heavy, least), len(heavy) - 1)
                cut = heavy[place] == least
                if cut.any():  # single windows, dealt by the whole window
                    each = np.where(cut, windows, 1)
                    within = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                    whole = texts.window_codes(texts.word_codes(data, starts, ends), size)
                    owner, cut = np.repeat(owner, each), np.repeat(cut, each)
                    window = np.repeat(window, each) + within
                    windows = np.where(cut, 1, np.repeat(windows, each))
                    least = np.where(cut, whole[window], np.repeat(least, each))
            if not len(window):
                continue
            ids, codes = rows.column(0).to_pylist(), rows.column(1).to_pylist()
            for i, row in enumerate(zip(ids, codes, strict=True)):
                if row in packer.rows:  # the same id and text again has the same ranges
                    ids[i] = None
                else:
                    packer.rows.add(row)
                    packer.held += _ROW_BYTES
            raw, last = _BLANK[data].tobytes(), window + windows + size - 2
            # Words that are more than one blank apart must be brought to one.
            apart = np.concatenate([[0, 0], np.cumsum(starts[1:] - ends[:-1] > 1)])
            columns = (
                owner,
                starts[window],
                ends[last],
                apart[last + 1] > apart[window + 1],
                texts.mixed(least) % np.uint64(buckets),
                window - first[owner],
                windows,
            )
            for doc, low, high, wide, bucket, word, n in zip(*(c.tolist() for c in columns), strict=True):
                if ids[doc] is not None:
                    content = raw[low:high]
                    content = b" ".join(content.split()) if wide else content
                    packer.add(content, bucket, ids[doc], codes[doc], word, n, size)
            if packer.held >= flush:
                yield from packer.flush()
        yield from packer.flush()

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_code"), text.alias("text"))
    return rows.mapInArrow(run, "bucket long, blob binary")


def _repeats(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Word ranges that repeat in a smaller doc_id; batches hold the rows of one bucket."""
    entries: dict[bytes, list] = {}
    for batch in batches:
        for blob in batch.column("blob").to_pylist():
            kind, heads, numbers, text = _unpack(blob)
            if kind == 1:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in numbers.T], schema=_RANGE)
                continue
            at, flat, found = 0, numbers.ravel().tolist(), []
            columns = (heads[:, 0].tolist(), heads[:, 1].tolist(), np.cumsum(heads[:, 2]).tolist())
            for content, windows, n, doc_id in zip(text.split(b"\n"), *columns, strict=True):
                places = flat[at : at + 2 * n]
                at += 2 * n
                entry = entries.get(content)
                if entry is None:
                    entries[content] = [windows, doc_id, *places]
                    continue
                if doc_id == entry[1]:
                    entry += places
                    continue
                gone = places if doc_id > entry[1] else entry[2:]
                of = max(doc_id, entry[1])
                found += [(of, gone[i], gone[i + 1], gone[i + 1] + windows + size - 1) for i in range(0, len(gone), 2)]
                if doc_id < entry[1]:
                    entry[1:] = [doc_id, *places]
            if found:
                columns = np.array(found, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_RANGE)
    if entries:
        yield from _sorted_windows(entries, size)


def _sorted_windows(entries: dict[bytes, list], size: int) -> Iterator[pa.RecordBatch]:
    """Equal windows of different super-k-mers: sort by code, then compare the words themselves."""
    contents = list(entries)
    data = np.frombuffer(b"".join(contents), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(c) for c in contents])])
    starts, ends, first = texts.spans(data, offsets)
    counts = np.diff(first) - size + 1
    owner = np.repeat(np.arange(len(counts)), counts)
    window = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + first[owner]
    codes = texts.window_codes(texts.word_codes(data, starts, ends), size)[window]
    doc_ids = np.array([entry[1] for entry in entries.values()], np.int64)
    order = np.lexsort((doc_ids[owner], codes))
    codes, owner, window = codes[order], owner[order], window[order]
    same = np.zeros(len(codes) + 1, bool)
    same[1:-1] = codes[1:] == codes[:-1]
    runs = np.flatnonzero(~same[:-1] & same[1:])
    raw = data.tobytes()
    gone = []
    for low in runs.tolist():
        high = low + 1
        least: dict[bytes, int] = {}
        while high < len(codes) and same[high]:
            high += 1
        for i in range(low, high):  # in ascending doc_id
            at = window[i]
            words = raw[starts[at] : ends[at + size - 1]]
            doc_id = doc_ids[owner[i]]
            if least.setdefault(words, doc_id) < doc_id:
                gone.append(i)
    if not gone:
        return
    picked = np.array(gone)
    picked = picked[np.lexsort((window[picked], owner[picked]))]
    own, at = owner[picked], window[picked] - first[owner[picked]]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(own)) - 1
    values, found = list(entries.values()), []
    for o, a, b in zip(own[head].tolist(), at[head].tolist(), at[tail].tolist(), strict=True):
        entry = values[o]
        for i in range(2, len(entry), 2):
            found.append((entry[1], entry[i], entry[i + 1] + a, entry[i + 1] + b + size))
    for start in range(0, len(found), 100_000):
        columns = np.array(found[start : start + 100_000], np.int64).T
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_RANGE)


def repeated_ranges(
    docs: DataFrame, size: int = 13, gram: int = 3, bucket_bytes: int = 16 << 20, flush: int = 40 << 20
) -> DataFrame:
    """doc_id, text_code, low, high: word ranges to remove; ranges of one text may overlap.

    ``bucket_bytes``: unpacked super-k-mers of a bucket, before folding. ``flush``: bytes a task gathers
    before it packs them.
    """
    total, hot = heavy_minimisers(docs, size, gram, share=1 / 2000)
    partitions = scratch.partitions(docs.sparkSession)
    buckets = max(3 * partitions, math.ceil(total / bucket_bytes))
    blobs = _packed(docs, size, gram, buckets, hot, flush)
    dealt = blobs.groupBy("bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _repeats(batches, size)

    return dealt.applyInArrow(run, "doc_id long, text_code long, low long, high long")


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping and touching ranges of a text as one: low, high, low, high ... in ascending order."""
    for batch in batches:
        spans = []
        for ranges in batch.column(2):
            values = ranges.values
            low, high = values.field(0).to_numpy(), values.field(1).to_numpy()
            order = np.argsort(low, kind="stable")
            low, reach = low[order], np.maximum.accumulate(high[order])
            new = np.flatnonzero(np.append(True, low[1:] > reach[:-1]))
            spans.append(np.stack([low[new], reach[np.append(new[1:], len(low)) - 1]], axis=1).ravel())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(spans, pa.list_(pa.int64()))], ["doc_id", "text_code", "spans"]
        )


def _cut(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    """doc_id, n_words, n_removed, digest and, if asked for, text of (doc_id, text, spans)."""
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500)
            n_words, n_removed, kept = [], [], []
            for text, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                words = (text or "").encode().split()
                n_words.append(len(words))
                if spans:
                    edges = [0, *spans, len(words)]
                    words = [word for i in range(0, len(edges), 2) for word in words[edges[i] : edges[i + 1]]]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            columns = [
                part.column(0),
                pa.array(n_words, pa.int64()),
                pa.array(n_removed, pa.int64()),
                pa.array([hashlib.sha256(text).hexdigest() for text in kept], pa.string()),
            ]
            if with_text:
                columns.append(pa.array([text.decode() for text in kept], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])


def remove_repeats(docs: DataFrame, with_text: bool = True, **how) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept_text for every row."""
    by_text = repeated_ranges(docs, **how).groupBy("doc_id", "text_code").agg(F.collect_list(F.struct("low", "high")).alias("r"))
    by_text = scratch.keep(by_text.mapInArrow(_merged, "doc_id long, text_code long, spans array<long>"), "ranges")
    text = F.col("text").cast("string")
    own = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_code"), text.alias("text"))
    joined = own.join(by_text, ["doc_id", "text_code"], "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return joined.mapInArrow(lambda batches: _cut(batches, with_text), schema)


def report(docs: DataFrame, **how) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    return remove_repeats(docs, with_text=False, **how)
