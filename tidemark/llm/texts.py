"""Texts of an Arrow batch as byte arrays, and words as spans and codes in them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[_SPACE] = 0
_BASE = 0x9E3779B97F4A7C15 | 5


def mixed(codes: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit codes that spreads every bit."""
    codes = (codes ^ (codes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    codes = (codes ^ (codes >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return codes ^ (codes >> np.uint64(31))


def chunks(batches: Iterator[pa.RecordBatch], column: int, most: int = 2 << 20) -> Iterator[tuple]:
    """(rows, bytes, offsets) with at most ``most`` bytes of text, or one row; null counts as empty."""
    for batch in batches:
        texts = pc.fill_null(batch.column(column), "").cast(pa.large_binary())
        if not len(texts):
            continue
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        start = 0
        while start < len(texts):
            end = int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1
            end = min(max(end, start + 1), len(texts))
            low, high = offsets[start], offsets[end]
            yield batch.slice(start, end - start), data[low:high], offsets[start : end + 1] - low
            start = end


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the number of words before each text (one entry more)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    head, tail = inside.copy(), inside.copy()
    head[1:] &= ~inside[:-1]
    tail[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    head[edges] = inside[edges]
    tail[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(head)
    return starts, np.flatnonzero(tail) + 1, np.searchsorted(starts, offsets)


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit code per word, from its bytes alone."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, lengths)
    powers = np.full(int(lengths.max()), _BASE, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    codes = np.add.reduceat(_BYTE[data[starts[0] :]] * powers[place], starts - starts[0])
    return mixed(codes + (ends - starts).astype(np.uint64))


def window_codes(codes: np.ndarray, size: int) -> np.ndarray:
    """A code per ``size`` consecutive words; the last size - 1 places have none."""
    n = max(0, len(codes) - size + 1)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + codes[i : i + n]
    return mixed(out)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Per text the sorted distinct codes of its shingles."""
    data = LOWER[data]
    starts, ends, first = spans(data, offsets)
    codes = word_codes(data, starts, ends)
    windows = window_codes(codes, size)
    out = []
    for low, high in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if high - low >= size:
            out.append(np.unique(windows[low : high - size + 1]))
        elif high > low:
            out.append(window_codes(codes[low:high] + np.uint64(high - low), high - low))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
