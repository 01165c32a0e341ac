"""Texts as flat numpy arrays: buffers of an Arrow batch, words, hashes of slices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# a task works on about so many bytes of text at a time; one text is never cut
CHUNK_BYTES = 1 << 20

WHITE_BYTE = np.zeros(256, dtype=bool)
WHITE_BYTE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_BYTE_VALUE = np.random.default_rng(20_240_601).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def chunks(batch: pa.RecordBatch, column: str) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) for runs of rows: row k of the run is bytes[offsets[k]:offsets[k + 1]].

    A null is an empty text. A run holds CHUNK_BYTES at most, or one longer text.
    """
    texts = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    start = 0
    while start < len(texts):
        end = int(np.searchsorted(offsets, offsets[start] + CHUNK_BYTES, side="right")) - 1
        end = min(max(end, start + 1), len(texts))
        yield slice(start, end), data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start]
        start = end


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base ** 0 ... base ** (n - 1), modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size > CHUNK_BYTES + 1:
            return have[:n]
        _powers[base] = have
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Each bit of the result depends on all bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class SliceHash:
    """64-bit hashes of any slices of one byte array, from one prefix sum."""

    def __init__(self, data: np.ndarray) -> None:
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUE[data] * powers(len(data)), out=self.sums[1:])
        self.back = powers(len(data) + 1, _BASE_INVERSE)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        length = (ends - starts).astype(np.uint64)
        return mixed((self.sums[ends] - self.sums[starts]) * self.back[starts] + length)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): words are runs without ASCII white space inside one text.

    Text k has the words first[k]:first[k + 1].
    """
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    white = WHITE_BYTE[data]
    inside = ~white
    before = np.empty(len(data), dtype=bool)
    before[:1] = True
    before[1:] = white[:-1]
    starts = np.flatnonzero(inside & (before | edge[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1:] = True
    after[:-1] = white[1:]
    ends = np.flatnonzero(inside & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of `size` consecutive words inside one text, and the number of each one's first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(text[:n] == text[size - 1 :])
    return mixed(total[at]), at


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[starts[0]:starts[0] + lengths[0]], flat[starts[1]:...], ... in one array."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    index = np.arange(total, dtype=np.int64)
    index += np.repeat(starts - (ends - lengths), lengths)
    return flat[index]
