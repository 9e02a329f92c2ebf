"""Texts of an Arrow batch as one run of bytes, and the words in it, with numpy."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at a time. A longer text is a piece of its own.
CHUNK_BYTES = 1 << 18

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1 << 63, size=256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: True for the bytes that part words.
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[list(range(0x30, 0x3A)) + list(range(0x61, 0x7B)) + list(range(0x41, 0x5B))] = False
NOT_ALNUM[128:] = False


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, one after the other, and where each begins; null is empty."""
    arr = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    off = np.frombuffer(arr.buffers()[1], np.int64, len(arr) + 1, arr.offset * 8) if len(arr) else np.zeros(1, np.int64)
    body = arr.buffers()[2]
    data = np.frombuffer(body, np.uint8)[off[0] : off[-1]] if body is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return data, off - off[0]


def give_back() -> None:
    """Hands freed memory back to the machine: a worker waits for its next task with what it holds."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # only some C libraries can
        ctypes.CDLL(None).malloc_trim(0)


def pieces(batches: Iterable[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the texts of each hold at most ``limit`` bytes, or one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text).cast(pa.large_binary())), 0)
        ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
        row = 0
        while row < batch.num_rows:
            before = ends[row - 1] if row else 0
            stop = max(row + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(row, stop - row)
            row = stop
    give_back()


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for at, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[at] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers evenly; distinct numbers stay distinct."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes; equal bytes give equal hashes."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))


def window_hash(data: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of each ``size`` consecutive bytes."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * down[: len(data) - size + 1])


def previous(codes: np.ndarray, off: np.ndarray, blank: int) -> np.ndarray:
    """The code before each place, ``blank`` at the first place of each text."""
    out = np.concatenate(([blank], codes[:-1]))
    out[off[:-1][np.diff(off) > 0]] = blank
    return out


class Words:
    """The words of a run of texts: spans of bytes, a hash each, and where each text's words begin."""

    def __init__(self, data: np.ndarray, off: np.ndarray, parting: np.ndarray) -> None:
        inside = ~parting[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[off] = True
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        self.starts = np.flatnonzero(inside & (edge[:-1] | ~before))
        self.ends = np.flatnonzero(inside & (edge[1:] | ~after)) + 1
        self.off = np.searchsorted(self.starts, off)
        self.hash = span_hash(LOWER[data], self.starts, self.ends)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.off)


def run_hash(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each ``k`` consecutive hashes; the last ``k - 1`` places are missing."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total *= _BASE
        total += hashes[j : j + n]
    return mix(total + np.uint64(k))
