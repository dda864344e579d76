"""Whole texts as byte arrays: slices of Arrow batches, word spans, span hashes.

The operators work on the UTF-8 bytes of many texts at once with numpy. A slice
holds whole texts only, so memory follows ``SLICE_BYTES`` or the longest text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21

_BYTE = np.arange(256)
LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` over lower-cased text: digits, a-z and everything beyond ASCII.
WORD = ((_BYTE >= 0x30) & (_BYTE <= 0x39)) | ((_BYTE >= 0x61) & (_BYTE <= 0x7A)) | (_BYTE >= 0x80)
#: ``[^\x20\x09-\x0D]+``
NONSPACE = ~((_BYTE == 0x20) | ((_BYTE >= 0x09) & (_BYTE <= 0x0D)))

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@dataclass
class Slice:
    """Some rows of a batch: ``offsets`` has one more entry than there are texts."""

    batch: pa.RecordBatch
    offsets: np.ndarray
    data: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def column(self, name: str) -> pa.Array:
        return self.batch.column(name)


def give_back() -> None:
    """Hands the system what this process has freed: a worker outlives its task, and what it keeps adds to the next stage."""
    _powers.cache_clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def given_back(result: pa.Table) -> pa.Table:
    """What a function returns, once all else it had is given back: for those that get groups."""
    give_back()
    return result


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Whole rows of each batch, up to ``limit`` text bytes together. A null text has no bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(text).cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
        buffer = values.buffers()[2]
        data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.empty(0, np.uint8)
        low = 0
        while low < len(values):
            high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
            high = min(max(high, low + 1), len(values))
            yield Slice(
                batch.slice(low, high - low), offsets[low : high + 1] - offsets[low], data[offsets[low] : offsets[high]]
            )
            low = high
    give_back()


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts, and each text's first word (one entry more than texts)."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    within = inside[data]
    edges = np.unique(offsets[:-1][np.diff(offsets) > 0])
    starts = within.copy()
    starts[1:] &= ~within[:-1]
    starts[edges] = within[edges]
    ends = within.copy()
    ends[:-1] &= ~within[1:]
    last = np.append(edges[1:], len(data)) - 1
    ends[last] = within[last]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _ODD), np.full(n, _ODD_INVERSE)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(n, 1).bit_length())


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial in the bytes, modulo 2**64; one entry more than bytes."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[0][: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Equal for equal byte strings, wherever they stand."""
    return mix((prefix[end] - prefix[start]) * powers(len(prefix))[1][start] + (end - start).astype(np.uint64))


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All integers of the ranges [start, start + count), one range after the other."""
    total = int(count.sum())
    if not total:
        return np.empty(0, np.int64)
    first = np.cumsum(count) - count
    return np.repeat(start - first, count) + np.arange(total)
