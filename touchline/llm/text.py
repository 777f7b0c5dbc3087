"""Words, hashes and n-gram codes of whole Arrow text columns, computed on their UTF-8 bytes.

Everything here runs inside a task on one Arrow batch. Batches are walked in slices of whole texts
of about ``SLICE`` bytes, so the memory needed is a fixed multiple of that, or of the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 19
#: Bytes of text that Spark hands to a Python worker at once; a longer text comes alone.
BATCH = 8 << 20

_BYTES = np.arange(256)
#: A-Z to a-z, every other byte as it is.
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
#: Words between white space: [^\x20\x09-\x0D]+
SPACED = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
#: Words of ASCII digits, ASCII letters and everything beyond ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
PLAIN = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)

_BASE = 0x9E3779B97F4A7C13  # 3 modulo 8, so 1 - BASE has a single factor of two
_INVERSE = pow(_BASE, -1, 1 << 64)
_SYMBOL = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)


def bounded_batches(spark, size: int = BATCH) -> None:
    """Let no Arrow batch be larger than ``size`` bytes, also where a session allows more.

    Rows alone do not bound a batch: ten thousand long texts would not fit a worker.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, None)
    if now is None or not now.rstrip("bB").isdigit() or int(now.rstrip("bB")) > size:
        spark.conf.set(key, str(size))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers_of(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@lru_cache(maxsize=1)
def _kept_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers_of(_BASE, SLICE), _powers_of(_INVERSE, SLICE)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and its inverse; only what an ordinary slice needs is kept."""
    return _kept_powers() if n <= SLICE else (_powers_of(_BASE, n), _powers_of(_INVERSE, n))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the bounds of its texts in them; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), bounds


def slices(bounds: np.ndarray, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts with about ``size`` bytes each; a longer text is a range by itself."""
    first, count = 0, len(bounds) - 1
    while first < count:
        last = int(np.searchsorted(bounds, bounds[first] + size, side="right")) - 1
        last = min(max(last, first + 1), count)
        yield first, last
        first = last


@dataclass
class Words:
    """The words of a run of texts; ``first[i]`` to ``first[i + 1]`` are those of text i."""

    low: np.ndarray  # lower-cased bytes of the run
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def bytes_of(self, word: int) -> bytes:
        return self.low[self.start[word]:self.end[word]].tobytes()


def scan(raw: np.ndarray, bounds: np.ndarray, is_word: np.ndarray) -> Words:
    """Lower-case A-Z and find the words of the texts that ``bounds`` cut from ``raw``."""
    cut = (bounds - bounds[0]).astype(np.int64)
    low = LOWER[raw[bounds[0]:bounds[-1]]]
    n = len(low)
    inside = is_word[low]
    edge = np.zeros(n + 1, bool)
    edge[cut] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    if len(start):
        power, inverse = _powers(n)
        symbol = np.where(is_word, _SYMBOL, np.uint64(0))
        value = symbol[low]
        value *= power[:n]
        total = np.add.reduceat(value, start) * inverse[start]
        hashed = mix(total + (end - start).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))
    else:
        hashed = np.empty(0, np.uint64)
    return Words(low, start, end, hashed, np.searchsorted(start, cut))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive words; entry i begins at word i."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(_BASE) + hashes[k:k + n]
    return mix(out + np.uint64(size))

