"""Words and shingles of Arrow text columns as 64-bit hashes, with numpy.

Everything works on the bytes of a batch at once.  A word's hash depends on its
bytes only (A to Z taken as a to z), so it is the same in every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

GOLDEN = 0x9E3779B97F4A7C15
BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes hashed at once: bounds memory for texts of any length.
BLOCK = 1 << 20
#: Bytes of text of one chunk of documents.
CHUNK = 1 << 21
SHINGLE = 5


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed shuffle of 64-bit numbers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def numbers(n: int, seed: int = 0) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * np.uint64(GOLDEN))


BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
_CODES = numbers(256, 1)
_CODES[ord("A") : ord("Z") + 1] = _CODES[ord("a") : ord("z") + 1]
_ORDER = numbers(SHINGLE, 2) | np.uint64(1)
_powers = {base: np.ones(1, np.uint64) for base in (BASE, INVERSE)}


def _power(base: int, n: int) -> np.ndarray:
    if len(_powers[base]) < n:
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and where each row begins; NULL is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    bytes_ = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return bytes_, offsets - offsets[0]


def chunks(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``size`` bytes; a longer text is alone."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, min(end, rows)
        row = end


def word_spans(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end and row of every word."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~blank[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
            at, to = starts[i], ends[j - 1]
            n = int(to - at)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_CODES[data[at:to]] * _power(INVERSE, n), out=sums[1:])
            s, e = starts[i:j] - at, ends[i:j] - at
            out[i:j] = mix((sums[e] - sums[s]) * _power(BASE, n)[s] + (e - s).astype(np.uint64) * np.uint64(GOLDEN))
            i = j
    return out


def shingles(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``size`` words; fewer words count as one run."""
    n = len(hashes)
    if not n:
        return hashes
    span = min(size, n)
    with np.errstate(over="ignore"):
        total = np.zeros(n - span + 1, np.uint64)
        for k in range(span):
            total += hashes[k : n - span + 1 + k] * _ORDER[k]
        return mix(total + np.uint64(span))


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """For each row the sorted distinct shingle hashes."""
    data, offsets = text_bytes(column)
    for first, last in chunks(offsets):
        base = offsets[first]
        part = data[base : offsets[last]]
        starts, ends, rows = word_spans(part, offsets[first : last + 1] - base)
        hashes = word_hashes(part, starts, ends)
        cuts = np.searchsorted(rows, np.arange(last - first + 1))
        for k in range(last - first):
            yield np.unique(shingles(hashes[cuts[k] : cuts[k + 1]]))
