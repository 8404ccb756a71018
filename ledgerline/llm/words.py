"""Words of many texts as flat numpy arrays: spans and 64-bit hashes over Arrow string buffers.

A word is a maximal run of bytes other than space and 0x09-0x0D (all of them one-byte characters in
UTF-8, so byte runs are character runs). Nothing is decoded to Python strings. Memory is bounded by
``SLICE`` bytes of text at a time, however many rows a batch has; a text longer than that is taken
whole in its own slice, its words hashed in pieces of ``SLICE`` bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
#: Rows whose texts are copied (cast, lower-cased) at a time.
ROWS = 512

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=4)
def _powers(n: int, base: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    have = 1
    step = base
    while have < n:  # doubling: the next block is the block before times base**have
        k = min(have, n - have)
        out[have : have + k] = out[:k] * np.uint64(step)
        step = step * step & 0xFFFFFFFFFFFFFFFF
        have += k
    return out


def _text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (length + 1) of a string column; nulls are empty."""
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def text_slices(column: pa.Array, lower: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows holding at most ``SLICE`` bytes, or one row."""
    for base in range(0, len(column), ROWS):
        part = column.slice(base, ROWS)
        raw, off = _text_buffer(pc.utf8_lower(part) if lower else part)
        rows, at = len(off) - 1, 0
        while at < rows:
            end = max(at + 1, int(np.searchsorted(off, off[at] + SLICE, "right")) - 1)
            yield base + at, base + end, raw[off[at] : off[end]], off[at : end + 1] - off[at]
            at = end


def word_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word; texts are apart even where no space is between them."""
    if not len(raw):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    inside = ~_SPACE[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < len(raw))]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes: a polynomial over prefix sums, scrambled with the length."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + SLICE, "right")))
        lo, hi = int(starts[at]), int(ends[stop - 1])
        power = _powers(_room(hi - lo), _BASE)
        sums = np.empty(hi - lo + 1, np.uint64)
        sums[0] = 0
        np.cumsum((raw[lo:hi].astype(np.uint64) + np.uint64(1)) * power[: hi - lo], out=sums[1:])
        s, e = starts[at:stop] - lo, ends[at:stop] - lo
        back = _powers(_room(hi - lo), pow(_BASE, -1, 1 << 64))
        out[at:stop] = mix((sums[e] - sums[s]) * back[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        at = stop
    return out


def _room(n: int) -> int:
    """A few array sizes only, so that the powers are made once per worker."""
    return SLICE + 1 if n <= SLICE + 1 else 1 << int(n - 1).bit_length()


def fold_case(raw: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, all else as it is."""
    return _FOLD[raw]


def words_of(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and, per text, the index of its first word (length texts + 1)."""
    starts, ends = word_spans(raw, off)
    return starts, ends, np.searchsorted(starts, off)
