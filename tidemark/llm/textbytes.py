"""Words of a column of texts as numpy arrays: bounds, hashes and windows, without a Python loop per word.

Used inside tasks on the Arrow batches Spark hands over. Memory is about 40 bytes per byte of a slice, and a
slice holds at most `limit` bytes of text or one whole text.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE_BYTES = (1 << 20) - 1024
LINE_FEED, NOTHING = pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string())

_rng = np.random.default_rng(20240229)
LETTER = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP = int(_rng.integers(0, 2**60)) * 8 + 3
STEP_INVERSE = pow(STEP, -1, 2**64)
WINDOW = _rng.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Word bytes of the two rules in use: all but white space; ASCII letters and digits with everything beyond ASCII.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


class Powers:
    """Powers of the hash step and of its inverse, grown as longer slices come."""

    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def reach(cls, n: int) -> None:
        if len(cls.up) < n:
            size = 1 << max(10, (n - 1).bit_length())
            with np.errstate(over="ignore"):
                for name, base in (("up", STEP), ("down", STEP_INVERSE)):
                    powers = np.full(size, base, dtype=np.uint64)
                    powers[0] = 1
                    setattr(cls, name, np.cumprod(powers, dtype=np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread of 64-bit values: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows; each text is followed by one line feed, nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes + 1)
    first = 0
    while first < n:
        before = ends[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
        part = pc.binary_join_element_wise(column.slice(first, end - first), LINE_FEED, NOTHING)
        buffers = part.buffers()
        offsets = np.frombuffer(buffers[1], dtype=np.int64)[part.offset : part.offset + len(part) + 1]
        data = np.frombuffer(buffers[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
        yield first, end, data, offsets - offsets[0]
        first = end
    give_back()


def give_back() -> None:
    """Free memory to the system: a worker that waits for its next task does not keep what its last column took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def word_bounds(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each text the number of words before it (one more entry than texts)."""
    inside = word_bytes[data].view(np.int8)
    edge = np.diff(inside, prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return starts, ends, np.searchsorted(starts, offsets, "left")


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """A 64-bit hash of each word; with `fold`, A-Z count as a-z."""
    Powers.reach(len(data) + 1)
    with np.errstate(over="ignore"):
        letters = LETTER[LOWER] if fold else LETTER
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(letters[data] * Powers.up[: len(data)], out=total[1:])
        return mix((total[ends] - total[starts]) * Powers.down[starts])


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of `width` word hashes, over text bounds too: the caller picks the runs inside a text."""
    if len(words) < width:
        return np.zeros(0, dtype=np.uint64)
    n = len(words) - width + 1
    with np.errstate(over="ignore"):
        total = np.full(n, np.uint64(width))
        for j in range(width):
            total += words[j : j + n] * WINDOW[j]
        return mix(total)


def shingle_sets(words: np.ndarray, first: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its runs of `width` words; fewer words make one shingle, none an empty set."""
    runs = window_hashes(words, width)
    for s, e in zip(first[:-1].tolist(), first[1:].tolist()):
        if e - s >= width:
            own = np.sort(runs[s : e - width + 1])
            keep = np.ones(len(own), dtype=bool)
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            yield own[keep]
        elif e > s:
            yield window_hashes(words[s:e], e - s)
        else:
            yield words[:0]
