"""Words of whole Arrow batches as 64-bit hashes, without a Python object per word."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: A word is a run of characters other than these; A-Z count as a-z.
SPACES = (0x20, *range(0x09, 0x0E))
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))


_kept: dict[object, object] = {}


def keep_one(key: object, build: Callable[[], object]) -> object:
    """A large object that a Python worker keeps from task to task, one at a time."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = build()
    return _kept[key]


def keep_none() -> None:
    """Let go of what the worker keeps: tasks that need their memory for something else begin with this."""
    _kept.clear()


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all 64 (splitmix)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    codes = np.arange(256)
    lower = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
    is_word = np.ones(256, dtype=bool)
    is_word[list(SPACES)] = False
    return mix(lower.astype(np.uint64) * np.uint64(2654435761)), is_word


_BYTE_VALUE, _IS_WORD = _byte_tables()
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _powers_up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, kept for the next batch."""
    global _powers
    if len(_powers[0]) < n:
        steps = [np.full(n, x, np.uint64) for x in (_MULTIPLIER, _INVERSE)]
        for step in steps:
            step[0] = 1
        _powers = tuple(np.multiply.accumulate(step) for step in steps)
    return _powers


def text_slices(texts: pa.Array, max_bytes: int = 1 << 19) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """(first row, end row, UTF-8 bytes, offsets) of runs of rows; null is empty.

    A run has ``max_bytes`` at most, or is one longer text.
    """
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        end = int(np.searchsorted(offsets, offsets[first] + max_bytes, "right")) - 1
        end = min(max(end, first + 1), len(texts))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and where the words of each text start (with the end).

    The hash is a polynomial in the word's bytes modulo 2**64, taken from prefix
    sums over all bytes and then mixed.  Equal words of any two batches agree.
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = _IS_WORD[data]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    powers, inverses = _powers_up_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * powers[: len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * inverses[starts]
    return mix(hashes ^ (ends - starts).astype(np.uint64)), np.searchsorted(starts, offsets)
