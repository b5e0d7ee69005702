"""Vectorised text primitives for Arrow batches (numpy, no per-row Python).

A batch's string column is one byte buffer plus offsets; the functions here
work on slices of that buffer of about a megabyte, so a task's memory does not
depend on the batch size. One document is never cut: a document longer than
the slice size gets a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: bytes of text handled at once
SLICE_BYTES = 1 << 20
_BLOCK = 1 << 17
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_MASK = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(1, dtype=_U)
    while out.size < n:
        step = _U(pow(base, out.size, 1 << 64))
        out = np.concatenate([out, out * step])
    return out[:n]


_POW = _powers(_BASE, _BLOCK)
_POW_INV = _powers(_INV, _BLOCK)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """256-entry table: True for the byte values in the inclusive ranges."""
    table = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        table[lo : hi + 1] = True
    return table


#: separators of the words ``[^\x20\x09-\x0D]+``
SPACE = byte_class((0x20, 0x20), (0x09, 0x0D))
#: separators of the words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z became a-z
NON_ALNUM = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
#: byte map lower-casing A-Z only
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every output bit depends on every input bit."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def seed(n: int) -> np.uint64:
    """n-th of a fixed series of 64-bit constants."""
    return mix(np.array([(n * 0xD1342543DE82EF95 + 0x2545F4914F6CDD1D) & _MASK], dtype=_U))[0]


class Slice(NamedTuple):
    """Rows ``lo:hi`` of a batch; ``off`` are the rows' offsets in ``buf``."""

    lo: int
    hi: int
    buf: np.ndarray
    off: np.ndarray


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a string (or binary) column into slices; null texts are empty."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        width = np.int64
    else:
        width = np.int32
    n = len(column)
    if n == 0:
        return
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=width)[column.offset : column.offset + n + 1].astype(np.int64)
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield Slice(lo, hi, buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
        lo = hi


def spans(s: Slice, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of non-separator bytes that do not cross rows.

    Returns starts, ends and ``first``: row r owns spans first[r]:first[r+1].
    """
    n = s.buf.size
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(s.off.size, np.int64)
    word = ~sep[s.buf]
    begin, end = word.copy(), word.copy()
    begin[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    inner = s.off[:-1][s.off[:-1] < n]
    begin[inner] = word[inner]
    last = s.off[1:][s.off[1:] > 0] - 1
    end[last] = word[last]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, s.off)


def span_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span; spans are ascending and may touch
    but not overlap. Polynomial prefix sums, block by block."""
    out = np.empty(starts.size, dtype=_U)
    i = 0
    while i < starts.size:
        base = int(starts[i])
        j = int(np.searchsorted(ends, base + _BLOCK, side="right"))
        if j <= i:  # one span longer than a block: fold its blocks
            h = 0
            for p in range(base, int(ends[i]), _BLOCK):
                part = buf[p : min(p + _BLOCK, int(ends[i]))]
                h = (h * pow(_BASE, _BLOCK, 1 << 64) + int((part.astype(_U) * _POW[: part.size]).sum(dtype=_U))) & _MASK
            out[i] = _U(h)
            i += 1
            continue
        a, b = starts[i:j] - base, ends[i:j] - base
        prefix = np.empty(int(b[-1]) + 1, dtype=_U)
        prefix[0] = 0
        part = buf[base : base + int(b[-1])]
        np.cumsum(part.astype(_U) * _POW[: part.size], out=prefix[1:])
        # a span that starts at the block's end is empty: its hash is 0
        out[i:j] = (prefix[b] - prefix[a]) * _POW_INV[np.minimum(a, _BLOCK - 1)]
        i = j
    return mix(out + (ends - starts).astype(_U) * _U(0xA24BAED4963EE407))


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive values of ``h`` (size max(0, len - n + 1))."""
    m = h.size - n + 1
    if m <= 0:
        return np.zeros(0, dtype=_U)
    acc = h[:m] + _U(n)
    for k in range(1, n):
        acc = acc * _U(_BASE) + h[k : k + m]
    return mix(acc)


def owners(first: np.ndarray) -> np.ndarray:
    """Row number of each item, from the rows' first-item offsets."""
    return np.repeat(np.arange(first.size - 1), np.diff(first))


def ngram_rows(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in a slice's item array) that start an n-gram inside one row,
    and the rows' first offsets in that list."""
    count = np.maximum(np.diff(first) - (n - 1), 0)
    start = np.concatenate([[0], np.cumsum(count)])
    pos = np.arange(start[-1]) + np.repeat(first[:-1] - start[:-1], count)
    return pos, start


def count_in(positions: np.ndarray, off: np.ndarray) -> np.ndarray:
    """How many of the ascending positions fall into each row."""
    return np.diff(np.searchsorted(positions, off))
