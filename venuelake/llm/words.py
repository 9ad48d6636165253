"""Words and shingles of whole texts as 64-bit hashes, in numpy on Arrow buffers.

A word is a run of bytes other than space and 0x09-0x0D; A-Z count as a-z. Hashes are sums
of mixed bytes times powers, finished by a multiply-xorshift step. Two different words of
one corpus share a hash with probability n^2 / 2^65.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes hashed at once.
WINDOW = 1 << 20
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xD6E8FEB86659FD93)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(32)
    values *= _ODD
    values ^= values >> np.uint64(29)
    values *= _STEP
    values ^= values >> np.uint64(32)
    return values


_BYTE = mix(_LOWER.astype(np.uint64) + np.uint64(1))


def _powers(n: int) -> np.ndarray:
    factors = np.full(n, _STEP, np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


_POWERS = _powers(256)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a string column and the n + 1 bounds of its rows; nulls are empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    buffers = texts.buffers()
    bounds = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    if not len(bounds):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    return data[bounds[0] : bounds[-1]], bounds.astype(np.int64) - int(bounds[0])


def word_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~_SEPARATOR[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of a string column, and the n + 1 bounds of each row's words."""
    global _POWERS
    data, bounds = text_bytes(texts)
    starts, ends = word_bounds(data, bounds)
    out = np.zeros(len(starts), np.uint64)
    lengths = ends - starts
    if len(lengths) and lengths.max() > len(_POWERS):
        _POWERS = _powers(int(lengths.max()))
    filled = np.concatenate([[0], np.cumsum(lengths)])
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(filled, filled[at] + WINDOW, "right")) - 1)
        own = lengths[at:to]
        shift = filled[at:to] - filled[at]
        place = np.arange(int(own.sum())) - np.repeat(shift, own)
        values = _BYTE[data[np.repeat(starts[at:to], own) + place]] * _POWERS[place]
        out[at:to] = np.add.reduceat(values, shift)
        at = to
    return mix(out + lengths.astype(np.uint64) * _ODD), np.searchsorted(starts, bounds)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; of the whole sequence if it is shorter, none if empty."""
    if not len(words):
        return words
    size = min(size, len(words))
    total = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        total += words[k : k + len(total)] * _POWERS[size - k]
    return mix(total + np.uint64(size))
