"""Whole texts of an Arrow batch as byte arrays: words, hashes and sums without a Python loop over characters."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
SPACE_BYTE = np.zeros(256, bool)
SPACE_BYTE[[9, 10, 11, 12, 13, 32]] = True
LOWER_BYTE = np.arange(256, dtype=np.uint8)
LOWER_BYTE[65:91] += 32


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins (one more than texts). Nulls are empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Spans of more bytes are hashed one by one.
_LONG_SPAN = 256


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes in each span, the same wherever they stand.

    Eight bytes at a time are mixed in, by a bijection, into a state that begins with the length: spans of up to eight bytes of one length never
    collide, longer ones by chance only. No sums or powers of bytes, which texts of a certain build cancel out. Long spans take BLAKE2b.
    """
    length = ends - starts
    state = mix64(length.astype(np.uint64) + _BASE)
    if not len(starts):
        return state
    window = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(8, np.uint8)]), 8)
    active = np.flatnonzero(length <= _LONG_SPAN)
    for k in range(0, _LONG_SPAN, 8):
        active = active[length[active] > k]
        if not len(active):
            break
        eight = window[starts[active] + k].view("<u8")[:, 0]
        left = np.minimum(length[active] - k, 8).astype(np.uint64)
        eight &= np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * left)
        state[active] = mix64(state[active] ^ eight) + _BASE
    for i in np.flatnonzero(length > _LONG_SPAN).tolist():
        state[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8, key=b"docmeter").digest(), "little")
    return state


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words begin and end, and each text's first word (one more than texts)."""
    solid = ~SPACE_BYTE[data]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begin, end = solid.copy(), solid
    begin[1:] &= ~solid[:-1]
    begin[inner] = solid[inner]  # a text begins anew
    last = end[inner - 1]
    end[:-1] &= ~end[1:]
    end[inner - 1] = last
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def running(values: np.ndarray) -> np.ndarray:
    """Prefix sums with a leading 0, to be differenced at span ends."""
    out = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=out[1:])
    return out
