"""Texts of an Arrow batch as flat byte arrays, and hashes over their words and bytes.

Everything works on whole batches with numpy: no Python object is made per text or word.
Batches are cut into runs of about a mebibyte of text, so that the arrays stay in the
processor's cache and a task's memory does not depend on the batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
RUN_BYTES = 1 << 20

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
BYTE_KEYS = _RANDOM.integers(1, 2**63, (2, 256), dtype=U64)
_BASES = [int(x) | 5 for x in _RANDOM.integers(2**62, 2**63, 2, dtype=U64)]
_POWERS: list[tuple[np.ndarray, np.ndarray]] = [(np.ones(1, U64), np.ones(1, U64))] * 2

# [^\x20\x09-\x0D]: bytes of a word. In UTF-8 no other character holds these bytes.
WORD_BYTE = np.ones(256, bool)
WORD_BYTE[[0x20, *range(0x09, 0x0E)]] = False


def powers(n: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i below at least ``n``."""
    up, down = _POWERS[which]
    if len(up) < n:
        n = max(n, 2 * len(up))
        base = _BASES[which]
        up, down = np.full(n, base, U64), np.full(n, pow(base, -1, 2**64), U64)
        up[0] = down[0] = 1
        up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        _POWERS[which] = (up, down)
    return up, down


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all bits; a bijection."""
    x = x ^ (x >> U64(32))
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(29)
    x *= U64(0xA24BAED4963EE407)
    x ^= x >> U64(32)
    return x


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of ``values[start:end]`` for each pair; equal ranges have equal hashes."""
    up, down = powers(len(values) + 1, which)
    prefix = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[: len(values)], out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(U64))


def window_hashes(values: np.ndarray, k: int, which: int = 0) -> np.ndarray:
    """Hash of every run of ``k`` values, by its start."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    up, down = powers(len(values) + 1, which)
    prefix = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[: len(values)], out=prefix[1:])
    return mix((prefix[k:] - prefix[:-k]) * down[:n])


def text_runs(column: pa.Array, limit: int = RUN_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text column into runs: first row, row after the last, bytes, text offsets.

    Null is an empty text. A run holds whole texts, and more than ``limit`` bytes only
    if it is a single text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray = WORD_BYTE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word of a run, and the first word of each text.

    The last array has one entry more than there are texts; words never span texts.
    ``kinds`` tells the bytes of words.
    """
    inside = kinds[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    begin[cuts] = inside[cuts]
    finish = inside.copy()
    finish[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    finish[last] = inside[last]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    return range_hashes(BYTE_KEYS[which][data], starts, ends, which)


LONG_SPAN = 1024
_TAIL = np.array([(1 << 8 * i) - 1 for i in range(9)], U64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of ``data[start:end]`` for each pair, by blocks of eight bytes.

    Every block passes through ``mix``, so no pattern of equal parts cancels out. The blocks of
    all spans are read side by side; spans over ``LONG_SPAN`` bytes take a digest instead.
    """
    sizes = ends - starts
    out = mix(sizes.astype(U64) + U64(seed))
    eights = np.ndarray(len(data) + 1, "<u8", np.concatenate((data, np.zeros(8, np.uint8))), strides=(1,))
    long = sizes > LONG_SPAN
    for i in np.flatnonzero(long):
        content = data[starts[i] : ends[i]].tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(content, digest_size=8, key=seed.to_bytes(8, "little")).digest(), "little")
    live = np.flatnonzero((sizes > 0) & ~long)
    at = starts[live]
    while len(live):
        left = ends[live] - at
        out[live] = mix(out[live] * U64(0x9E3779B97F4A7C15) ^ (eights[at] & _TAIL[np.minimum(left, 8)]))
        more = left > 8
        live, at = live[more], at[more] + 8
    return out


def inside_texts(counts: np.ndarray, k: int, total: int) -> np.ndarray:
    """Which starts of ``k`` consecutive items stay inside one text.

    ``counts`` has the first item of each text, with the total at its end.
    """
    good = np.ones(total, bool)
    ends = np.minimum(np.diff(counts), k - 1)
    good[ranges(counts[1:] - ends, ends)] = False
    return good


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``start, start + 1, ...`` of each range, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return np.arange(total, dtype=np.int64) + shift


def sliding(values: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """Least (or greatest) of each ``width`` neighbours, by doubling the width."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = pick(out[: len(out) - step], out[step:])
        have += step
    return out


def winnowed(hashes: np.ndarray, width: int) -> np.ndarray:
    """Which positions hold the least hash of some ``width`` neighbouring positions.

    Any two equal stretches of ``width`` hashes select the same positions. All positions
    of one text; a text with fewer than ``width`` hashes selects its least ones.
    """
    n = len(hashes)
    if not n:
        return np.zeros(0, bool)
    width = min(width, n)
    low = sliding(hashes, width)
    edge = np.zeros(width - 1, U64)
    return sliding(np.concatenate((edge, low, edge)), width, np.maximum) == hashes


def large_binary(parts: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary column whose values are consecutive pieces of a byte array."""
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(),
        len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(parts))],
    ).cast(pa.binary())
