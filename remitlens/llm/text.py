"""Whole texts as flat byte arrays: words and hashes of many texts at once.

Everything works on the UTF-8 bytes of an Arrow string column. A batch is cut
into pieces of bounded size (a single longer text is a piece of its own), so
a task's memory follows the piece, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def lower_table() -> np.ndarray:
    """Byte map that lower-cases A-Z and leaves all else."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def space_words() -> np.ndarray:
    """Which bytes belong to a word ``[^\\x20\\x09-\\x0D]+``."""
    t = np.ones(256, dtype=bool)
    t[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
    return t


def alnum_words() -> np.ndarray:
    """Which bytes belong to a word ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``
    after A-Z are lower-cased."""
    t = np.zeros(256, dtype=bool)
    t[0x30:0x3A] = t[0x41:0x5B] = t[0x61:0x7B] = True
    t[0x80:] = True
    return t


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = x ^ (x >> _U64(30))
    x = x * _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=_U64) * _U64(_BASE))
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2**64."""
    have = _POWERS.get("p")
    if have is None or len(have) < n:
        n = max(n, PIECE_BYTES + 1024)
        for name, base in (("p", _BASE), ("i", _INVERSE)):
            p = np.full(n, base, dtype=_U64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=_U64)
    return _POWERS["p"], _POWERS["i"]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    n = len(column)
    if n == 0 or ends is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(ends, np.int64 if large else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows of about ``limit`` bytes at most: (first, end, bytes, offsets)."""
    data, offsets = flat(column)
    n, first = len(offsets) - 1, 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(max(end, first + 1), n, first + 65536)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts of a piece: starts, ends, and for each text the
    index of its first word (one entry more than texts)."""
    inside = table[data]
    before = np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:], after[:-1] = False, inside[1:]
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def rolling(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which :func:`span_hash` reads any span's hash."""
    p, _ = powers(len(data) + 1)
    sums = np.empty(len(data) + 1, dtype=_U64)
    sums[0] = 0
    np.cumsum(_BYTE_VALUES[data] * p[: len(data)], dtype=_U64, out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes, equal for equal bytes anywhere."""
    _, inverse = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(_U64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hash(rolling(data), starts, ends)
