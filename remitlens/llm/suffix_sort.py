"""Two-stage suffix sorting of many byte strings, and adjacent prefixes."""

from __future__ import annotations

import numpy as np


def smaller_than_next(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each position, whether its suffix is smaller than the next one. A
    string's end counts as smaller than all bytes."""
    n = len(data)
    differs = np.ones(n, bool)
    differs[:-1] = data[:-1] != data[1:]
    differs[ends - 1] = True
    rises = np.zeros(n, bool)
    rises[:-1] = data[:-1] < data[1:]
    rises[ends - 1] = False
    at = np.where(differs, np.arange(n), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    return rises[at]


def sort_suffixes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes at the first ``wanted[i]`` positions of each string
    ``data[starts[i]:ends[i]]``, ordered by ``depth`` bytes at least.

    Only suffixes smaller than their successors are sorted directly. The
    others follow from them: buckets of equal first bytes are scanned in
    order, and each suffix met puts its predecessor, if that is a larger one,
    at the end of what its bucket holds so far. Of every string just the
    wanted positions take part, and those after them up to the next smaller
    one (or the string's end).
    """
    n = len(data)
    smaller = smaller_than_next(data, ends)
    # the first directly sorted position at or after the wanted ones
    following = np.where(smaller, np.arange(n), n)
    following = np.append(np.minimum.accumulate(following[::-1])[::-1], n)
    stop = np.minimum(following[np.minimum(starts + wanted, n)], ends)  # == ends: the string's end
    part = np.zeros(n + 1, np.int32)
    np.add.at(part, starts, 1)
    np.add.at(part, np.minimum(stop + 1, ends), -1)
    part = np.cumsum(part[:n]) > 0
    induced = part & ~smaller
    direct = np.flatnonzero(part & smaller)
    raw = data.tobytes()
    limit = np.repeat(ends, ends - starts)  # of each position (strings lie end to end)
    keys = [raw[a:b] for a, b in zip(direct.tolist(), np.minimum(direct + depth, limit[direct]).tolist(), strict=True)]
    direct = direct[np.array(sorted(range(len(keys)), key=keys.__getitem__), dtype=np.int64)] if keys else direct
    bounds = np.searchsorted(data[direct], np.arange(257))  # directly sorted ones by first byte
    first = np.zeros(n + 1, bool)
    first[starts] = True

    buckets: list[list[np.ndarray]] = [[] for _ in range(256)]
    ordered: list[np.ndarray] = []

    def hand_on(met: np.ndarray, own: int) -> np.ndarray:
        """Predecessors of suffixes go to their buckets; those of the own
        bucket are returned."""
        before = met[~first[met]] - 1 if own >= 0 else met - 1
        before = before[induced[before]]
        byte = data[before]
        order = np.argsort(byte, kind="stable")
        before, byte = before[order], byte[order]
        edges = np.flatnonzero(np.diff(byte, prepend=byte[:1] ^ 1)) if len(byte) else np.zeros(0, np.int64)
        again = met[:0]
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(byte)], strict=False):
            if byte[a] == own:
                again = before[a:b]
            else:
                buckets[byte[a]].append(before[a:b])
        return again

    hand_on(ends[stop == ends], -1)  # the empty suffixes come first
    for byte in range(256):
        met = np.concatenate(buckets[byte]) if buckets[byte] else direct[:0]
        while len(met):
            ordered.append(met)
            met = hand_on(met, byte)
        own = direct[bounds[byte] : bounds[byte + 1]]
        if len(own):
            ordered.append(own)
            hand_on(own, byte)
    found = np.concatenate(ordered) if ordered else direct
    asked = np.zeros(n + 1, np.int32)
    np.add.at(asked, starts, 1)
    np.add.at(asked, starts + wanted, -1)
    return found[np.cumsum(asked[:n])[found] > 0]


def common_prefixes(data: np.ndarray, order: np.ndarray, depth: int, block: int = 16384) -> np.ndarray:
    """Length (``depth`` at most) of the prefix that each suffix has in common
    with the one before it. All suffixes have ``depth`` bytes."""
    lengths = np.zeros(len(order), np.int64)
    if len(order) < 2:
        return lengths
    view = np.lib.stride_tricks.sliding_window_view(data, depth)
    for a in range(1, len(order), block):
        b = min(a + block, len(order))
        own = view[order[a - 1 : b]]
        differ = own[1:] != own[:-1]
        lengths[a:b] = np.where(differ.any(axis=1), differ.argmax(axis=1), depth)
    return lengths
