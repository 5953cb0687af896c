"""Suffix arrays of byte strings in numpy, to a bounded depth."""

from __future__ import annotations

import numpy as np


def _heads(text: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as one big-endian number; zeros beyond the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(text), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k : k + len(text)]
    return out


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``text`` in the order of their suffixes, of which ``depth`` bytes count.

    Larsson and Sadakane's refinement: suffixes are grouped by their first eight bytes; then, in
    each round, only groups of several suffixes are sorted by the group of the suffix that starts
    where the compared bytes end, which doubles these (the last round reaches ``depth`` just so).
    Suffixes that agree in ``depth`` bytes stay beside each other, in the order of their places.
    """
    n = len(text)
    heads = _heads(text)
    tail = max(0, n - 7)  # from here on suffixes are shorter than their padded heads: the shortest of equals comes first
    places = np.concatenate([np.arange(n - 1, tail - 1, -1), np.arange(tail)])
    order = places[np.argsort(heads[places], kind="stable")]
    new = np.ones(n, bool)
    new[1:] = (heads[order[1:]] != heads[order[:-1]]) | (order[1:] >= tail) | (order[:-1] >= tail)
    group = np.zeros(n + 1, np.int64)
    group[n] = -1  # a suffix that has ended comes first
    group[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    known = 8
    while known < depth:
        step = min(known, depth - known)
        ends = np.append(new[1:], True)
        slots = np.flatnonzero(~(new & ends))
        if not len(slots):
            break
        places = order[slots]
        later = group[np.minimum(places + step, n)]
        own = group[places]
        ranks = np.argsort(own * (n + 2) + later + 1, kind="stable")
        places, own, later = places[ranks], own[ranks], later[ranks]
        order[slots] = places
        split = np.concatenate([[True], (own[1:] != own[:-1]) | (later[1:] != later[:-1])])
        new[slots] = split
        group[places] = np.maximum.accumulate(np.where(split, slots, 0))
        known += step
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int, stride: int = 64) -> np.ndarray:
    """For each rank, how many bytes its suffix shares with the one before it (``depth`` at most).

    Kasai's bound: a suffix one place further shares at most one byte less with its own
    neighbour.  Every ``stride``-th place is compared from its start on, all at once and eight
    bytes at a time, and the others from what the bound leaves them.
    """
    n = len(text)
    heads, before = _heads(text), np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)

    def extended(places: np.ndarray) -> None:
        at = places[before[places] >= 0]
        while len(at):
            a, b = at + shared[at], before[at] + shared[at]
            room = np.minimum(n - np.maximum(a, b), depth - shared[at])
            a, b = np.minimum(a, n - 1), np.minimum(b, n - 1)
            other = heads[a] ^ heads[b]
            # leading equal bytes of the eight: none differs where the first differing byte is beyond
            equal = np.where(other == 0, 8, 7 - np.floor(np.log2(other.astype(np.float64) + (other == 0)) / 8).astype(np.int64))
            equal = np.clip(equal, 0, 8)
            gained = np.minimum(equal, np.maximum(room, 0))
            shared[at] += gained
            at = at[(gained == 8) & (room > 8)]

    samples = np.arange(0, n, stride)
    extended(samples)
    rest = np.setdiff1d(np.arange(n), samples, assume_unique=True)
    sample = rest // stride * stride
    # where the count has stopped at ``depth`` the order beyond isn't known; there the bound needs the same pair
    bound = (shared[sample] < depth) | (before[rest] - rest == before[sample] - sample)
    shared[rest] = np.where(bound & (before[rest] >= 0), np.maximum(0, shared[sample] - rest % stride), 0)
    extended(rest)
    return shared[order]


def gram_hashes(text: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of the ``length`` bytes from every place on that has so many.

    Hashes of 1, 2, 4 ... bytes are put together by the binary digits of the length, so the cost
    is its logarithm for each byte.
    """
    from tunetables.llm.common import _BYTES

    n = len(text) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = 0x9E3779B97F4A7C15
    power, whole = _BYTES[text], None
    done, size = 0, 1
    with np.errstate(over="ignore"):
        while True:
            if length & size:
                part = power[done : done + n]
                whole = part.copy() if whole is None else whole * np.uint64(pow(base, size, 1 << 64)) + part
                done += size
            if done == length:
                return whole
            power = power[:-size] * np.uint64(pow(base, size, 1 << 64)) + power[size:]
            size *= 2
