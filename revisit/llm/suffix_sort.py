"""Two-stage suffix sorting of one block of bytes, with numpy.

A suffix is of type B if it is smaller than the next one, else of type A. Only the type B suffixes are sorted
directly, eight bytes at a time, as deep as `depth`; the type A suffixes are induced from them by one scan over
the buckets of first bytes: met in order, each suffix p puts p - 1, if of type A, at the front of what is still free
in its bucket. Within a bucket all type A suffixes come before those of type B. Suffixes that agree in the first
`depth` bytes may come in any order.
"""

from __future__ import annotations

import numpy as np


def words_at(data: np.ndarray, pad: int) -> np.ndarray:
    """For each place the next eight bytes as a big-endian number; zero bytes follow the end, `pad` places more."""
    padded = np.concatenate([data, np.zeros(pad + 8, np.uint8)])
    out = np.empty(len(data) + pad, np.uint64)
    for r in range(8):
        n = len(out[r::8])
        out[r::8] = np.frombuffer(padded[r : r + 8 * n].tobytes(), ">u8")
    return out


def _types(data: np.ndarray) -> np.ndarray:
    """Whether each suffix is of type B. The last is of type A: it is greater than the empty one."""
    n = len(data)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(data[1:].astype(np.int16) - data[:-1].astype(np.int16))
    step[-1] = -1
    # Equal bytes have the type of the next place with a different one.
    at = np.where(step != 0, np.arange(n), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    return step[at] > 0


def _sorted(places: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Places by their first `depth` bytes: each round sorts only what is still tied."""
    order = places[np.argsort(words[places], kind="stable")]
    same = np.zeros(len(order), bool)
    same[1:] = words[order[1:]] == words[order[:-1]]
    for d in range(8, depth, 8):
        tied = same.copy()
        tied[:-1] |= same[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        group = np.cumsum(~same[at])
        some = order[at]
        key = words[some + d]
        sub = np.lexsort((key, group))
        some, key = some[sub], key[sub]
        order[at] = some
        again = np.zeros(len(at), bool)
        again[1:] = (key[1:] == key[:-1]) & (group[1:] == group[:-1])
        same[at] = again
    return order


def suffix_array(data: np.ndarray, depth: int, words: np.ndarray | None = None) -> np.ndarray:
    """The places of all suffixes in order of their first `depth` bytes."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64)
    words = words_at(data, depth + 8) if words is None else words
    is_b = _types(data)
    second = _sorted(np.flatnonzero(is_b), words, depth)
    ends = np.searchsorted(data[second], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[data[-1]].append(np.array([n - 1]))  # the empty suffix comes first of all
    out = []
    for c in range(256):
        wave = np.concatenate(waiting[c]) if waiting[c] else np.empty(0, np.int64)
        bucket = []
        while len(wave):
            bucket.append(wave)
            before = wave[wave > 0] - 1
            wave = before[data[before] == c]
        bucket.append(second[ends[c] : ends[c + 1]])
        bucket = np.concatenate(bucket)
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        first = data[before]
        later = first > c
        before, first = before[later], first[later]
        if len(before):
            order = np.argsort(first, kind="stable")
            before, first = before[order], first[order]
            cuts = np.flatnonzero(np.diff(first)) + 1
            for part, k in zip(np.split(before, cuts), first[np.concatenate([[0], cuts])]):
                waiting[k].append(part)
    return np.concatenate(out)


def common_prefixes(order: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """For each place in order, how many first bytes it shares with the one before, at most `depth`; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    live = np.arange(1, len(order))
    for d in range(0, depth, 8):
        x = words[order[live] + d] ^ words[order[live - 1] + d]
        same = x == 0
        rest = live[~same]
        bits = np.zeros(len(rest), np.int64)
        y = x[~same]
        for shift in (32, 16, 8):
            top = (y >> np.uint64(64 - shift)) == 0
            bits[top] += shift
            y = np.where(top, y << np.uint64(shift), y)
        out[rest] = d + bits // 8
        live = live[same]
        out[live] = d + 8
    return np.minimum(out, depth)
