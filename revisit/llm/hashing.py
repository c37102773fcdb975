"""Vectorised hashes of words and word runs, over the bytes of many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**64, 256, dtype=np.uint64)
_PLACE = _rng.integers(1, 2**64, 4096, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x + _STEP
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and the n + 1 places where they begin; nulls are empty."""
    texts = texts.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word (run of anything but ASCII white space), and the words of each text as n + 1 places."""
    solid = ~_IS_SPACE[data]
    before = np.empty(len(data), bool)
    before[1:] = solid[:-1]
    before[:1] = False
    inner = offsets[:-1]
    before[inner[inner < len(data)]] = False
    first = solid & ~before
    at = np.flatnonzero(solid)
    starts = np.flatnonzero(first[at])  # in the solid bytes
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    lengths = np.diff(np.append(starts, len(at)))
    place = np.arange(len(at)) - np.repeat(starts, lengths)
    sums = np.add.reduceat(_BYTE[data[at]] * _PLACE[place & 4095], starts)
    hashes = mix(sums ^ mix(lengths.astype(np.uint64)))
    return hashes, np.searchsorted(at[starts], offsets).astype(np.int64)


def runs(words: np.ndarray, places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words inside each text, with the text's number; a text of fewer words is one run."""
    counts = np.diff(places)
    if len(words) >= n:
        total = words[: len(words) - n + 1].copy()
        for i in range(1, n):
            total = mix(total * _STEP + words[i : len(words) - n + 1 + i])
    else:
        total = np.empty(0, np.uint64)
    text = np.repeat(np.arange(len(counts)), counts)
    left = np.repeat(places[1:], counts) - np.arange(len(words)) if len(words) else np.empty(0, np.int64)
    whole = left[: len(total)] >= n
    hashes, owner = total[whole], text[: len(total)][whole]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        extra = np.empty(len(short), np.uint64)
        for j, i in enumerate(short):
            h = np.zeros(1, np.uint64)
            for k in range(places[i], places[i + 1]):
                h = mix(h * _STEP + words[k : k + 1])
            extra[j] = mix(h ^ np.uint64(counts[i]))[0]
        hashes, owner = np.concatenate([hashes, extra]), np.concatenate([owner, short])
    return hashes, owner


def distinct(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's different hashes, ascending, with text number and count."""
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return hashes[at], owner[at], np.diff(np.append(at, len(hashes)))


def slices(texts: pa.Array, most_bytes: int = 1 << 19, most_texts: int = 512):
    """Parts of an array of texts of about so many bytes and at most so many texts, as (first, part)."""
    lengths = texts.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(lengths.buffers()[1], np.int64)[lengths.offset : lengths.offset + len(lengths) + 1] if len(lengths) else np.zeros(1, np.int64)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, min(lo + most_texts, int(np.searchsorted(offsets, offsets[lo] + most_bytes, side="right")) - 1))
        yield lo, texts.slice(lo, hi - lo)
        lo = hi
