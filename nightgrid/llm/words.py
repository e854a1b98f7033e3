"""Words of many texts at once, as arrays: places, owners and 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text taken together; a longer text is taken alone.
BLOCK_BYTES = 1 << 22
_HASH_BYTES = 1 << 19
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

_seen_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)


def byte_tables(separators: bytes | range | list[int]) -> tuple[np.ndarray, bytes]:
    """(which bytes belong to words, a translation that lowers A-Z and blanks the others)."""
    member = np.ones(256, bool)
    member[list(separators)] = False
    fold = bytearray(range(256))
    for upper in range(65, 91):
        fold[upper] = upper + 32
        member[upper] = member[upper + 32]
    return member, bytes(fold[b] if member[b] else 32 for b in range(256))


def _powers(n: int) -> np.ndarray:
    global _seen_powers
    if len(_seen_powers) < n:
        steps = np.full(max(n, 1 << 10), _MULTIPLIER, np.uint64)
        steps[0] = 1
        _seen_powers = np.cumprod(steps, dtype=np.uint64)
    return _seen_powers


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts on end and each text's offsets; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(texts: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end, bytes, offsets) of runs of texts of about ``size`` bytes."""
    data, offsets = text_buffers(texts)
    first, n = 0, len(offsets) - 1
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


class Words(NamedTuple):
    data: np.ndarray  #: folded bytes of all texts
    start: np.ndarray
    end: np.ndarray
    owner: np.ndarray  #: index of the text
    hash: np.ndarray  #: 64-bit hash of the folded word
    first: np.ndarray  #: for each text its first word; one entry more at the end


def find_words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray, fold: bytes) -> Words:
    inside = member[data]
    before = np.empty(len(data) + 1, bool)
    before[0] = False
    before[1:] = inside
    after = np.empty(len(data) + 1, bool)
    after[:-1] = inside
    after[-1] = False
    before[offsets] = False
    after[offsets] = False
    start = np.flatnonzero(inside & ~before[:-1])
    end = np.flatnonzero(inside & ~after[1:]) + 1
    folded = np.frombuffer(data.tobytes().translate(fold), np.uint8)
    owner = np.searchsorted(offsets, start, side="right") - 1
    first = np.searchsorted(owner, np.arange(len(offsets)))
    return Words(folded, start, end, owner, _hashes(folded, start, end), first)


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hashes of byte ranges, some hundred thousand bytes at a time."""
    out = np.empty(len(start), np.uint64)
    a = 0
    while a < len(start):
        b = max(a + 1, int(np.searchsorted(end, start[a] + _HASH_BYTES, side="right")))
        low, s, e = int(start[a]), start[a:b], end[a:b]
        power = _powers(int((e - s).max()))
        values = np.empty(int(e[-1]) - low + 1, np.uint64)
        values[-1] = 0
        values[:-1] = _BYTE_VALUES[data[low : e[-1]]]
        place = np.arange(len(values) - 1) - np.repeat(s - low, np.diff(np.append(s, e[-1])))
        values[:-1] *= power[np.minimum(place, len(power) - 1)]
        bounds = np.empty(2 * len(s), np.int64)
        bounds[::2], bounds[1::2] = s - low, e - low
        out[a:b] = np.add.reduceat(values, bounds)[::2]
        a = b
    return mix(out)


def shingle_hashes(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every run of ``n`` words within a text."""
    count = len(words.hash) - n + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.full(count, n, np.uint64)
    for k in range(n):
        total = total * _MULTIPLIER + words.hash[k : k + count]
        total ^= total >> np.uint64(29)
    whole = np.flatnonzero(words.owner[:count] == words.owner[n - 1 :])
    return whole, mix(total[whole])
