"""Words of many texts at once, as numbers: places and 64-bit hashes, without a Python step per word."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_BYTES = np.random.default_rng(20240817).integers(1, 2 ** 64, 256, dtype=np.uint64) | np.uint64(1)
_LOWER = _BYTES.copy()
_LOWER[65:91] = _BYTES[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(count: int) -> np.ndarray:
    """The first powers of the hash's base."""
    global _POWERS
    if len(_POWERS) < count:
        steps = np.full(max(count, 256), _BASE, dtype=np.uint64)
        steps[0] = 1
        _POWERS = np.multiply.accumulate(steps)
    return _POWERS[:count]


@dataclass
class Words:
    """Words of a list of texts in order: the bytes of all texts, each word's text, start, end and hash."""

    data: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    counts: np.ndarray  # words of each text
    first: np.ndarray  # each text's first word


def runs(data: np.ndarray, inside: np.ndarray, table: np.ndarray = _BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of each unbroken run of bytes marked as inside; the table has a number for each byte."""
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    start, end = edges[0::2], edges[1::2]
    hashes = np.empty(0, dtype=np.uint64)
    if len(start):
        length = end - start
        own = np.cumsum(length) - length
        place = np.arange(own[-1] + length[-1]) - np.repeat(own, length)
        value = table[data[inside]] * powers(int(length.max()))[place]
        hashes = mix(np.add.reduceat(value, own) + length.astype(np.uint64))
    return start, end, hashes


def words_of(texts: list[str | None], lower: bool = True) -> Words:
    """Words are runs without the six ASCII white-space characters; with ``lower`` A-Z count as a-z."""
    raw = [(text or "").encode() for text in texts]
    data = np.frombuffer(b"\n".join([*raw, b""]), dtype=np.uint8)
    start, end, hashes = runs(data, ~_SPACE[data], _LOWER if lower else _BYTES)
    begins = np.cumsum([0, *(len(part) + 1 for part in raw)])
    first = np.searchsorted(start, begins[:-1])
    counts = np.diff(np.append(first, len(start)))
    return Words(data, np.repeat(np.arange(len(texts)), counts), start, end, hashes, counts, first)


def shingles(words: Words, size: int) -> list[np.ndarray]:
    """Each text's sorted distinct hashes of ``size`` neighbouring words; of all its words if it has fewer."""
    hashes, out = words.hash, []
    if len(hashes) >= size:
        rolled = np.zeros(len(hashes) - size + 1, dtype=np.uint64)
        for step in range(size):
            rolled = rolled * _BASE + hashes[step:len(hashes) - size + 1 + step]
        rolled = mix(rolled)
    for first, count in zip(words.first.tolist(), words.counts.tolist()):
        if count >= size:
            found = np.sort(rolled[first:first + count - size + 1])
            out.append(found[np.append(True, found[1:] != found[:-1])])
        elif count:
            own = hashes[first:first + count] * powers(count)[::-1]
            out.append(mix(np.add.reduce(own, keepdims=True) + np.uint64(count)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out
