"""64-bit hashes of the words of a text, computed on its bytes with numpy inside tasks."""

from __future__ import annotations

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20240229))  # a fixed seed: equal words hash alike in every task
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
BLOCK = 1 << 19
_POWER = np.cumprod(np.full(256, _BASE, np.uint64))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _block(raw: np.ndarray) -> np.ndarray:
    """Hashes of the words of bytes that begin and end at word edges."""
    gap = np.concatenate(([True], _SPACE[raw], [True]))
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.empty(0, np.uint64)
    # sum over a word's bytes of table[byte] * base^(place in the word); places wrap after 256 and are salted by the turn
    word = np.cumsum(np.bincount(start, minlength=len(raw)))  # 1-based number of the word that has begun
    at = np.arange(len(raw)) - np.concatenate(([0], start))[word]
    value = _BYTE[_LOWER[raw]] * _POWER[at & 255]
    if at.max() > 255:
        value = value + mix((at >> 8).astype(np.uint64)) * (at > 255)
    value[gap[1:-1]] = 0
    return mix(np.add.reduceat(value, start) + (end - start).astype(np.uint64))


def words(text: bytes) -> np.ndarray:
    """Hash of each word ``[^\\x20\\x09-\\x0D]+`` of the text, A-Z lower-cased; long texts in blocks cut at spaces."""
    raw = np.frombuffer(text, np.uint8)
    if len(raw) <= BLOCK:
        return _block(raw)
    out, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + BLOCK)
        while end < len(raw) and not _SPACE[raw[end]]:
            end += 1
        out.append(_block(raw[at:end]))
        at = end
    return np.concatenate(out)


def shingles(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of runs of ``size`` words; of the whole sequence if it is shorter; none without words."""
    n = len(hashes)
    if not n:
        return hashes
    if n < size:
        parts, width = [hashes[i : i + 1] for i in range(n)], n
    else:
        parts, width = [hashes[i : n - size + 1 + i] for i in range(size)], size
    total = np.full(len(parts[0]), np.uint64(width))
    for part in parts:
        total = mix(total * np.uint64(0xD1342543DE82EF95) + part)
    return np.unique(total)
