"""Words of many texts at once, as 64-bit hashes.

A word is a longest run of ASCII letters, digits and bytes of non-ASCII
characters, A-Z lowered: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lowering.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_LOWER = np.zeros(256, np.uint8)
for _b in range(256):
    if 48 <= _b <= 57 or 97 <= _b <= 122 or _b >= 128:
        _LOWER[_b] = _b
    elif 65 <= _b <= 90:
        _LOWER[_b] = _b + 32

_BASE = 0x9E3779B97F4A7C15
#: Bytes whose hashes are worked out at once (a longer text alone).
STEP = 1 << 20

class _Cache(dict):
    """Stays where it was filled."""

    def __reduce__(self):
        return _Cache, ()


_POWERS = _Cache()


@dataclass
class Words:
    """``hashes``, ``starts`` and ``ends`` (bytes) by word; text i has words ``bounds[i]`` to ``bounds[i + 1]``."""

    lowered: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit integers over the whole range."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 1 << 20)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"][:n], _POWERS["down"]


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``, about STEP bytes at a time."""
    part = offsets[:-1] // STEP
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(offsets) - 1]
    parts = [_words_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in zip(edges, edges[1:], strict=False)]
    if len(parts) == 1:
        return parts[0]
    shift, first = [int(offsets[a]) for a in edges[:-1]], np.cumsum([0, *(len(p.hashes) for p in parts)])
    joined = lambda name, by: np.concatenate([getattr(p, name) + s for p, s in zip(parts, by, strict=False)])
    bounds = np.concatenate([p.bounds[:-1] + f for p, f in zip(parts, first, strict=False)] + [first[-1:]])
    return Words(np.concatenate([p.lowered for p in parts]), np.concatenate([p.hashes for p in parts]), joined("starts", shift), joined("ends", shift), bounds)


def _words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    n = len(data)
    lowered = _LOWER[data]
    inside = lowered > 0
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    starts = np.flatnonzero(inside & (edge[:n] | ~before))
    ends = np.flatnonzero(inside & (edge[1:] | ~after)) + 1
    up, down = _powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(lowered * up, out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts])
    return Words(lowered, hashes, starts, ends, np.searchsorted(starts, offsets))


def shingles(hashes: np.ndarray, bounds: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct hashes of ``width`` neighbouring words by text; a shorter text, if not without words, is one shingle."""
    if not len(hashes):
        return [hashes] * (len(bounds) - 1)
    whole = np.zeros(len(hashes), np.uint64)
    for k in range(width):
        factor = np.uint64(pow(0xD6E8FEB86659FD93, k + 1, 1 << 64))
        whole[: len(hashes) - k] += hashes[k:] * factor
    whole = mix(whole)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(whole[a : b - width + 1]))
        elif b > a:
            factors = np.array([pow(0xD6E8FEB86659FD93, k + 1, 1 << 64) for k in range(b - a)], np.uint64)
            out.append(mix(np.array([(hashes[a:b] * factors).sum() + np.uint64(b - a)], np.uint64)))
        else:
            out.append(hashes[:0])
    return out
