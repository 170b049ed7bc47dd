"""Rolling hashes and window minima over the code points of many texts at once."""

from __future__ import annotations

import numpy as np

#: Bases of two independent hashes.
BASE, SECOND = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Code points hashed at a time; small enough for the processor's cache.
CHUNK = 1 << 17


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class Powers:
    """Powers of the base and of its inverse modulo 2**64, up to a length."""

    def __init__(self, n: int, base: int = BASE) -> None:
        self.up, self.down = (np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, b, dtype=np.uint64)))) for b in (base, pow(base, -1, 1 << 64)))


def gram_hashes(codes: np.ndarray, k: int, powers: Powers) -> np.ndarray:
    """A 64-bit hash of every run of ``k`` code points (uint32 in, uint64 out)."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers.up[: len(codes)], out=total[1:])
    return _mix((total[k:] - total[:-k]) * powers.down[:n])


def _slide(x: np.ndarray, w: int, op) -> np.ndarray:
    """op over every window of ``w`` items, by doubling."""
    have = 1
    while have < w:
        step = min(have, w - have)
        x = op(x[:-step], x[step:])
        have += step
    return x


def anchors(codes: np.ndarray, k: int, w: int, powers: Powers, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the grams that are the least of some ``w`` consecutive grams.

    Two texts with a run of ``k + w - 1`` code points in common have an anchor
    of that run in common, at the same place of the run.  ``ends`` are the
    places where a text ends and the next begins; grams over them do not count.
    """
    h = gram_hashes(codes, k, powers)
    if len(h) < w:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    for b in ends[np.searchsorted(ends, 0, side="right") : np.searchsorted(ends, len(codes))]:
        h[max(b - k + 1, 0) : b] = _MOST
    least = _slide(h, w, np.minimum)
    pad = np.zeros(w - 1, dtype=np.uint64)
    reach = _slide(np.concatenate((pad, least, pad)), w, np.maximum)
    at = np.flatnonzero((h == reach) & (h != _MOST))
    return at, h[at]
