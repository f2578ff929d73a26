"""Words of a text as numpy arrays: where they start, where they end, their hashes."""

from __future__ import annotations

import numpy as np

_PIECE = 1 << 20
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)

#: ASCII letters and digits (lower-cased) and all bytes of other characters
#: belong to words; what is left separates them.
_FOLD = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in bytes(range(256)).lower())


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    k = 1
    while k < n:
        out[k:2 * k] = out[:len(out[k:2 * k])] * np.uint64(pow(base, k, 1 << 64))
        k *= 2
    return out


_UP, _DOWN = _powers(_BASE, 1 << 16), _powers(_INVERSE, 1 << 16)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * _MIX
    return (h ^ (h >> np.uint64(29))) * _MIX2


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of values[start:end], the same wherever the run stands."""
    n = len(values)
    up, down = (_UP, _DOWN) if n < len(_UP) else (_powers(_BASE, n + 1), _powers(_INVERSE, n + 1))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:n], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_table(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes) of the words, as byte offsets into ``text``.
    Long texts go through in pieces that end between words."""
    folded = text.translate(_FOLD)
    found, at, n = [], 0, len(folded)
    while at < n:
        end = min(n, at + _PIECE)
        if end < n:
            gap = folded.rfind(b" ", at, end)
            end = gap + 1 if gap >= 0 else (folded.find(b" ", end) + 1 or n)
        data = np.frombuffer(folded, np.uint8, end - at, at)
        edge = np.diff(np.concatenate(([0], (data != 32).view(np.int8), [0])))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        found.append((starts + at, ends + at, _sums(data.astype(np.uint64), starts, ends)))
        at = end
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


def run_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run of word hashes."""
    return _sums(hashes, starts, ends)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; fewer words make one run of all."""
    n = len(hashes)
    if not n:
        return hashes
    starts = np.arange(max(1, n - size + 1))
    return run_hashes(hashes, starts, np.minimum(starts + size, n))
