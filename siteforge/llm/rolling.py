"""Rolling hashes of byte and word strings, and minima of windows."""
from __future__ import annotations

import numpy as np

_R = np.uint64(0x9E3779B97F4A7C15)
_RINV = np.uint64(pow(int(_R), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("r", ())) < n:
        for name, base in (("r", _R), ("inv", _RINV)):
            p = np.full(max(n, 1 << 17), base, dtype=np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["r"][:n], _POWERS["inv"][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def gram_hashes(b: np.ndarray, k: int) -> np.ndarray:
    """Mixed 64-bit hash of each k-gram of bytes."""
    r, inv = powers(len(b))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * r)])
    return mixed((total[k:] - total[:-k]) * inv[: len(b) - k + 1])


def window_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w neighbouring values, in linear time."""
    n = len(v) - w + 1
    padded = np.concatenate([v, np.full(-len(v) % w, np.iinfo(v.dtype).max, v.dtype)]).reshape(-1, w)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])
