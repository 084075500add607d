"""MinHash signatures, shared by the near-duplicate operators."""

from __future__ import annotations

import numpy as np
import xxhash



def coefficients(n: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """``n`` random functions x -> a x + b modulo 2^64, whose upper halves are universal for items below 2^32."""
    rng = np.random.default_rng(seed)
    return rng.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def hash31(item: str) -> int:
    """A stable hash of an item below 2^31 - 1."""
    return xxhash.xxh64_intdigest(item) % ((1 << 31) - 1)


def signatures(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, block: int = 500) -> np.ndarray:
    """One row of minima (their upper 32 bits) for each non-empty set of item hashes (uint64 below 2^32)."""
    out = np.zeros((len(sets), len(a)), np.uint32)
    for at in range(0, len(sets), block):
        part = sets[at : at + block]
        size = np.array([len(s) for s in part])
        flat, begin = np.concatenate(part).astype(np.uint64), np.cumsum(size) - size
        x = np.empty_like(flat)
        for j in range(len(a)):
            np.multiply(flat, a[j], out=x)
            x += b[j]
            out[at : at + block, j] = np.minimum.reduceat(x, begin) >> np.uint64(32)
    return out


def shingles(words: list[str], size: int = 5) -> set[str]:
    """Runs of ``size`` words; a shorter text is one shingle."""
    return {" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()
