"""SetSketch registers as numpy arrays: exponentially spaced, truncated minima of a set's hashes.

Register i of a set is clamp(floor(1 - log_b(x_i)), 0, q + 1), where x_i is the minimum over the set of values that are
exponentially distributed with rate ``a``. The register-wise maximum of two sketches is the sketch of the union, so
sketches merge; and equal registers are the likelier the more alike two sets are, so bands of registers make candidates.
"""

from __future__ import annotations

import numpy as np

from stratafile.llm.words import U64, mixed

#: Base, rate and largest register value: registers fit 16 bits, and at this base unrelated sets rarely share one.
B, A, Q = 1.001, 20.0, (1 << 16) - 2
BANDS, ROWS = 52, 5
REGISTERS = BANDS * ROWS

#: Words of 64 low register bits that tell close pairs of a bucket apart, from a longer sketch of the few documents that
#: need it; and how many may differ: a pair of similarity 0.75 has 256 that do, with a deviation of 15.
BIT_WORDS, MAX_BITS = 32, 331

_XORS = mixed(np.arange(1, 64 * BIT_WORDS + 1, dtype=U64), 11)
_MULTIPLIERS = mixed(np.arange(1, 64 * BIT_WORDS + 1, dtype=U64), 13) | U64(1)


def registers(hashes: np.ndarray, starts: np.ndarray, count: int = REGISTERS) -> np.ndarray:
    """Sketches of consecutive, non-empty sets of 64-bit hashes; set i begins at starts[i]. Repeats change nothing."""
    out = np.empty((len(starts), count), np.uint16)
    scratch = np.empty_like(hashes)
    for i in range(count):
        np.bitwise_xor(hashes, _XORS[i], out=scratch)
        np.multiply(scratch, _MULTIPLIERS[i], out=scratch)
        least = np.minimum((np.minimum.reduceat(scratch, starts).astype(np.float64) + 0.5) / 2.0**64, 1 - 2.0**-53)
        x = -np.log1p(-least) / A  # the minimum of exponential values, by inversion
        out[:, i] = np.clip(np.floor(1.0 - np.log(x) / np.log(B)), 0, Q + 1)
    return out


def merged(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(u, v)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of register values, distinct between bands."""
    wide = sketches.astype(U64).reshape(len(sketches), BANDS, ROWS)
    key = np.zeros((len(sketches), BANDS), U64)
    for r in range(ROWS):
        key = (key << U64(16)) | wide[:, :, r]
    return mixed(key ^ mixed(np.arange(BANDS, dtype=U64), 17)[None, :], 19)


def low_bits(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The lowest bits of a long sketch, in words: those of two sets differ in (1 - J) / 2 of the places."""
    return np.packbits((registers(hashes, starts, 64 * BIT_WORDS) & 1).astype(np.uint8), axis=1).view("<i8")


def _p(x: np.ndarray) -> np.ndarray:
    """-log_b(1 - x (b - 1) / b): the chance that one register is above the other, by the share of own elements."""
    return -np.log1p(-x * (B - 1) / B) / np.log(B)


def log_likelihood(j: np.ndarray, n_u: np.ndarray, n_v: np.ndarray, above: np.ndarray, below: np.ndarray, equal: np.ndarray) -> np.ndarray:
    """Of similarity j, given both sizes and how many registers of u are above, below or equal to those of v."""
    u, v = n_u / (n_u + n_v), n_v / (n_u + n_v)
    j = np.minimum(j, np.minimum(u / v, v / u))
    up, down = _p(np.maximum(u - v * j, 1e-12)), _p(np.maximum(v - u * j, 1e-12))
    return above * np.log(up) + below * np.log(down) + equal * np.log(np.maximum(1 - up - down, 1e-12))


def plausible(threshold: float, n_u: np.ndarray, n_v: np.ndarray, u: np.ndarray, v: np.ndarray, z: float = 5.0) -> np.ndarray:
    """Pairs whose sizes allow the threshold and whose registers don't rule it out: the joint likelihood at the threshold
    isn't worse than the best one below it by more than z standard errors (z = 5: three in 10**7 of true pairs)."""
    above, below = (u > v).sum(1), (u < v).sum(1)
    equal = u.shape[1] - above - below
    n_u, n_v = n_u.astype(float), n_v.astype(float)
    at = log_likelihood(np.full(len(n_u), threshold), n_u, n_v, above, below, equal)
    best = at.copy()
    for j in np.linspace(0.0, threshold, 31)[:-1]:
        best = np.maximum(best, log_likelihood(np.full(len(n_u), j), n_u, n_v, above, below, equal))
    sizes = np.minimum(n_u, n_v) >= threshold * np.maximum(n_u, n_v) - 1e-9
    return sizes & (2 * (best - at) <= z * z)
