"""SetSketch registers of many sets at once, and the joint likelihood of two sketches.

Element ``d`` gives register ``p(j)`` of its own permutation the value ``x_j`` of its j-th
stratum: ``exp(-a x_j)`` is uniform between ``(m - j) / m`` and ``(m - j + 1) / m``, so the
values ascend. A register keeps the least value over all elements, truncated to
``K = floor(1 - log_b x)`` within 0 and ``Q + 1``: exponentially spaced steps in one byte.
The registers of a union are the maxima of the parts' registers.
"""

from __future__ import annotations

import numpy as np

from spendwatch.llm.shingles import mixed

REGISTERS = 128
BASE = 1.1
RATE = 20.0
Q = 254
_LOG_BASE = np.log(BASE)


def _steps(x: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(1.0 - np.log(x) / _LOG_BASE), 0, Q + 1).astype(np.uint8)


#: K of the least value that stratum j can hold; no stratum from j on can raise a register at or above it.
_BOUND = np.concatenate(
    ([Q + 1], _steps(-np.log1p(-np.arange(1, REGISTERS) / REGISTERS) / RATE), [0])
)


def sketches(elements: np.ndarray, owner: np.ndarray, sets: int) -> np.ndarray:
    """Registers (sets x REGISTERS, uint8). ``elements``: 64-bit hashes; ``owner``: ascending number of each one's set."""
    m = REGISTERS
    registers = np.zeros((sets, m), np.uint8)
    flat = registers.reshape(-1)
    seed = mixed(elements + np.uint64(0x632BE59BD9B4E019))
    first = (seed & np.uint64(m - 1)).astype(np.int64)
    stride = ((seed >> np.uint64(16)) | np.uint64(1)).astype(np.int64) & (m - 1)
    base = owner.astype(np.int64) * m
    for j in range(1, m + 1):
        u = (mixed(seed + np.uint64(j * 0x9E3779B97F4A7C15 % 2**64)) >> np.uint64(11)) * 2.0**-53
        x = -np.log1p(-(j - u) / m) / RATE if j < m else -np.log((1.0 - (j - 1) / m) * np.maximum(u, 2.0**-53)) / RATE
        np.maximum.at(flat, base + ((first + j * stride) & (m - 1)), _steps(np.maximum(x, 1e-300)))
        if j == m:
            break
        open_sets = registers.min(axis=1) < _BOUND[j]
        if not open_sets.any():
            break
        if not open_sets.all():
            live = open_sets[base // m]
            if not live.all():
                seed, first, stride, base = seed[live], first[live], stride[live], base[live]
        if not len(seed):
            break
    return registers


_GRID = np.linspace(0.0, 1.0, 101)


def _p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0.0, 1.0) * (BASE - 1.0) / BASE) / _LOG_BASE


def estimated(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard of pairs of sketches with known set sizes.

    The counts of registers where either is ahead or both are equal are jointly multinomial in the similarity.
    """
    ahead = (a > b).sum(axis=1)[:, None]
    behind = (a < b).sum(axis=1)[:, None]
    equal = a.shape[1] - ahead - behind
    u = (size_a / (size_a + size_b))[:, None]
    v = 1.0 - u
    j = _GRID[None, :] * np.minimum(u / v, v / u)
    plus, minus = _p(u - v * j), _p(v - u * j)
    tiny = 1e-12
    like = (
        ahead * np.log(np.maximum(plus, tiny))
        + behind * np.log(np.maximum(minus, tiny))
        + equal * np.log(np.maximum(1.0 - plus - minus, tiny))
    )
    return np.take_along_axis(j, like.argmax(axis=1)[:, None], axis=1)[:, 0]
