"""SetSketch registers, their bands, and the likelihood of a similarity.

A register is `floor(1 - log_b x)` of the smallest `x` that an element of the set puts
there, cut to the range of the registers. An element's points ascend: the j-th lies in
the j-th of m intervals of equal weight under the exponential distribution, in a
register of its own. So no point of a later round can change a register that an earlier
round has filled, and a set is done as soon as all its registers are. The registers of a
union are the element-wise maxima.
"""

from __future__ import annotations

import numpy as np

from docsift.llm.pretoken import mix

BASE = 1.001  # of the exponential spacing
RATE = 20.0
TOP = (1 << 16) - 1  # largest register


def spacing(m: int) -> np.ndarray:
    """Bounds of the m intervals; the last is open."""
    j = np.arange(m)
    return np.append(np.log1p(j / (m - j)) / RATE, np.inf)


def registers(sets: list[np.ndarray], m: int) -> np.ndarray:
    """Registers (rows: sets; uint16) of sets of 64-bit hashes; an empty set has zeros. `m` is prime."""
    out = np.zeros((len(sets), m), np.int32)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = out.reshape(-1)
    row = np.repeat(np.arange(len(sets)), sizes)
    item = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    bounds = spacing(m)
    with np.errstate(over="ignore"):
        seed = mix(item ^ np.uint64(0xD6E8FEB86659FD93))
        at = (seed % np.uint64(m)).astype(np.int64)
        step = 1 + ((seed >> np.uint64(20)) % np.uint64(m - 1)).astype(np.int64)
        for j in range(m):
            if not len(item):
                break
            uniform = ((mix(item + np.uint64(j + 1) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)) + 0.5) / (1 << 53)
            weight = -np.expm1(-RATE * (bounds[j + 1] - bounds[j]))
            x = bounds[j] - np.log1p(-uniform * weight) / RATE
            value = np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, TOP).astype(np.int32)
            np.maximum.at(flat, row * m + at, value)
            open_rows = (out == 0).any(axis=1)
            go_on = open_rows[row]
            row, item, step = row[go_on], item[go_on], step[go_on]
            at = (at[go_on] + step) % m
    return out.astype(np.uint16)


def similarity(one: np.ndarray, two: np.ndarray, n_one: np.ndarray, n_two: np.ndarray, floor: float, slack: float = 18.0):
    """Joint maximum-likelihood estimates of the Jaccard similarity of pairs of registers
    (rows), given the set sizes, and whether a similarity of `floor` or more is possible: its
    log-likelihood lies within `slack` of the maximum."""
    m = one.shape[1]
    more = (one > two).sum(axis=1)[:, None]
    less = (one < two).sum(axis=1)[:, None]
    u = (n_one / (n_one + n_two))[:, None]
    v = 1 - u
    # Whole numbers divided once: a set of exactly `floor` of the other's size reaches `floor`.
    most = (np.minimum(n_one, n_two) / np.maximum(n_one, n_two))[:, None]
    grid = np.minimum(np.linspace(0, 1, 201)[None, :], most)

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    up, down = p(u - v * grid), p(v - u * grid)
    tiny = 1e-12
    score = (
        more * np.log(up + tiny) + less * np.log(down + tiny) + (m - more - less) * np.log(np.maximum(1 - up - down, tiny))
    )
    best = score.argmax(axis=1)
    high = np.where(grid >= floor, score, -np.inf).max(axis=1)
    return grid[np.arange(len(grid)), best], high >= score.max(axis=1) - slack
