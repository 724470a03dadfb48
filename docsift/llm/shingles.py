"""Sets of word shingles as 64-bit hashes, found with array arithmetic.

Words are what lies between white space (blank, tab to carriage return) after A-Z became
a-z. A shingle is `size` consecutive words; a text of fewer words has one shingle, the
whole of it; a text without words has none. Two different shingles share a hash with a
chance of 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from docsift.llm.pretoken import Hasher, chunked, mix

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_hasher = Hasher(256, seed=3)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, text after text, and how many each text has."""
    counts = np.zeros(len(texts), np.int64)
    out = []
    for numbers, group in chunked(texts):
        parts = [t.encode() for t in group]
        data = np.frombuffer((b" ".join(parts) + b" ").translate(_LOWER), np.uint8)
        solid = ~_BLANK[data]
        edges = np.flatnonzero(np.diff(solid.astype(np.int8), prepend=0))
        starts, ends = edges[::2], edges[1::2]
        out.append(_hasher(data, starts, ends))
        upto = np.cumsum([len(p) + 1 for p in parts])
        np.add.at(counts, numbers, np.diff(np.searchsorted(starts, upto), prepend=0))
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), counts


def shingle_sets(texts: list[str], size: int) -> Iterator[np.ndarray]:
    """The set of every text, ascending."""
    words, counts = word_hashes(texts)
    factors = [np.uint64((0x9E3779B97F4A7C15 * (2 * i + 3) | 1) & ((1 << 64) - 1)) for i in range(size)]
    with np.errstate(over="ignore"):
        whole = len(words) - size + 1
        rolled = np.zeros(max(0, whole), np.uint64)
        for i, f in enumerate(factors):
            rolled += words[i : i + len(rolled)] * f
        rolled = mix(rolled)
        end = 0
        for n in counts.tolist():
            begin, end = end, end + n
            if n >= size:
                yield np.unique(rolled[begin : end - size + 1])
            elif n:
                short = np.array([n], np.uint64)
                for w, f in zip(words[begin:end], factors, strict=False):
                    short += w * f
                yield mix(mix(short))
            else:
                yield np.zeros(0, np.uint64)


def set_key(found: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share, as two signed integers."""
    with np.errstate(over="ignore"):
        one, two = mix(found).sum(), mix(found ^ np.uint64(0x5851F42D4C957F2D)).sum()
    return int(one.astype(np.int64)), int(two.astype(np.int64))
