"""Pre-token boundaries of the byte-level BPE pattern, found with array arithmetic.

The public pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
only looks at three character classes, so its matches are the runs of one class, with
two amendments: a space before a run belongs to it, and a run that is one apostrophe
takes the letters of a contraction. The classes come from the library that will encode
the pieces, so both follow the same Unicode version.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

LETTER, NUMBER, SPACE, OTHER, EDGE = 0, 1, 2, 3, 4
_GAP = re.compile(r"\S(?=[ \n])")
_MASK = (1 << 64) - 1
_PRIME = 0x9E3779B97F4A7C15 | 1


def _all_chars() -> str:
    # Unicode has no letter, number or space beyond plane 3.
    return "".join(map(chr, [*range(1, 0xD800), *range(0xE000, 0x40000)]))


def classes_of(members) -> np.ndarray:
    """Class of every code point; `members(pattern)` gives the characters the encoding
    library counts as matching `pattern`."""
    out = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        found = np.frombuffer(members(pattern).encode("utf-32-le"), np.uint32)
        out[found] = kind
    return out


def tiktoken_classes() -> np.ndarray:
    import tiktoken

    ranks = {bytes([i]): i for i in range(256)}

    def members(pattern: str) -> str:
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return probe.decode(probe.encode_ordinary(_all_chars()))

    return classes_of(members)


def tokenizers_classes() -> np.ndarray:
    from tokenizers import Regex, pre_tokenizers

    chars = _all_chars()

    def members(pattern: str) -> str:
        split = pre_tokenizers.Split(Regex(pattern + "+"), "removed")
        rest = split.pre_tokenize_str(chars)
        keep = np.ones(len(chars), bool)
        for _, (start, end) in rest:
            keep[start:end] = False
        return "".join(c for c, k in zip(chars, keep, strict=True) if k)

    return classes_of(members)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """64-bit hashes of many slices of one array of small symbols, by prefix sums of a
    polynomial modulo 2**64; the inverse powers shift every slice to the same origin."""

    def __init__(self, n_symbols: int, seed: int = 1):
        with np.errstate(over="ignore"):
            self.value = mix(np.arange(1, n_symbols + 1, dtype=np.uint64) * np.uint64((seed * _PRIME) & _MASK))
        self.base = pow(6364136223846793005, seed, 1 << 64) | 1
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            size = max(n, 2 * len(self.powers), 1 << 16)
            with np.errstate(over="ignore"):
                for name, base in (("powers", self.base), ("inverse", pow(self.base, -1, 1 << 64))):
                    steps = np.full(size, base, np.uint64)
                    steps[0] = 1
                    setattr(self, name, np.multiply.accumulate(steps))

    def __call__(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._grow(len(symbols) + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(len(symbols) + 1, np.uint64)
            np.cumsum(self.value[symbols] * self.powers[: len(symbols)], out=sums[1:])
            return mix((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


def starts_of(points: np.ndarray, classes: np.ndarray, doc_ends: np.ndarray) -> np.ndarray:
    """Positions where pieces begin. `points` holds the code points of several texts,
    each followed by one zero; `doc_ends` holds the positions of those zeros, which
    come out as pieces of their own."""
    n = len(points)
    kind = classes[points]
    kind[doc_ends] = EDGE
    first = np.empty(n, bool)
    first[0] = True
    np.not_equal(kind[1:], kind[:-1], out=first[1:])
    after_edge = doc_ends[:-1] + 1
    first[doc_ends] = True
    first[after_edge] = True
    # The last white space before a run: a blank joins the run, another is a piece.
    run_starts = np.flatnonzero(first & (kind != SPACE) & (kind != EDGE))
    before = run_starts - 1
    led = (before >= 0) & (kind[before] == SPACE)
    blanks = before[led]
    first[blanks] = True
    joined = points[blanks] == 32
    first[run_starts[led][joined]] = False
    # One apostrophe that begins a piece, then the letters of a contraction.
    marks = np.flatnonzero(points == 39)
    if len(marks):
        marks = marks[first[marks]]
        padded = np.concatenate([points, np.zeros(3, points.dtype)])
        one, two = padded[marks + 1], padded[marks + 2]
        short = np.isin(one, [115, 116, 109, 100])
        long = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
        size = np.where(short, 2, np.where(long, 3, 0))
        marks, size = marks[size > 0], size[size > 0]
        first[marks + 1] = False
        rest = marks + size
        inside = kind[rest] == LETTER
        first[rest[inside]] = True
    return np.flatnonzero(first)


def segments(texts: list[str], limit: int = 1 << 19) -> Iterator[tuple[int, str]]:
    """Texts with their number, cut where a piece is sure to begin: before white space
    that follows something else. A run without such a place stays whole."""
    for i, text in enumerate(texts):
        begin = 0
        while len(text) - begin > limit:
            cut = _GAP.search(text, begin + limit)
            if cut is None:
                break
            yield i, text[begin : cut.start() + 1]
            begin = cut.start() + 1
        yield i, text[begin:]


def chunked(texts: list[str], limit: int = 1 << 19) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Segments in groups of about `limit` characters, with the numbers of their texts."""
    numbers: list[int] = []
    group: list[str] = []
    size = 0
    for i, text in segments(texts, limit):
        if size and size + len(text) > limit:
            yield np.array(numbers), group
            numbers, group, size = [], [], 0
        numbers.append(i)
        group.append(text)
        size += len(text) + 1
    if group:
        yield np.array(numbers), group


def pieces(texts: list[str], classes: np.ndarray, hasher: Hasher):
    """Pieces of the texts: (joined string, starts, ends, hashes, pieces per text)."""
    joined = "\0".join(texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    doc_ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) - 1
    starts = starts_of(points, classes, doc_ends)
    ends = np.append(starts[1:], len(points))
    edge = np.searchsorted(starts, doc_ends)
    counts = np.diff(edge, prepend=-1) - 1
    keep = np.ones(len(starts), bool)
    keep[edge] = False
    starts, ends = starts[keep], ends[keep]
    return joined, starts, ends, hasher(points, starts, ends), counts


def ragged(offsets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions offset .. offset + size of every row, one row after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(offsets - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class PieceCache:
    """Ids of pieces, kept by a 64-bit hash in a direct-mapped table of bounded size.

    `encode` gets a list of distinct pieces and returns their id lists. A piece whose
    slot another has taken is encoded again. Two pieces share a hash with a chance of
    2**-63 a pair.
    """

    def __init__(self, encode, slots: int = 1 << 20, pool: int = 1 << 23):
        self.encode, self.limit = encode, pool
        self.mask = np.uint64(slots - 1)
        self.keys = np.zeros(slots, np.uint64)
        self.offset = np.zeros(slots, np.int64)
        self.size = np.zeros(slots, np.int32)
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def lookup(self, joined: str, starts, ends, hashes) -> tuple[np.ndarray, np.ndarray]:
        """Offset into `pool` and number of ids of every piece; valid until the next call."""
        if self.used > self.limit:
            self.keys[:] = 0
            self.used = 0
        hashes = hashes | np.uint64(1)
        slot = (hashes >> np.uint64(1)) & self.mask
        offset, size = self.offset[slot], self.size[slot]
        missed = np.flatnonzero(self.keys[slot] != hashes)
        if len(missed):
            new, first, back = np.unique(hashes[missed], return_index=True, return_inverse=True)
            at = missed[first]
            ids = self.encode([joined[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
            sizes = np.fromiter(map(len, ids), np.int32, len(ids))
            flat = np.fromiter((x for one in ids for x in one), np.uint32, int(sizes.sum()))
            offsets = self.used + np.cumsum(sizes) - sizes
            if self.used + len(flat) > len(self.pool):
                self.pool = np.concatenate([self.pool[: self.used], np.zeros(2 * (self.used + len(flat)), np.uint32)])
            self.pool[self.used : self.used + len(flat)] = flat
            self.used += len(flat)
            offset[missed], size[missed] = offsets[back], sizes[back]
            to = slot[at]
            self.keys[to], self.offset[to], self.size[to] = new, offsets, sizes
        return offset, size
