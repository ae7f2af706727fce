"""Matching blocks of many pairs of sequences at once, as the recursive longest-block method defines them.

The longest common block splits a pair in two gaps, which are split in turn; of equal blocks the first in a, then the first in
b is taken. Here all gaps of all pairs go down together: the longest common length of every gap is found by a search over
lengths, on hashes of substrings that are sorted once for all gaps; then one sweep from left to right takes every block of that
length which the recursion would take. Gaps between them hold shorter blocks only, so the levels are at most as many as
there are different lengths. From SHORT on, where most gaps end up, no length is searched for: all gaps take their blocks of
SHORT, then those of one less, and so on. Hashes only propose: blocks are compared before they count.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

import numpy as np

#: Lengths up to which gaps go down one by one.
SHORT = 8
#: Two rolling hashes, each below a prime of 31 bits.
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_000_003, 998_244_353)


def _powers(n: int, base: int, prime: int) -> np.ndarray:
    out = np.ones(1, np.int64)
    step = base
    while len(out) < n:
        out = np.concatenate([out, out * step % prime])
        step = step * step % prime
    return out[:n]


class _Hashes:
    """Hashes of any substring of one array; equal ones of both arrays agree, as they are shifted to one place."""

    def __init__(self, items: np.ndarray, powers: list[np.ndarray]) -> None:
        n = len(items)
        self.n, self.shift = n, [p[::-1] for p in powers]
        self.sums = [
            np.concatenate([np.zeros(1, np.int64), np.cumsum((items + 1) % q * p[:n] % q)]) for p, q in zip(powers, PRIMES, strict=True)
        ]

    def of(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        first, second = (
            (s[start + size] - s[start]) % q * shift[start] % q for s, shift, q in zip(self.sums, self.shift, PRIMES, strict=True)
        )
        return first << 31 | second


class _Proposals:
    """The same by one product modulo 2^64: cheaper, for matches that are compared afterwards."""

    def __init__(self, items: np.ndarray, powers: np.ndarray) -> None:
        x = (items.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        self.shift = powers[::-1]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((x ^ x >> np.uint64(32)) * powers[: len(items)])])

    def of(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.sums[start + size] - self.sums[start]) * self.shift[start]


def _met(ka: np.ndarray, kb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys of either side that the other has, and a few more: equal keys mark the same bit of a table."""
    bits = max(len(ka), len(kb), 1).bit_length() + 2
    at_a, at_b = (k >> np.uint64(64 - bits) for k in (ka, kb))
    marked = np.zeros(1 << bits, bool)
    marked[at_b] = True
    a = np.flatnonzero(marked[at_a])
    marked[:] = False
    marked[at_a[a]] = True
    return a, np.flatnonzero(marked[at_b])


def _in(keys: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Whether each key is one of those."""
    if not len(of):
        return np.zeros(len(keys), bool)
    of = np.sort(of)
    return of[np.minimum(np.searchsorted(of, keys), len(of) - 1)] == keys


def _spread(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each range its number, and its members in order."""
    counts = np.maximum(counts, 0)
    which = np.repeat(np.arange(len(starts)), counts)
    within = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    return which, starts[which] + within


class _Pairs:
    """Pairs laid end to end, with their hashes; exact ones where nothing is compared afterwards."""

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], exact: bool) -> None:
        self.a, self.b = (np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64) for x in (a, b))
        size = max(len(self.a), len(self.b)) + 1
        if exact:
            powers = [_powers(size, base, q) for base, q in zip(BASES, PRIMES, strict=True)]
            self.ha, self.hb = _Hashes(self.a, powers), _Hashes(self.b, powers)
        else:
            products = np.full(size, 0xD1342543DE82EF95, np.uint64)
            products[0] = 1
            products = np.cumprod(products)
            self.ha, self.hb = _Proposals(self.a, products), _Proposals(self.b, products)
        self.sizes_a, self.sizes_b = (np.array([len(v) for v in x], np.int64) for x in (a, b))
        self.from_a, self.from_b = (np.cumsum(s) - s for s in (self.sizes_a, self.sizes_b))

    def keys(self, hashes: _Hashes | _Proposals, lo: np.ndarray, hi: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gap, start and key of every substring of a gap's size in its range."""
        gap, start = _spread(lo, hi - lo - size + 1)
        mixed = hashes.of(start, size[gap]).astype(np.uint64, copy=False) ^ gap.astype(np.uint64) * np.uint64(0x1F123BB5159A55E5)
        return gap, start, (mixed ^ mixed >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)  # one to one

    def longest(self, alo: np.ndarray, ahi: np.ndarray, blo: np.ndarray, bhi: np.ndarray, most: np.ndarray, least: int = 0) -> np.ndarray:
        """The greatest size, up to most, of a substring that each gap has on both sides; least where none is longer than that."""
        lo = np.full(len(alo), least, np.int64)
        hi = np.minimum(np.minimum(ahi - alo, bhi - blo), most)
        failed = np.zeros(len(alo), bool)
        step = np.maximum(least + 1, 4)
        while True:
            at = np.flatnonzero(lo < hi)
            if not len(at):
                return lo
            middle = np.where(failed[at], (lo[at] + hi[at] + 1) // 2, np.minimum(np.maximum(2 * lo[at] - least + 1, step), hi[at]))
            _, _, kb = self.keys(self.hb, blo[at], bhi[at], middle)
            gap, _, ka = self.keys(self.ha, alo[at], ahi[at], middle)
            there = np.zeros(len(at), bool)
            in_a, in_b = _met(ka, kb)
            there[gap[in_a[_in(ka[in_a], kb[in_b])]]] = True
            lo[at] = np.where(there, middle, lo[at])
            hi[at] = np.where(there, hi[at], middle - 1)
            failed[at] |= ~there


def _everything(pairs: _Pairs) -> tuple[np.ndarray, ...]:
    n = np.full(len(pairs.sizes_a), np.iinfo(np.int64).max)
    return pairs.from_a, pairs.from_a + pairs.sizes_a, pairs.from_b, pairs.from_b + pairs.sizes_b, n


def longest_blocks(a: Sequence[np.ndarray], b: Sequence[np.ndarray]) -> list[int]:
    """Length of the longest common substring of each pair."""
    pairs = _Pairs(list(a), list(b), exact=True)
    return pairs.longest(*_everything(pairs)).tolist()


def matching_blocks(a: Sequence[np.ndarray], b: Sequence[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """For each pair of integer arrays its blocks (start in a, start in b, size) in order; neighbours are not joined."""
    pairs = _Pairs(list(a), list(b), exact=False)
    left, right = pairs.a.tobytes(), pairs.b.tobytes()
    found: list[list[tuple[int, int, int]]] = [[] for _ in pairs.sizes_a]
    most = lambda gaps: np.minimum(np.minimum(gaps[:, 2] - gaps[:, 1], gaps[:, 4] - gaps[:, 3]), gaps[:, 5])

    def taken(gaps: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The gaps that are left when each gives its blocks of its size, than which it has none longer."""
        ga, pa, ka = pairs.keys(pairs.ha, gaps[:, 1], gaps[:, 2], size)
        _, pb, kb = pairs.keys(pairs.hb, gaps[:, 3], gaps[:, 4], size)
        in_a, in_b = _met(ka, kb)
        ga, pa, ka, pb, kb = ga[in_a], pa[in_a], ka[in_a], pb[in_b], kb[in_b]
        order = np.argsort(kb, kind="stable")
        kb, pb = kb[order], pb[order].tolist()
        first = np.searchsorted(kb, ka, "left")
        hit = np.flatnonzero(kb[np.minimum(first, len(kb) - 1)] == ka) if len(kb) else np.zeros(0, np.int64)
        which, starts = np.unique(ga[hit], return_index=True)
        starts = [*starts.tolist(), len(hit)]
        last = np.searchsorted(kb, ka[hit], "right").tolist()
        pa, first = pa[hit].tolist(), first[hit].tolist()
        below: list[tuple[int, int, int, int, int, int]] = []
        bounds = zip(gaps[which, :5].tolist(), size[which].tolist(), starts, starts[1:])
        for (pair, x, xe, y, ye), k, place, stop in bounds:
            while place < stop:
                i = pa[place]
                at = bisect_left(pb, y, first[place], last[place])
                while at < last[place] and left[8 * i : 8 * (i + k)] != right[8 * pb[at] : 8 * (pb[at] + k)]:
                    at += 1
                if at == last[place]:
                    place += 1
                    continue
                j = pb[at]
                found[pair].append((i, j, k))
                if x < i and y < j:
                    below.append((pair, x, i, y, j, k - 1))
                x, y = i + k, j + k
                place = bisect_left(pa, x, place, stop)
            if x < xe and y < ye:
                below.append((pair, x, xe, y, ye, k - 1))
        rest = np.ones(len(gaps), bool)
        rest[which] = False
        without = gaps[rest]
        without[:, 5] = size[rest] - 1
        return np.concatenate([without, np.array(below, np.int64).reshape(-1, 6)])

    long = np.column_stack([np.arange(len(found)), *_everything(pairs)])
    short = []
    while len(long):
        size = pairs.longest(*long[:, 1:].T, least=SHORT)
        over = size > SHORT
        short.append(long[~over])
        split = taken(long[over], size[over])
        over = most(split) > SHORT
        short.append(split[~over])
        long = split[over]
    gaps = np.concatenate([np.zeros((0, 6), np.int64), *short])
    for k in range(SHORT, 0, -1):
        live = most(gaps) >= k
        gaps = np.concatenate([gaps[~live], taken(gaps[live], np.full(int(live.sum()), k))])
    return [
        sorted((i - int(p), j - int(q), k) for i, j, k in blocks)
        for blocks, p, q in zip(found, pairs.from_a, pairs.from_b, strict=True)
    ]


def opcodes(blocks: list[tuple[int, int, int]], n: int, m: int) -> list[tuple[str, int, int, int, int]]:
    """(what, start and end in a, start and end in b): equal, replace, delete and insert, covering both sequences."""
    out: list[tuple[str, int, int, int, int]] = []
    x = y = 0
    for i, j, k in [*blocks, (n, m, 0)]:
        if x < i or y < j:
            out.append(("replace" if x < i and y < j else "delete" if x < i else "insert", x, i, y, j))
        if k:
            if out and out[-1][0] == "equal":
                out[-1] = ("equal", out[-1][1], i + k, out[-1][3], j + k)
            else:
                out.append(("equal", i, i + k, j, j + k))
        x, y = i + k, j + k
    return out


def letters(text: str | None) -> np.ndarray:
    """Code points; null is empty."""
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")
