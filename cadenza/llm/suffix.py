"""Suffix arrays by induced sorting, and what they need to find repeated strings, on numpy arrays.

Positions are classified as S or L, leftmost S positions (LMS) cut the text into substrings, these are sorted by one round of
induction and named, the string of names is ranked, and a second round induces the whole array from the LMS order. A round
takes each bucket of a first byte in waves: every wave is a few array operations, and a position is touched once.
Names are ranked by the same recursion, a level refined run by run: they have too many values to go bucket by bucket.
"""

from __future__ import annotations

import numpy as np


def s_types(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each suffix is smaller than the one after it (the empty suffix is the smallest of all), and how many equal
    letters follow on from each position, itself included."""
    n = len(text)
    starts = np.concatenate([[0], np.flatnonzero(text[1:] != text[:-1]) + 1])
    ends = np.append(starts[1:], n)
    rising = np.append(text[starts[:-1]] < text[starts[1:]], False)
    return np.repeat(rising, ends - starts), np.repeat(ends, ends - starts) - np.arange(n)


def _deal(buckets: list[list[np.ndarray]], items: np.ndarray, keys: np.ndarray) -> None:
    """Append items to the buckets of their keys, in order."""
    if not len(items):
        return
    order = np.argsort(keys, kind="stable")
    items, keys = items[order], keys[order]
    ends = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    start = 0
    for end in [*ends.tolist(), len(items)]:
        buckets[keys[start]].append(items[start:end])
        start = end


def _join(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, np.int32)


def induce(text: np.ndarray, is_s: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All positions sorted by induction from LMS positions, which stand in their order within each first byte."""
    n = len(text)
    seeds: list[list[np.ndarray]] = [[] for _ in range(256)]
    _deal(seeds, lms, text[lms])
    large: list[list[np.ndarray]] = [[] for _ in range(256)]
    large[text[n - 1]].append(np.asarray([n - 1], np.int32))
    for c in range(256):
        done = 0
        while done < len(large[c]):
            wave = _join(large[c][done:])
            done = len(large[c])
            before = wave[wave > 0] - 1
            before = before[~is_s[before]]
            _deal(large, before, text[before])
        before = _join(seeds[c])
        before = before[before > 0] - 1
        _deal(large, before, text[before])
    small: list[list[np.ndarray]] = [[] for _ in range(256)]  # each from its end backwards
    for c in range(255, -1, -1):
        done = 0
        while done < len(small[c]):
            wave = _join(small[c][done:])
            done = len(small[c])
            before = wave[wave > 0] - 1
            before = before[is_s[before]]
            _deal(small, before, text[before])
        wave = _join(large[c])[::-1]
        before = wave[wave > 0] - 1
        before = before[is_s[before]]
        _deal(small, before, text[before])
    return np.concatenate([x for c in range(256) for x in (_join(large[c]), _join(small[c])[::-1])])


def _names(text: np.ndarray, order: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For LMS substrings in sorted order, each ending with the next LMS position: whether it differs from the one before."""
    a, b = order[:-1], order[1:]
    la, lb = ends[a] - a, ends[b] - b
    differs = la != lb
    live = np.flatnonzero(~differs)
    k = 0
    while len(live):
        x, y = a[live] + k, b[live] + k
        inside = k <= la[live]
        x, y, live = x[inside], y[inside], live[inside]
        ok = (x < len(text)) & (y < len(text))
        unequal = np.ones(len(live), bool)
        unequal[ok] = text[x[ok]] != text[y[ok]]
        differs[live[unequal]] = True
        live = live[~unequal]
        k += 1
    return np.concatenate([[True], differs])


def _refined(
    at: np.ndarray, key: np.ndarray, runs: np.ndarray, last: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Positions sorted by the keys of their own and of the following runs, and for each place the first of its equals.

    key ends with -1, the end of the text. A position's keys end with the next one marked in last; without it they go on
    until they differ.
    """
    at = at[np.argsort(key[at], kind="stable")]
    live, group, here, first = np.arange(len(at)), np.zeros(len(at), np.int64), at.copy(), True
    while len(live):
        k, own = key[here], group[live]
        fresh = np.ones(len(live), bool)
        fresh[1:] = (k[1:] != k[:-1]) | (own[1:] != own[:-1])
        group[live] = live[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        tied = ~(fresh & np.append(fresh[1:], True))
        if last is not None and not first:
            tied &= ~last[here]
        live, here, first = live[tied], here[tied], False
        here = here + runs[here]
        order = np.lexsort((key[here], group[live]))
        at[live], here = at[live][order], here[order]
    return at, group


def _sort_names(text: np.ndarray) -> np.ndarray:
    """Positions of a string of names in the order of their suffixes; LMS substrings are named and sorted recursively."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    is_s, runs = s_types(text)
    is_lms = np.zeros(n + 1, bool)
    is_lms[1:n] = is_s[1:] & ~is_s[:-1]
    lms = np.flatnonzero(is_lms)
    # keys of a letter: L by run, the shorter first, then S, the longer first; an order already known takes a run's place
    first = text.astype(np.int64) * (2 * n + 2)
    key = np.append(first + np.where(is_s, 2 * n + 1 - runs, runs), -1)
    if len(lms) > 1:
        order, group = _refined(lms, key, runs, is_lms)
        fresh = np.append(False, np.diff(group) > 0)
        if not fresh[1:].all():
            names = np.zeros(n, np.int64)
            names[order] = np.cumsum(fresh)
            order = lms[_sort_names(names[lms])]
        lms = order
    with_lms = key.copy()
    with_lms[lms] = first[lms] + n + 1 + np.arange(len(lms))
    large, _ = _refined(np.flatnonzero(~is_s), with_lms, runs)
    key[large] = first[large] + np.arange(len(large))
    small, _ = _refined(np.flatnonzero(is_s), key, runs)
    both = np.concatenate([large, small])
    return both[np.argsort(text[both], kind="stable")]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of a byte array in the order of their suffixes."""
    n = len(text)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    is_s, _ = s_types(text)
    is_lms = np.zeros(n, bool)
    is_lms[1:] = is_s[1:] & ~is_s[:-1]
    lms = np.flatnonzero(is_lms).astype(np.int32)
    if len(lms) > 1:
        order = induce(text, is_s, lms)
        order = order[is_lms[order]]
        ends = np.zeros(n, np.int32)
        ends[lms] = np.concatenate([lms[1:], [n]])
        names = np.zeros(n, np.int32)
        names[order] = np.cumsum(_names(text, order, ends)) - 1
        lms = order if names[order[-1]] == len(lms) - 1 else lms[_sort_names(names[lms])]
    return induce(text, is_s, lms)


def common_prefixes(text: np.ndarray, array: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Permuted common prefixes: of each position with its predecessor in the array, and that predecessor (-1: none).

    ends holds the end of the part of the text that each position belongs to; a prefix stops there. Only where the bytes
    before a position and its predecessor differ, or a part starts, is a prefix compared; elsewhere it is one byte
    shorter than the one before.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[array[1:]] = array[:-1]
    start = np.ones(n, bool)
    start[1:] = ends[1:] != ends[:-1]
    here = np.arange(n)
    fresh = start | (before <= 0)
    rest = np.flatnonzero(~fresh)
    fresh[rest] = text[rest - 1] != text[before[rest] - 1]
    padded = np.concatenate([text, np.zeros(16, np.uint8)])
    words = np.ndarray((n + 8,), "<u8", padded.tobytes(), 0, (1,))
    i = np.flatnonzero(fresh & (before >= 0))
    j = before[i]
    most = np.minimum(ends[i] - i, ends[j] - j)
    length = np.zeros(len(i), np.int64)
    live = np.arange(len(i))
    while len(live):
        at = length[live]
        x = words[i[live] + at] ^ words[j[live] + at]
        same = np.where(x == 0, 8, np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)).astype(np.int64) // 8)
        length[live] = np.minimum(at + same, most[live])
        live = live[(same == 8) & (length[live] < most[live])]
    out = np.zeros(n, np.int64)
    out[i] = length
    source = np.maximum.accumulate(np.where(fresh, here, 0))
    out = np.maximum(out[source] - (here - source), 0)
    out[before < 0] = 0
    return out, before


def repeated_starts(parts: list[bytes], length: int) -> list[np.ndarray]:
    """For each part, the positions whose string of so many bytes also starts elsewhere in it or in another part."""
    sizes = np.asarray([len(p) + 1 for p in parts])
    text = np.frombuffer(b"\xff".join(parts) + b"\xff", np.uint8)  # no UTF-8 text holds that byte
    ends = np.repeat(np.cumsum(sizes) - 1, sizes)
    common, before = common_prefixes(text, suffix_array(text), ends)
    again = common >= length
    again[before[again]] = True
    return [np.flatnonzero(x) for x in np.split(again, np.cumsum(sizes)[:-1])]
