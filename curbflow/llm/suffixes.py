"""Suffix arrays of integer and byte sequences with numpy, for the tasks of one shard.

``induced`` sorts by induction: suffixes are classified, leftmost-smaller (LMS) substrings are
sorted and named, the reduced sequence is sorted recursively, and two bucket scans induce all
other suffixes. A scan goes bucket by bucket; within a bucket whole waves of suffixes induce
their left neighbours at once, in the order of the sequential scan. A reduced sequence whose
alphabet is wide against its length would make a scan of tiny buckets and is sorted by
``doubled`` (prefix doubling) instead; that is the recursion's floor.
"""

from __future__ import annotations

import numpy as np

WIDE = 24  # at least so many symbols per bucket for a bucket scan to pay


def _ordered(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stable order of non-negative keys, and the keys in it."""
    n = len(key)
    bits = n.bit_length()
    if int(key.max()).bit_length() + bits > 63:
        order = np.argsort(key, kind="stable")
        return order, key[order]
    # sorting whole numbers is several times faster than sorting places
    packed = np.sort((key << bits) | np.arange(n))
    return packed & ((1 << bits) - 1), packed >> bits


def doubled(seq: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Suffix array of a sequence of non-negative integers, by prefix doubling.

    With ``depth`` suffixes are told apart by their first ``depth`` symbols at least, and those
    that agree so far stay in order of position.
    """
    n = len(seq)
    if n == 0:
        return np.zeros(0, np.int64)
    order, ranked = _ordered(seq.astype(np.int64))
    rank = np.empty(n, np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])]) + 1
    size = 1
    while size < n and (depth is None or size < depth):
        second = np.zeros(n, np.int64)
        second[: n - size] = rank[size:]
        order, ranked = _ordered(rank * (n + 1) + second)
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])]) + 1
        rank, size = new, 2 * size
        if rank[order[-1]] == n:
            break
    return order


def _kinds(seq: np.ndarray) -> np.ndarray:
    """True for S-type suffixes; the last one, before the virtual end, is L-type."""
    n = len(seq)
    known = np.append(seq[1:] != seq[:-1], True)  # the others are as the next
    value = np.append(seq[1:] > seq[:-1], False)
    following = np.minimum.accumulate(np.where(known, np.arange(n), n)[::-1])[::-1]
    return value[following]


def _induce(seq, small, starts, ends, lms):
    """Sorts all suffixes given LMS suffixes in their order (or any order, for substrings)."""
    n = len(seq)
    sa = np.full(n, -1, np.int64)
    heads, tails = starts.copy(), ends.copy()
    # LMS suffixes go to the ends of their buckets
    symbols = seq[lms]
    by = np.argsort(symbols, kind="stable")
    counts = np.bincount(symbols, minlength=len(starts))
    first = ends - counts
    sa[np.repeat(first, counts) + (np.arange(len(lms)) - np.repeat(np.cumsum(counts) - counts, counts))] = lms[by]

    def put(left: np.ndarray, pointer: np.ndarray, up: bool) -> None:
        c = seq[left]
        by = np.argsort(c, kind="stable")
        ranked = c[by]
        at = np.append(0, np.flatnonzero(ranked[1:] != ranked[:-1]) + 1)
        got, many = ranked[at], np.diff(np.append(at, len(left)))
        inside = np.arange(len(left)) - np.repeat(at, many)
        if up:
            sa[np.repeat(pointer[got], many) + inside] = left[by]
            pointer[got] += many
        else:
            sa[np.repeat(pointer[got], many) - 1 - inside] = left[by]
            pointer[got] -= many

    def wave(items: np.ndarray, want_small: bool, pointer: np.ndarray, up: bool) -> None:
        left = items[items > 0] - 1
        left = left[small[left] == want_small]
        if len(left):
            put(left, pointer, up)

    used = np.flatnonzero(ends > starts)
    # the suffix before the virtual end comes first of all L-type ones
    put(np.array([n - 1]), heads, True)
    for c in used:
        done = starts[c]
        while done < heads[c]:  # L-type suffixes of this bucket, wave by wave
            stop = heads[c]
            wave(sa[done:stop], False, heads, True)
            done = stop
        if first[c] < ends[c]:
            wave(sa[first[c] : ends[c]], False, heads, True)
    for c, a, b in zip(used, first[used], ends[used]):
        sa[max(a, heads[c]) : b] = -1  # S-type ones are placed anew, from the right
    for c in used[::-1]:
        done = ends[c]
        while done > tails[c]:
            stop = tails[c]
            wave(sa[stop:done][::-1], True, tails, False)
            done = stop
        if starts[c] < heads[c]:
            wave(sa[starts[c] : heads[c]][::-1], True, tails, False)
    return sa


def induced(seq: np.ndarray) -> np.ndarray:
    """Suffix array of a sequence of non-negative integers, by induced sorting."""
    n = len(seq)
    if n < 2:
        return np.arange(n)
    alphabet = int(seq.max()) + 1
    counts = np.bincount(seq, minlength=alphabet)
    if n < WIDE * np.count_nonzero(counts) or n < 64:
        return doubled(seq)
    seq = seq.astype(np.uint8 if alphabet <= 256 else np.uint16 if alphabet <= 65536 else np.int64)  # small kinds sort by radix
    ends = np.cumsum(counts)
    starts = ends - counts
    small = _kinds(seq)
    is_lms = np.zeros(n, bool)
    is_lms[1:] = small[1:] & ~small[:-1]
    lms = np.flatnonzero(is_lms)
    if len(lms) == 0:
        return _induce(seq, small, starts, ends, lms)
    sa = _induce(seq, small, starts, ends, lms)
    ordered = sa[is_lms[sa]]
    names = _names(seq, ordered, lms)
    if names.max() + 1 < len(lms):
        reduced = np.empty(len(lms), np.int64)
        at = np.zeros(n, np.int64)
        at[lms] = np.arange(len(lms))
        reduced[at[ordered]] = names
        ordered = lms[induced(reduced)]
    return _induce(seq, small, starts, ends, ordered)


def _names(seq: np.ndarray, ordered: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Names of the sorted LMS substrings: equal ones share a name, and names keep the order."""
    n = len(seq)
    stop = np.full(n, n, np.int64)  # of an LMS substring its last symbol, the next LMS position
    stop[lms[:-1]] = lms[1:]
    a, b = ordered[:-1], ordered[1:]
    length = np.minimum(stop[ordered] + 1, n) - ordered
    open_end = stop[ordered] == n
    same = (length[:-1] == length[1:]) & ~open_end[:-1] & ~open_end[1:]
    todo, k = np.flatnonzero(same), 0
    while len(todo):
        equal = seq[a[todo] + k] == seq[b[todo] + k]
        same[todo[~equal]] = False
        todo = todo[equal]
        k += 1
        todo = todo[length[todo] > k]
    return np.concatenate([[0], np.cumsum(~same)])


def permuted_lcp(seq: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """Common prefix length of each suffix with the one before it in ``sa``, by text position.

    Lengths beyond ``most`` count as ``most``. The predecessor of every suffix is taken by text
    position (the permuted order), and all prefixes grow together, by eight bytes a step.
    """
    n = len(seq)
    size = seq.dtype.itemsize
    step = 8 // size  # symbols in eight bytes
    raw = np.concatenate([np.ascontiguousarray(seq).view(np.uint8), np.zeros(8 * (most + 1), np.uint8)])
    words = np.ndarray(n + most, "<u8", raw, strides=(size,))  # eight bytes from each symbol on
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    lengths = np.zeros(n, np.int64)
    first = np.flatnonzero(before >= 0)
    todo, other = first, before[first]
    for k in range(0, most, step):
        differ = words[todo + k] ^ words[other + k]
        same = differ == 0
        done = np.flatnonzero(~same)
        lowest = differ[done] & (~differ[done] + np.uint64(1))  # the first differing bit
        lengths[todo[done]] = k + (np.frexp(lowest.astype(np.float64))[1] - 1) // (8 * size)
        todo, other = todo[same], other[same]
    lengths[todo] = most
    # what lies behind the end is not of the sequence
    lengths[first] = np.minimum(lengths[first], np.minimum(n - np.maximum(first, before[first]), most))
    return lengths
