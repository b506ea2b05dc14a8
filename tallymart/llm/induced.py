"""Suffix arrays by induced sorting, a bucket at a time.

Suffixes are S (smaller than the next one) or L; an S suffix after an L one is
"leftmost smaller" (LMS). LMS suffixes in order determine the order of all L
suffixes in one scan from the left and of all S suffixes in one scan from the
right. The scans run bucket by bucket: everything a bucket induces is placed at
once, and only runs of one character need more than two steps per bucket. LMS
suffixes are put in order by sorting their substrings with the same two scans,
naming them, and sorting the string of names: by this procedure again while the
names are few, else by doubling ranks, as a scan per name would not pay.

With `depth`, suffixes are sorted by at least their first `depth` characters.
"""

from __future__ import annotations

import numpy as np

FEW_NAMES = 2_048


def _types(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one; the last one is."""
    n = len(t)
    smaller, differs = t[:-1] < t[1:], t[:-1] != t[1:]
    at = np.where(differs, np.arange(n - 1), n - 1)
    at = np.minimum.accumulate(at[::-1])[::-1]  # where the run of equal characters ends
    return np.append(np.append(smaller, True)[at], True)


def _spread(sa, t, found, place, step: int) -> None:
    """Puts `found`, in this order, at the free places of their buckets."""
    chars = t[found]
    order = np.argsort(chars, kind="stable")
    chars = chars[order]
    first = np.flatnonzero(np.append(True, chars[1:] != chars[:-1]))
    size = np.diff(np.append(first, len(chars)))
    rank = np.arange(len(chars)) - np.repeat(first, size)
    heads = chars[first]
    sa[np.repeat(place[heads], size) + step * rank] = found[order]
    place[heads] += step * size


def _induce(t, is_s, lms, starts, ends) -> np.ndarray:
    """Suffix array induced from LMS suffixes given in order."""
    sa = np.full(len(t), -1, dtype=np.int32)
    chars = t[lms]
    size = np.bincount(chars, minlength=len(starts))
    seeds = ends - size  # LMS suffixes wait at the ends of their buckets
    order = np.argsort(chars, kind="stable")
    base = np.cumsum(size) - size
    sorted_chars = chars[order]
    sa[seeds[sorted_chars] + np.arange(len(lms)) - base[sorted_chars]] = lms[order]
    used = np.flatnonzero(ends > starts)
    head = starts.copy()

    def before(part, want_s: bool):
        p = part[part > 0] - 1
        return p[is_s[p] == want_s]

    for c in used:
        at = starts[c]
        while at < head[c]:
            part, at = sa[at:head[c]], head[c]
            found = before(part, False)
            if len(found):
                _spread(sa, t, found, head, 1)
        if seeds[c] < ends[c]:
            found = before(sa[seeds[c]:ends[c]], False)
            if len(found):
                _spread(sa, t, found, head, 1)
    tail = ends - 1
    for c in used[::-1]:
        at = ends[c] - 1
        while at > tail[c]:
            part, at = sa[tail[c] + 1:at + 1][::-1], tail[c]
            found = before(part, True)
            if len(found):
                _spread(sa, t, found, tail, -1)
        if head[c] > starts[c]:
            found = before(sa[starts[c]:head[c]][::-1], True)
            if len(found):
                _spread(sa, t, found, tail, -1)
    sa[0] = len(t) - 1  # the end mark, alone in its bucket
    return sa


def _names(t, lms, order) -> np.ndarray:
    """Names of LMS substrings (equal ones share a name), in text order."""
    length = np.append(np.diff(lms), 1) + 1
    place = np.empty(len(t), dtype=np.int32)
    place[lms] = np.arange(len(lms))
    i = place[order]
    a, b = i[:-1], i[1:]
    new = length[a] != length[b]
    open_ = np.flatnonzero(~new)
    k = 0
    while len(open_):
        pa, pb = lms[a[open_]] + k, lms[b[open_]] + k
        differs = t[pa] != t[pb]
        new[open_[differs]] = True
        k += 1
        open_ = open_[~differs & (k < length[a[open_]])]
    names = np.empty(len(lms), dtype=np.int64)
    names[i] = np.append(0, np.cumsum(new))
    return names


def _doubled(names: np.ndarray, depth: int | None) -> np.ndarray:
    """Order of the suffixes of a string of names by doubling ranks."""
    rank, span, n = names, 1, len(names)
    while True:
        second = np.zeros(n, dtype=np.int64)
        second[:n - span] = rank[span:] + 1
        key = rank * (int(rank.max()) + 2) + second
        order = np.argsort(key, kind="stable")
        sorted_ = key[order]
        new = np.append(0, np.cumsum(sorted_[1:] != sorted_[:-1]))
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new
        span *= 2
        # Neighbouring LMS suffixes are two characters apart at least.
        if new[-1] == n - 1 or (depth is not None and 2 * span >= depth + 2):
            return order


def suffix_array(t: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Suffix array of integers `t` whose last value is 0 and occurs nowhere else."""
    if len(t) < 3:
        return np.arange(len(t), dtype=np.int32)[::-1].copy()
    is_s = _types(t)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]).astype(np.int32) + 1
    ends = np.cumsum(np.bincount(t))
    starts = np.append(0, ends[:-1])
    if len(lms) > 1:
        sa = _induce(t, is_s, lms, starts, ends)
        mark = np.zeros(len(t), dtype=bool)
        mark[lms] = True
        order = sa[mark[sa]]
        names = _names(t, lms, order)
        few = int(names.max()) + 1
        if few < len(lms):
            # The last LMS substring is the end mark: name 0, and nothing else is.
            order = suffix_array(names, depth) if few <= FEW_NAMES else _doubled(names, depth)
            lms = lms[order]
        else:
            lms = order
    return _induce(t, is_s, lms, starts, ends)


def common_prefixes(data: np.ndarray, sa: np.ndarray, cap: int) -> np.ndarray:
    """Permuted common prefixes: per position, with its predecessor in `sa`, up to `cap`.

    `data` holds bytes and eight more bytes than the longest comparison reads.
    """
    n = len(sa)
    words = np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))
    before = np.empty(n, dtype=np.int32)
    before[sa[1:]], before[sa[0]] = sa[:-1], sa[0]
    out = np.full(n, cap, dtype=np.int32)
    open_, k = np.arange(n, dtype=np.int32), 0
    while len(open_) and k < cap:
        x = words[open_ + k] ^ words[before[open_] + k]
        end = np.flatnonzero(x)
        low = x[end] & (~x[end] + np.uint64(1))
        same = np.log2(low.astype(np.float64)).astype(np.int32) // 8
        out[open_[end]] = np.minimum(cap, k + same)
        open_, k = open_[x == 0], k + 8
    out[sa[0]] = 0
    return out
