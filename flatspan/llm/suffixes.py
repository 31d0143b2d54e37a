"""Suffix arrays by induced sorting and permuted common prefixes, in numpy.

Positions are leftmost-smaller (LMS) where a suffix that is smaller than its right neighbour follows one that is larger.  The
LMS substrings are sorted by induction, named in that order, and the string of names is sorted in turn; then all suffixes are
induced from the sorted LMS suffixes.  Induction goes bucket by bucket, a whole bucket at a time, so it takes a few array steps for each
letter.  The string of names has an alphabet as large as itself, where a bucket is a letter or two; there the recursion sorts the
names in pairs, pairs of pairs and so on, until all differ.
"""

from __future__ import annotations

import numpy as np


def _smaller_than_next(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the last letter is the unique smallest, and counts as such."""
    n = len(s)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(s[1:].astype(np.int32) - s[:-1])
    step[-1] = 1
    # Equal letters go by the next place where the letter changes.
    at = np.where(step[::-1] != 0, np.arange(n), 0)
    return step[::-1][np.maximum.accumulate(at)][::-1] > 0


class _Buckets:
    def __init__(self, s: np.ndarray, smaller: np.ndarray) -> None:
        self.s, self.smaller = s, smaller
        count = np.bincount(s)
        self.end = np.cumsum(count)
        self.start = self.end - count

    def induce(self, lms: np.ndarray) -> np.ndarray:
        """The suffixes in the order that follows from the order of the LMS ones (by their first letter, equal letters as given)."""
        s, smaller = self.s, self.smaller
        out = np.full(len(s), -1, np.int32)
        first = s[lms]
        by = np.argsort(first, kind="stable")
        many = np.bincount(first, minlength=len(self.end))
        ahead = self.end - many  # where the LMS suffixes of each bucket begin
        out[np.repeat(ahead - (np.cumsum(many) - many), many) + np.arange(len(lms))] = lms[by]
        head = self.start.copy()
        letters = np.flatnonzero(self.end > self.start).tolist()

        def push(of: np.ndarray) -> None:
            of = of[of > 0] - 1
            of = of[~smaller[of]]
            if len(of):
                letter = s[of]
                order = np.argsort(letter, kind="stable")
                n = np.bincount(letter, minlength=len(head))
                of, letter = of[order], letter[order]
                out[head[letter] + np.arange(len(of)) - (np.cumsum(n) - n)[letter]] = of
                head[:] += n

        for c in letters:
            at = self.start[c]
            while at < head[c]:
                at, old = head[c], at
                push(out[old:at])
            push(out[ahead[c] : self.end[c]])
        larger_end = head.copy()
        tail = self.end.copy()
        last = len(s) - 1

        def pull(of: np.ndarray) -> None:
            of = of[of > 0] - 1
            of = of[smaller[of]]
            if len(of):
                letter = s[of]
                order = np.argsort(letter, kind="stable")
                n = np.bincount(letter, minlength=len(tail))
                of, letter = of[order], letter[order]
                out[tail[letter] - 1 - np.arange(len(of)) + (np.cumsum(n) - n)[letter]] = of
                tail[:] -= n

        for c in reversed(letters):
            at = self.end[c]
            while tail[c] < at:
                at, old = tail[c], at
                pull(out[at:old][::-1])
            pull(out[self.start[c] : larger_end[c]][::-1])
        out[0] = last
        return out


def _names(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """The names of the LMS substrings, in the order of their places; equal substrings have equal names."""
    index = np.empty(len(s), np.int32)
    index[lms] = np.arange(len(lms))
    ends = np.append(lms[1:], lms[-1])
    length = (ends - lms)[index[ordered]]
    same = np.zeros(len(ordered), bool)
    same[1:] = length[1:] == length[:-1]
    active, offset = np.flatnonzero(same), 0
    while len(active):
        a, b = ordered[active] + offset, ordered[active - 1] + offset
        equal = (s[a] == s[b]) & (smaller[a] == smaller[b])
        same[active[~equal]] = False
        active = active[equal]
        active = active[length[active] > offset]
        offset += 1
    names = np.empty(len(lms), np.int64)
    names[index[ordered]] = np.cumsum(~same) - 1
    return names


def _sort_names(names: np.ndarray) -> np.ndarray:
    """The order of the suffixes of a string of names: sorted by pairs of ever longer names."""
    rank, step = names, 1
    n = len(rank)
    while True:
        if int(rank.max()) + 1 == n:
            order = np.empty(n, np.int64)
            order[rank] = np.arange(n)
            return order
        after = np.zeros(n, np.int64)
        after[: max(0, n - step)] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.ones(n, np.int64)
        new[0] = 0
        new[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        step *= 2


def suffix_array(s: np.ndarray) -> np.ndarray:
    """The suffix array of small whole numbers; the last one is zero and the only zero."""
    if len(s) == 1:
        return np.zeros(1, np.int32)
    smaller = _smaller_than_next(s)
    lms = (np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1).astype(np.int32)
    buckets = _Buckets(s, smaller)
    is_lms = np.zeros(len(s), bool)
    is_lms[lms] = True
    rough = buckets.induce(lms)
    ordered = rough[is_lms[rough]]
    return buckets.induce(lms[_sort_names(_names(s, smaller, lms, ordered))])


def common_prefixes(s: np.ndarray, order: np.ndarray) -> np.ndarray:
    """PLCP: for each place of the text, how many letters its suffix shares with the one before it in the suffix array.

    Only irreducible values are counted out: those where the letters before the two suffixes differ.  Along the text every other
    value is its left neighbour's less one.
    """
    n = len(s)
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    place = np.arange(n)
    irreducible = (before <= 0) | (place == 0) | (s[place - 1] != s[before - 1])
    at = np.flatnonzero(irreducible)
    common = np.zeros(n, np.int64)
    active = at[before[at] >= 0]
    width = 16
    step = np.arange(width)
    padded = np.append(s, np.full(width, -1, s.dtype))
    count = np.zeros(n, np.int64)
    while len(active):
        a, b = active + count[active], before[active] + count[active]
        left, right = padded[a[:, None] + step], padded[b[:, None] + step]
        differ = left != right
        n_same = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        count[active] += n_same
        active = active[n_same == width]
    common[at] = count[at]
    anchor = np.maximum.accumulate(np.where(irreducible, place, 0))
    return np.maximum(common[anchor] - (place - anchor), 0)


def repeated_starts(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string, whether each place where ``length`` of its bytes begin repeats another such place of any string."""
    sizes = np.array([len(x) for x in strings])
    # A letter between strings keeps matches inside them; the last one is the smallest and unique.
    text = np.frombuffer(b"\0".join([*strings, b""]), np.uint8).astype(np.int16) + 2
    ends = np.cumsum(sizes + 1) - 1
    text[ends] = 1
    text = np.append(text, np.int16(0))
    order = suffix_array(text)
    common = common_prefixes(text, order)
    along = common[order]
    best = np.maximum(along, np.append(along[1:], 0))
    hit = np.empty(len(text), bool)
    hit[order] = best >= length
    starts = ends - sizes
    return [hit[a : max(a, e - length + 1)] for a, e in zip(starts.tolist(), ends.tolist(), strict=True)]
