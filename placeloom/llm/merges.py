"""Ranked merges of neighbouring symbols, in all words of a flat array at once."""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import numpy as np

#: Words of more symbols are merged by a heap, whose time grows with n log n, since rounds may be as many as symbols.
LONG = 512
#: A pair is one number: the left symbol above the right one; symbols are below 2 ** BITS.
BITS = 22
NONE = np.int32(2**31 - 1)


class Pairs:
    """The rank and the result of each pair of symbols that merges."""

    def __init__(self, pairs: Iterable[tuple[int, int, int, int]]):
        """pairs: (left, right, rank, result)."""
        rows = sorted((a << BITS | b, rank, made) for a, b, rank, made in pairs)
        self.keys, self.ranks, self.made = (np.array([r[k] for r in rows], t) for k, t in enumerate((np.int64, np.int32, np.int64)))

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair, NONE and anything where it has none."""
        key = left << BITS | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE), self.made[at]


def merge(p: Pairs, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of words of the given lengths, all merged: their symbols one after another, and how many each has.

    What is merged at once is what one pair after another would give: of a word's pairs of the least rank those that
    do not overlap, from the left, up to the first whose result makes a pair of that rank or a lesser one.
    """
    n = len(lengths)
    word = np.repeat(np.arange(n), lengths)
    ends = np.cumsum(lengths)
    done = [(word[(rows := np.repeat(lengths > LONG, lengths))][:0], symbols[:0])]
    for k in np.flatnonzero(lengths > LONG):
        found = np.array(merge_long(p, symbols[ends[k] - lengths[k] : ends[k]]), np.int64)
        done.append((np.full(len(found), k), found))
    word, sym = word[~rows], symbols[~rows].astype(np.int64)

    def pairs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ranks, made = p.look_up(sym[at], sym[np.minimum(at + 1, len(sym) - 1)])
        last = at + 1 == len(sym)
        ranks[last | (word[np.where(last, at, at + 1)] != word[at])] = NONE
        return ranks, made

    rank, made = pairs(np.arange(len(sym))) if len(sym) else (np.zeros(0, np.int32), np.zeros(0, np.int64))
    while len(sym):
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        size = np.diff(np.r_[first, len(sym)])
        least = np.minimum.reduceat(rank, first)
        if (least == NONE).any():
            over = np.repeat(least == NONE, size)
            done.append((word[over], sym[over]))
            word, sym, rank, made = word[~over], sym[~over], rank[~over], made[~over]
            first, size, least = None, size[least != NONE], least[least != NONE]
            if not len(sym):
                break
            first = np.cumsum(size) - size
        low = np.repeat(least, size)
        at = np.flatnonzero(rank == low)
        # of pairs that overlap every other one, from the first of their run
        run = np.flatnonzero(np.r_[True, (at[1:] != at[:-1] + 1) | (word[at[1:]] != word[at[:-1]])])
        at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))) % 2 == 0]
        result, here = made[at], word[at]
        # the pairs that each result makes with its neighbours, when those on its left are merged and those on its right are not
        left, right = np.maximum(at - 1, 0), np.minimum(at + 2, len(sym) - 1)
        beside = np.r_[False, at[1:] == at[:-1] + 2]
        before = np.where(beside, np.r_[np.int64(0), result[:-1]], sym[left])
        new_left, new_right = p.look_up(before, result)[0], p.look_up(result, sym[right])[0]
        new_left[(at == 0) | (word[left] != here)] = NONE
        new_right[(at + 2 >= len(sym)) | (word[right] != here)] = NONE
        stop = np.minimum(new_left, new_right) <= low[at]
        if stop.any():
            so_far = np.cumsum(stop) - stop
            at_word = np.flatnonzero(np.r_[True, here[1:] != here[:-1]])
            keep = so_far == np.repeat(so_far[at_word], np.diff(np.r_[at_word, len(at)]))
            at, result = at[keep], result[keep]
        sym[at] = result
        stay = np.ones(len(sym), bool)
        stay[at + 1] = False
        place = np.cumsum(stay) - 1
        word, sym, rank, made = word[stay], sym[stay], rank[stay], made[stay]
        changed = place[at]
        changed = np.r_[changed, np.maximum(changed - 1, 0)]
        rank[changed], made[changed] = pairs(changed)
    words, symbols = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(words, kind="stable")
    return symbols[order], np.bincount(words, minlength=n)


def merge_long(p: Pairs, symbols: np.ndarray) -> list[int]:
    """One long word, pair after pair."""
    parts, n = symbols.tolist(), len(symbols)
    after, before = [*range(1, n), -1], [-1, *range(n - 1)]
    ranks, made = p.look_up(symbols[:-1], symbols[1:])
    heap = [(r, i, parts[i], parts[i + 1], m) for i, (r, m) in enumerate(zip(ranks.tolist(), made.tolist(), strict=True)) if r != NONE]
    heapq.heapify(heap)
    known: dict[tuple[int, int], tuple[int, int]] = {}

    def push(i: int, j: int) -> None:
        pair = parts[i], parts[j]
        if pair not in known:
            r, m = p.look_up(np.array(pair[:1]), np.array(pair[1:]))
            known[pair] = int(r[0]), int(m[0])
        r, m = known[pair]
        if r != NONE:
            heapq.heappush(heap, (r, i, *pair, m))

    while heap:
        _, i, a, b, m = heapq.heappop(heap)
        j = after[i]
        if j < 0 or parts[i] != a or parts[j] != b:
            continue  # one of the two has merged meanwhile
        parts[i], parts[j], after[i] = m, -1, after[j]
        if after[j] >= 0:
            before[after[j]] = i
            push(i, after[j])
        if before[i] >= 0:
            push(before[i], i)
        after[j] = -1
    return [x for x in parts if x >= 0]
