"""Merging of adjacent symbols: kernels of vocabulary training and of encoding."""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterable, Mapping

import numpy as np

LONG_ROW = 64  # symbols
NEVER = np.iinfo(np.int64).max  # the rank of what is not merged


def merge_ranked(symbols: Iterable, merged: Mapping) -> list:
    """Merges by rank, equal ranks from the left; the pairs wait in a heap.

    ``merged`` has the rank and the new symbol of each pair.
    """
    parts = list(symbols)
    after = list(range(1, len(parts) + 1))
    before = list(range(-1, len(parts) - 1))
    waiting: list[tuple] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < len(parts):
            found = merged.get((parts[i], parts[after[i]]))
            if found is not None:
                heapq.heappush(waiting, (found[0], i, parts[i], parts[after[i]], found[1]))

    for i in range(len(parts) - 1):
        offer(i)
    while waiting:
        _, i, left, right, new = heapq.heappop(waiting)
        # A pair that another merge has changed since is no longer there.
        j = after[i]
        if parts[i] != left or j >= len(parts) or parts[j] != right:
            continue
        parts[i], parts[j] = new, None
        after[i] = after[j]
        if after[j] < len(parts):
            before[after[j]] = i
        offer(before[i])
        offer(i)
    return [p for p in parts if p is not None]


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left.astype(np.int64) << 32) | right.astype(np.int64)


class Rows:
    """Symbol rows as one array, with the key of each pair of neighbours."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.flat, self.sizes = flat, sizes
        self.row = np.repeat(np.arange(len(sizes)), sizes)
        self.keys = pair_keys(flat[:-1], flat[1:])
        self.keys[self.row[:-1] != self.row[1:]] = -1

    def holding(self, pairs: np.ndarray) -> np.ndarray:
        """Is each pair of neighbours among ``pairs``, a sorted array of keys?"""
        if not len(pairs):
            return np.zeros(len(self.keys), dtype=bool)
        at = np.minimum(np.searchsorted(pairs, self.keys), len(pairs) - 1)
        return pairs[at] == self.keys

    def segments(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Longest runs whose neighbours are all among ``pairs``: their symbols one after the other, sizes and rows."""
        held = self.holding(pairs)
        edges = np.diff(held.astype(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) + 1
        inside = np.append(held, False) | np.append(False, held)
        return self.flat[inside[: len(self.flat)]], ends - starts, self.row[starts]


class Merges:
    """Ranked merges, ``merged`` of ``merge_ranked``, as arrays in the order of their pairs' keys."""

    def __init__(self, merged: Mapping[tuple[int, int], tuple[int, int]]):
        self.merged = merged
        pairs = np.array(list(merged), dtype=np.int64).reshape(-1, 2)
        found = np.array(list(merged.values()), dtype=np.int64).reshape(-1, 2)
        keys = pair_keys(pairs[:, 0], pairs[:, 1])
        order = np.argsort(keys)
        # One more stands for pairs that are not merged.
        self.keys = np.append(keys[order], -1)
        self.ranks = np.append(found[order, 0], NEVER)
        self.new = np.append(found[order, 1], -1).astype(np.int32)

    def places(self, keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys[:-1], keys)
        return np.where(self.keys[at] == keys, at, len(self.keys) - 1)


def merge_rows(rows: Rows, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """``merge_ranked`` of many rows: their symbols one after the other, and their sizes.

    Each pass makes the next merge of every row that has one left, in arrays; rows that have none go aside.
    In long rows, which would take many passes, pairs wait in a heap.
    """
    flat, row = rows.flat.copy(), rows.row
    done = []
    long = rows.sizes > LONG_ROW
    if long.any():
        ends = np.cumsum(rows.sizes)
        for i in np.flatnonzero(long).tolist():
            merged = np.array(merge_ranked(flat[ends[i] - rows.sizes[i] : ends[i]].tolist(), merges.merged), dtype=np.int32)
            done.append((merged, np.full(len(merged), i)))
        flat, row = flat[~long[row]], row[~long[row]]
    keys = pair_keys(flat[:-1], flat[1:])
    never = len(merges.keys) - 1
    # Of the pair that starts at each symbol.
    place = np.append(np.where(row[:-1] == row[1:], merges.places(keys), never), never)[: len(flat)]
    while True:
        ranks = merges.ranks[place]
        held = np.flatnonzero(ranks != NEVER)
        if not len(held):
            break
        first = np.flatnonzero(np.diff(row[held], prepend=-1))
        least = np.minimum.reduceat(ranks[held], first)
        best = held[ranks[held] == np.repeat(least, np.diff(first, append=len(held)))]
        at = best[np.diff(row[best], prepend=-1) != 0]
        flat[at] = merges.new[place[at]]
        left = np.zeros(len(rows.sizes), dtype=bool)
        left[row[at]] = True
        stay = left[row]
        done.append((flat[~stay], row[~stay]))
        # What follows a merged symbol goes, and so do the rows without a merge.
        stay[at + 1] = False
        at = (np.cumsum(stay) - 1)[at]
        flat, row, place = flat[stay], row[stay], place[stay]
        place[at] = never
        changed = np.concatenate((at[at > 0] - 1, at[at + 1 < len(flat)]))
        changed = changed[row[changed] == row[changed + 1]]
        place[changed] = merges.places(pair_keys(flat[changed], flat[changed + 1]))
    done.append((flat, row))
    flat, row = (np.concatenate(part) for part in zip(*done))
    return flat[np.argsort(row, kind="stable")], np.bincount(row, minlength=len(rows.sizes))


class Contest:
    """Pairs of neighbours in segments that compete for being merged next.

    A table from pairs to the segments which hold them and the counts of all pairs follow each
    merge, so a merge touches its own segments only.
    """

    def __init__(self, segments: Iterable[tuple[list[int], int]]):
        self.parts: list[list[int]] = []
        self.times: list[int] = []
        self.counts: dict[tuple[int, int], int] = defaultdict(int)
        self.places: dict[tuple[int, int], set[int]] = defaultdict(set)
        for i, (part, n) in enumerate(segments):
            self.parts.append(part)
            self.times.append(n)
            for pair in zip(part, part[1:]):
                self.counts[pair] += n
                self.places[pair].add(i)
        self.waiting = [(-n, *pair) for pair, n in self.counts.items()]
        heapq.heapify(self.waiting)

    def best(self) -> tuple[int, int, int] | None:
        """Minus the count, left and right of the most frequent pair, ties to the lower symbols."""
        while self.waiting:
            n, left, right = self.waiting[0]
            if n and self.counts.get((left, right)) == -n:
                return self.waiting[0]
            heapq.heappop(self.waiting)
        return None

    def merge(self, left: int, right: int, new: int) -> None:
        """Replaces the pair everywhere, from the left."""
        was: dict[tuple[int, int], int] = {}
        for i in self.places.pop((left, right), ()):
            part, n = self.parts[i], self.times[i]
            joined, at = [], 0
            while at < len(part):
                if part[at] == left and at + 1 < len(part) and part[at + 1] == right:
                    joined.append(new)
                    at += 2
                else:
                    joined.append(part[at])
                    at += 1
            if len(joined) == len(part):
                continue
            for pair in zip(part, part[1:]):
                was.setdefault(pair, self.counts[pair])
                self.counts[pair] -= n
            for pair in zip(joined, joined[1:]):
                was.setdefault(pair, self.counts[pair])
                self.counts[pair] += n
                self.places[pair].add(i)
            self.parts[i] = joined
        for pair, n in was.items():
            if self.counts[pair] != n:
                heapq.heappush(self.waiting, (-self.counts[pair], *pair))
