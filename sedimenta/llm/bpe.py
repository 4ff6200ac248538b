"""Vectorised BPE: the merge rounds that encoders share.

One flat numpy array holds the symbols of all segments. In each round every segment's best (smallest) pair rank is found
by a segmented minimum, its leftmost non-overlapping pairs of that rank are merged at once, and the array is compacted,
until no pair is left. Merging all pairs of a rank at once equals the one-by-one order only if the merged symbol cannot
take part in a pair of better or equal rank; where it can, only the leftmost pair of the segment is merged in that round.
"""

from __future__ import annotations

import numpy as np

NEVER = np.iinfo(np.int64).max


class Merges:
    def __init__(self, size: int, pairs: list[tuple[int, int, int, int]]):
        """pairs: (left, right, rank, merged) with symbols in 0..size-1."""
        left, right, self.ranks, self.merged = np.array(pairs, np.int64).T.copy()
        self.size, self.keys = size, left * size + right
        # An open hash table over the keys.
        self.table = np.full(1 << 22, -1, np.int32)
        todo, at = np.arange(len(self.keys)), self.home(self.keys)
        while len(todo):
            free = self.table[at] < 0
            self.table[at[free]] = todo[free]
            lost = self.table[at] != todo
            todo, at = todo[lost], (at[lost] + 1) % len(self.table)
        # A symbol is safe if no pair with it on either side ranks as well as its own merge, and no other symbol has its rank.
        best, own = np.full(size, NEVER), np.full(size, -1)
        for side in (left, right):
            np.minimum.at(best, side, self.ranks)
        np.maximum.at(own, self.merged, self.ranks)
        shared = np.bincount(own[own >= 0], minlength=1)
        self.safe = best > own
        self.safe[own >= 0] &= shared[own[own >= 0]] == 1

    @staticmethod
    def home(key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)).astype(np.int64)

    def pairs(self, left: np.ndarray, right: np.ndarray, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair of neighbours; NEVER where there is none or they are not joined."""
        rank, to = np.full(len(left), NEVER), np.zeros(len(left), np.int64)
        may = np.flatnonzero(joined & (left >= 0) & (right >= 0))
        if len(may):
            key = left[may] * self.size + right[may]
            at = self.home(key)
            slot = self.table[at]
            while len(miss := np.flatnonzero((slot >= 0) & (self.keys[slot] != key))):
                at[miss] = (at[miss] + 1) % len(self.table)
                slot[miss] = self.table[at[miss]]
            may, slot = may[slot >= 0], slot[slot >= 0]
            rank[may], to[may] = self.ranks[slot], self.merged[slot]
        return rank, to

    def run(self, sym: np.ndarray, seg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge the symbols (below zero: never merged) of each segment (rising numbers) to the end."""
        done_sym, done_seg = [], []
        # rank[i], to[i] belong to the pair of symbols i and i + 1.
        rank, to = self.pairs(sym, np.r_[sym[1:], -1], np.r_[seg[1:] == seg[:-1], False])
        while len(sym):
            new = np.r_[True, seg[1:] != seg[:-1]]
            best = np.minimum.reduceat(rank, np.flatnonzero(new))[np.cumsum(new) - 1]
            live = best < NEVER
            if not live.all():  # segments without a pair leave the array
                done_sym.append(sym[~live])
                done_seg.append(seg[~live])
                sym, seg, rank, to, best = sym[live], seg[live], rank[live], to[live], best[live]
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == best)
            first = np.r_[True, seg[hit][1:] != seg[hit][:-1]]
            run = np.r_[True, np.diff(hit) != 1]  # hits that overlap: every second one from the run's start
            begin = np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
            hit = hit[((np.arange(len(hit)) - begin) % 2 == 0) & (first | self.safe[to[hit]])]
            sym[hit] = to[hit]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            now = hit - np.arange(len(hit))  # where the merged symbols stand after compaction
            sym, seg, rank, to = sym[keep], seg[keep], rank[keep], to[keep]
            touched = np.zeros(len(sym), bool)
            touched[now] = touched[np.maximum(now - 1, 0)] = True
            stale = np.flatnonzero(touched)
            after = np.minimum(stale + 1, len(sym) - 1)
            rank[stale], to[stale] = self.pairs(sym[stale], sym[after], (after > stale) & (seg[after] == seg[stale]))
        sym, seg = np.concatenate([*done_sym, sym]), np.concatenate([*done_seg, seg])
        order = np.argsort(seg, kind="stable")
        return sym[order], seg[order]
