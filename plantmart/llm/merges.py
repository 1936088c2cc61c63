"""Byte-pair merges of many words at once, in numpy."""

from __future__ import annotations

import heapq

import numpy as np

NONE = np.int32(2**31 - 1)
LONG_WORD = 64  # longer words are merged one by one with a queue
GROUPS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 14, 16, 20, 24, 32, 48, LONG_WORD])
BATCH = 65_536


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself, or one from 256 on in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers ``first[i] .. first[i] + n[i] - 1`` for each i, one after another."""
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(first - (ends - n), n)


class Merger:
    """Merges of a vocabulary. ``suffix`` marks the last symbol of a word in some vocabularies."""

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str = ""):
        characters = byte_characters()
        self.first = np.array([vocabulary[c] for c in characters], np.int32)
        self.last = np.array([vocabulary[c + suffix] for c in characters], np.int32)
        pairs = [p if isinstance(p, list) else p.split(" ") for p in merges]
        self.size = max(vocabulary.values()) + 1
        cut = len(suffix)
        joined = [a[: len(a) - cut] + b if cut and a.endswith(suffix) else a + b for a, b in pairs]
        self.merged = np.array([vocabulary[j] for j in joined], np.int32)
        keys = np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in pairs], np.int64)
        self.ranks = {k: r for r, k in reversed(list(enumerate(keys.tolist())))}
        # An open table: a pair's slot follows from its key, the next free slot if that is taken.
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.slot_key = np.full((1 << self.bits) + 64, -1, np.int64)
        self.slot_rank = np.full((1 << self.bits) + 64, NONE, np.int32)
        for key, slot in zip(keys.tolist(), self._slot(keys).tolist()):
            while self.slot_key[slot] not in (-1, key):
                slot += 1
            if self.slot_key[slot] == -1:
                self.slot_key[slot], self.slot_rank[slot] = key, self.ranks[key]

    def _slot(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, ``NONE`` if it has none or a symbol is missing (negative)."""
        key = left.astype(np.int64) * self.size + right
        key = np.where((left < 0) | (right < 0), -2, key)
        slot = self._slot(key)
        there = self.slot_key[slot]
        out = np.where(there == key, self.slot_rank[slot], NONE)
        on = np.flatnonzero((there != key) & (there != -1) & (key >= 0))
        while len(on):
            slot[on] += 1
            there = self.slot_key[slot[on]]
            hit = there == key[on]
            out[on[hit]] = self.slot_rank[slot[on[hit]]]
            on = on[~hit & (there != -1)]
        return out

    def _start(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
        column = np.arange(width)
        inside = column < size[:, None]
        symbols = self.first[data[np.where(inside, start[:, None] + column, 0)]]
        symbols[~inside] = -1
        symbols[np.arange(len(start)), size - 1] = self.last[data[start + size - 1]]
        return symbols

    def _rounds(self, symbols: np.ndarray) -> np.ndarray:
        """In every round each word gets its best pair merged, the leftmost first. Returns the symbols, -1 behind the last."""
        n, width = symbols.shape
        if width < 2:
            return symbols
        done = symbols.copy()
        row = np.arange(n)
        column = np.arange(width, dtype=np.int32)
        symbols = np.concatenate([symbols, np.full((n, 1), -1, np.int32)], 1)
        rank = self.rank(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(n, width)
        while True:
            at = rank.argmin(1)
            best = rank[np.arange(len(row)), at]
            more = best != NONE
            if not more.all():
                done[row[~more]] = symbols[~more, :-1]
                row, symbols, rank, at, best = row[more], symbols[more], rank[more], at[more], best[more]
            if not len(row):
                return done
            here = np.arange(len(row))
            made = self.merged[best]
            symbols[here, at] = made
            # Close the gap behind the merged pair, then rate its two new neighbours.
            move = column + (column > at[:, None])
            symbols[:, :-1] = symbols.ravel()[move + (here * (width + 1))[:, None]]
            move = np.minimum(move, width - 1)
            rank = rank.ravel()[move + (here * width)[:, None]]
            rank[:, -1] = NONE
            rank[here, at] = self.rank(made, symbols[here, at + 1])
            some = np.flatnonzero(at > 0)
            rank[some, at[some] - 1] = self.rank(symbols[some, at[some] - 1], made[some])

    def _queue(self, symbols: list[int]) -> np.ndarray:
        """The same for one long word."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n:
                rank = self.ranks.get(symbols[i] * self.size + symbols[after[i]])
                if rank is not None:
                    heapq.heappush(queue, (rank, i, symbols[i], symbols[after[i]]))

        for i in range(n):
            offer(i)
        while queue:
            rank, i, left, right = heapq.heappop(queue)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], symbols[j] = int(self.merged[rank]), -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return np.array([s for s in symbols if s >= 0], np.int32)

    def merge(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words ``data[start[i]:end[i]]`` one after another, and the offsets of the words in them."""
        size = end - start
        n = np.zeros(len(size), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        group = np.searchsorted(GROUPS, size)
        for g in np.unique(group):
            members = np.flatnonzero((group == g) & (size > 0))
            if g == len(GROUPS):
                for i in members:
                    symbols = self.first[data[start[i] : end[i]]].tolist()
                    symbols[-1] = int(self.last[data[end[i] - 1]])
                    ids = self._queue(symbols)
                    n[i] = len(ids)
                    parts.append((np.array([i]), ids))
                continue
            for at in range(0, len(members), BATCH):
                some = members[at : at + BATCH]
                symbols = self._rounds(self._start(data, start[some], size[some], int(GROUPS[g])))
                held = symbols >= 0
                n[some] = held.sum(1)
                parts.append((some, symbols[held]))
        offsets = np.concatenate([[0], np.cumsum(n)])
        flat = np.zeros(offsets[-1], np.int32)
        for some, ids in parts:
            flat[spread(offsets[some], n[some])] = ids
        return flat, offsets


class IdTable:
    """Ids by word hash, kept between batches: a flat store of ids, emptied when it holds more than ``most`` words."""

    def __init__(self, most: int = 300_000):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.place: dict[int, int] = {}
        self.first, self.n = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word in the table, -1 if it is not there."""
        if len(self.place) > self.most:
            self.clear()
        get = self.place.get
        return np.array([get(h, -1) for h in hashes.tolist()], np.int64)

    def add(self, hashes: np.ndarray, flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Put new words in; their numbers."""
        numbers = len(self.first) + np.arange(len(hashes))
        self.place.update(zip(hashes.tolist(), numbers.tolist()))
        self.first = np.concatenate([self.first, offsets[:-1] + len(self.flat)])
        self.n = np.concatenate([self.n, np.diff(offsets).astype(np.int32)])
        self.flat = np.concatenate([self.flat, flat])
        return numbers

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words in order, and how many each word has."""
        n = self.n[numbers].astype(np.int64)
        return self.flat[spread(self.first[numbers], n)], n
