"""A word lexicon as a minimal acyclic transducer: words share prefixes and suffixes, and their ids lie on the arcs.

Words are added in order. Ids move towards the start as far as all words through an arc agree, so that ends with equal rest
become one state. The finished automaton is one flat buffer of little-endian arrays that is mapped, not parsed.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterable

import numpy as np

from .merges import spread


def _common(a: tuple, b: tuple) -> int:
    n = 0
    while n < len(a) and n < len(b) and a[n] == b[n]:
        n += 1
    return n


class _State:
    __slots__ = ("arcs", "final", "output")

    def __init__(self):
        self.arcs: list[list] = []  # [byte, output, target]; only the last one still changes
        self.final = False
        self.output: tuple = ()  # ids that follow when a word ends here


def build(entries: Iterable[tuple[bytes, tuple[int, ...]]]) -> bytes:
    """The flat buffer for distinct words in byte order with their ids."""
    known: dict[tuple, int] = {}
    frozen: list[tuple] = []

    def freeze(state: _State) -> int:
        key = (state.final, state.output, tuple((b, o, t) for b, o, t in state.arcs))
        if key not in known:
            known[key] = len(frozen)
            frozen.append(key)
        return known[key]

    def close(path: list[_State], depth: int) -> None:
        while len(path) > depth + 1:
            number = freeze(path.pop())
            path[-1].arcs[-1][2] = number

    path, last = [_State()], b""
    for word, ids in entries:
        shared = 0
        while shared < min(len(last), len(word)) and last[shared] == word[shared]:
            shared += 1
        close(path, shared)
        left = tuple(ids)
        for depth in range(shared):
            arc, below = path[depth].arcs[-1], path[depth + 1]
            same = _common(arc[1], left)
            if same < len(arc[1]):
                moved = arc[1][same:]
                for other in below.arcs:
                    other[1] = moved + other[1]
                if below.final:
                    below.output = moved + below.output
                arc[1] = arc[1][:same]
            left = left[same:]
        for byte in word[shared:]:
            path[-1].arcs.append([byte, left, -1])
            left = ()
            path.append(_State())
        path[-1].final = True
        if left:
            path[-1].output = left
        last = word
    close(path, 0)
    root = freeze(path[0])

    first, byte_of, to, out_at, outputs, ends, end_at = [0], [], [], [0], [], [], [0]
    tails: list[int] = []
    for final, output, arcs in frozen:
        for byte, ids, target in arcs:
            byte_of.append(byte)
            to.append(target)
            outputs.extend(ids)
            out_at.append(len(outputs))
        first.append(len(to))
        ends.append(final)
        tails.extend(output)
        end_at.append(len(tails))
    head = np.array([root, len(frozen), len(to), len(outputs), len(tails)], "<i8")
    arrays = [(first, "<i4"), (to, "<i4"), (out_at, "<i4"), (outputs, "<i4"), (end_at, "<i4"), (tails, "<i4"), (byte_of, "u1"), (ends, "u1")]
    return head.tobytes() + b"".join(np.array(values, kind).tobytes() for values, kind in arrays)


class Lexicon:
    """Look-ups in a flat buffer, for many words at once."""

    def __init__(self, buffer):
        self.root, states, arcs, outputs, tails = (int(x) for x in np.frombuffer(buffer, "<i8", 5))
        at = 40

        def take(n: int, kind: str) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(buffer, kind, n, at)
            at += found.nbytes
            return found

        first = take(states + 1, "<i4")
        self.to, self.out_at, self.outputs = take(arcs, "<i4"), take(arcs + 1, "<i4"), take(outputs, "<i4")
        self.end_at, self.tails = take(states + 1, "<i4"), take(tails, "<i4")
        byte_of, self.ends = take(arcs, "u1"), take(states, "u1")
        self.store = np.concatenate([self.outputs, self.tails]).astype("<u4")
        # Arcs lie in order of their state, and of their byte inside it, so one number finds an arc.
        self.key = np.repeat(np.arange(states, dtype=np.int64), np.diff(first)) * 256 + byte_of

    @classmethod
    def mapped(cls, buffer: bytes) -> Lexicon:
        """The lexicon in memory mapped pages that the tasks of a worker share."""
        pages = mmap.mmap(-1, max(1, len(buffer)))
        pages.write(buffer)
        return cls(pages)

    def ids(self, words: list[bytes]) -> list[bytes | None]:
        """The ids of each word as little-endian 32-bit numbers, None for a word that is not in the lexicon."""
        size = np.array([len(w) for w in words], np.int64)
        begin = np.concatenate([[0], np.cumsum(size)])
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        state = np.full(len(words), self.root, np.int64)
        live = np.arange(len(words))
        known = np.zeros(len(words), bool)
        who, first, n = [], [], []  # pieces of output: of which word, where they begin in the stores, how long they are
        for depth in range(int(size.max(initial=0)) + 1):
            over = size[live] == depth
            done = live[over]
            known[done] = self.ends[state[done]] == 1
            live = live[~over]
            if not len(live) or not len(self.key):
                break
            key = state[live] * 256 + data[begin[live] + depth]
            arc = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            hit = self.key[arc] == key
            live, arc = live[hit], arc[hit]
            state[live] = self.to[arc]
            some = self.out_at[arc + 1] > self.out_at[arc]
            who.append(live[some])
            first.append(self.out_at[arc[some]])
            n.append(self.out_at[arc[some] + 1] - self.out_at[arc[some]])
        ending = np.flatnonzero(known)
        who.append(ending)
        first.append(len(self.outputs) + self.end_at[state[ending]])
        n.append(self.end_at[state[ending] + 1] - self.end_at[state[ending]])
        who, first, n = (np.concatenate(x).astype(np.int64) for x in (who, first, n))
        order = np.argsort(who, kind="stable")
        who, first, n = who[order], first[order], n[order]
        good = known[who]
        who, first, n = who[good], first[good], n[good]
        flat = self.store[spread(first, n)].tobytes()
        total = np.bincount(who, weights=n, minlength=len(words)).astype(np.int64) * 4
        at = np.concatenate([[0], np.cumsum(total)]).tolist()
        return [flat[a:b] if k else None for k, a, b in zip(known.tolist(), at, at[1:])]
