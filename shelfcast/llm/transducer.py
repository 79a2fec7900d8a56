"""Minimal acyclic transducer: a map from words to id sequences that shares prefixes and suffixes.

Words come in byte order. The states of the last word's path stay open; when the next word leaves that path, the
states behind the fork are closed, and a closed state equal to an earlier one (same arcs, targets and outputs) is that
state. Outputs are pushed towards the root as far as words agree, so that equal endings really are equal. The
automaton is a few flat arrays in one file, which tasks map into memory instead of loading it.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

#: First bytes of a file; a file of another layout is refused.
MAGIC = 0x58454C31
ARRAYS = (
    ("keys", np.int64), ("target", np.int32), ("arc_at", np.int32), ("arc_len", np.int32), ("final", np.int32),
    ("end_at", np.int32), ("end_len", np.int32), ("pool", np.int32),
)


def _common(a: tuple, b: tuple) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


class _Open:
    """A state whose arcs may still change: label -> [closed target, output]."""

    __slots__ = ("arcs", "final", "end")

    def __init__(self):
        self.arcs: dict[int, list] = {}
        self.final, self.end = False, ()


class Builder:
    def __init__(self):
        self.closed: dict[tuple, int] = {}
        self.path = [_Open()]
        self.last: bytes | None = None

    def _close(self, state: _Open) -> int:
        key = (state.final, state.end, tuple((label, t, out) for label, (t, out) in sorted(state.arcs.items())))
        return self.closed.setdefault(key, len(self.closed))

    def _close_behind(self, depth: int) -> None:
        while len(self.path) > depth + 1:
            state = self.path.pop()
            self.path[-1].arcs[self.last[len(self.path) - 1]][0] = self._close(state)

    def add(self, word: bytes, out: tuple[int, ...]) -> None:
        if self.last is not None and word <= self.last:
            raise ValueError("words must come once each, in byte order")
        shared = _common(self.last or b"", word)
        self._close_behind(shared)
        for i in range(shared):
            arc, below = self.path[i].arcs[word[i]], self.path[i + 1]
            keep = _common(arc[1], out)
            rest, arc[1], out = arc[1][keep:], arc[1][:keep], out[keep:]
            if rest:
                for other in below.arcs.values():
                    other[1] = rest + other[1]
                if below.final:
                    below.end = rest + below.end
        for i in range(shared, len(word)):
            self.path[-1].arcs[word[i]] = [-1, out if i == shared else ()]
            self.path.append(_Open())
        self.path[-1].final = True
        if shared == len(word):  # the empty word, first of all
            self.path[-1].end = out
        self.last = word

    def arrays(self) -> dict[str, np.ndarray]:
        """Closes everything; the root is the state with the highest number."""
        self._close_behind(0)
        root = self._close(self.path[0])
        pool: list[int] = []
        places: dict[tuple, int] = {}

        def place(out: tuple) -> int:
            if out not in places:
                places[out] = len(pool)
                pool.extend(out)
            return places[out]

        arcs, ends = [], []
        for number, (final, end, outgoing) in enumerate(self.closed):
            ends.append((int(final), place(end), len(end)))
            arcs += [(number * 256 + label, t, place(out), len(out)) for label, t, out in outgoing]
        assert root == len(self.closed) - 1
        arc = np.array(arcs, np.int64).reshape(-1, 4)
        end = np.array(ends, np.int64).reshape(-1, 3)
        columns = (*arc.T, *end.T, np.array(pool, np.int64))
        return {name: np.ascontiguousarray(c, kind) for (name, kind), c in zip(ARRAYS, columns)}


def compile_words(words: Iterable[tuple[bytes, tuple[int, ...]]]) -> bytes:
    """A file's content: the automaton of the words with their ids; words in byte order."""
    builder = Builder()
    for word, out in words:
        builder.add(word, out)
    arrays = builder.arrays()
    header = np.array([MAGIC, *[len(arrays[name]) for name, _ in ARRAYS]], np.int64)
    parts = [header.tobytes()]
    for name, _ in ARRAYS:
        raw = arrays[name].tobytes()
        parts.append(raw + bytes(-len(raw) % 8))
    return b"".join(parts)


class Transducer:
    """Look words up in a compiled automaton; ``data`` is its bytes, a memory map as a rule."""

    def __init__(self, data: np.ndarray):
        header = data[: 8 * (len(ARRAYS) + 1)].view(np.int64)
        if header[0] != MAGIC:
            raise ValueError("not a lexicon file")
        at = 8 * len(header)
        for (name, kind), n in zip(ARRAYS, header[1:].tolist()):
            size = n * np.dtype(kind).itemsize
            setattr(self, name, data[at : at + size].view(kind))
            at += size + -size % 8
        self.root = len(self.final) - 1

    @classmethod
    def open(cls, path: str) -> Transducer:
        return cls(np.memmap(path, np.uint8, "r"))

    def lookup(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which words the lexicon has; the ids of those, end to end; where each of them starts and the last ends.

        All words walk the automaton side by side, one byte at a step, and leave when they end or find no arc.
        """
        n = len(words)
        sizes = np.fromiter(map(len, words), np.int64, n)
        starts = np.cumsum(sizes) - sizes
        text = np.frombuffer(b"".join(words), np.uint8)
        state = np.full(n, self.root, np.int64)
        alive = np.ones(n, bool)
        walked: list[tuple[np.ndarray, np.ndarray]] = []
        going = np.flatnonzero(sizes > 0)
        step = 0
        while len(going):
            if not len(self.keys):
                alive[going] = False
                break
            key = state[going] * 256 + text[starts[going] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[arc] == key
            alive[going[~hit]] = False
            going, arc = going[hit], arc[hit]
            state[going] = self.target[arc]
            walked.append((going, arc))
            step += 1
            going = going[sizes[going] > step]
        known = alive & (self.final[state] == 1)
        row = np.cumsum(known) - 1
        count = int(known.sum())
        at = np.zeros((count, len(walked) + 1), np.int64)
        size = np.zeros((count, len(walked) + 1), np.int64)
        for depth, (who, arc) in enumerate(walked):
            use = known[who]
            at[row[who[use]], depth] = self.arc_at[arc[use]]
            size[row[who[use]], depth] = self.arc_len[arc[use]]
        at[:, -1], size[:, -1] = self.end_at[state[known]], self.end_len[state[known]]
        flat = size.ravel()
        before = np.cumsum(flat) - flat
        ids = self.pool[np.repeat(at.ravel() - before, flat) + np.arange(int(flat.sum()))]
        return known, ids, np.concatenate([[0], np.cumsum(size.sum(axis=1))])
