"""Weighted acyclic automata over words: count transducers from n-grams to numbers.

A transducer holds n-grams of ORDER words each as paths from its root; the arc that ends a path carries its weight. Its
states are kept by depth, each level as arrays of arcs (label, weight, target) in the order of states and labels,
and labels number a sorted table of words, so that paths come in the order of their words' bytes.

N-grams are added in sorted order: a state is complete once the next n-gram leaves its prefix, and complete states are
looked up in a register, from the deepest up, so that equal states (the same continuations with the same weights) are
stored once.

The union of transducers walks all of them side by side from their roots and sums the weights of equal paths. A
composition walks an acceptor of wanted n-grams and a transducer side by side and returns the weights of the
wanted ones, in their order.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np


class Level:
    """The arcs from the states of one depth: those of state s are start[s] to start[s + 1]; target is a state of the next depth."""

    def __init__(self, start: np.ndarray, label: np.ndarray, weight: np.ndarray, target: np.ndarray):
        self.start, self.label, self.weight, self.target = start, label, weight, target


def _ramp(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ..., sizes[0] - 1, 0, 1, ..."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _registered(level: Level) -> tuple[Level, np.ndarray]:
    """The level with equal states stored once, and the new number of each state."""
    sizes = np.diff(level.start)
    number = np.empty(len(sizes), np.int64)
    row = np.empty(len(level.label), [("label", np.int64), ("weight", np.int64), ("target", np.int64)])
    row["label"], row["weight"], row["target"] = level.label, level.weight, level.target
    register: dict[bytes, int] = {}
    kept = []
    data, width = row.tobytes(), row.dtype.itemsize
    starts = level.start * width
    for s in range(len(sizes)):
        key = data[starts[s] : starts[s + 1]]
        n = register.get(key)
        if n is None:
            n = register[key] = len(kept)
            kept.append(s)
        number[s] = n
    kept = np.array(kept, np.int64)
    arcs = np.repeat(level.start[kept], sizes[kept]) + _ramp(sizes[kept])
    return Level(np.r_[0, np.cumsum(sizes[kept])], level.label[arcs], level.weight[arcs], level.target[arcs]), number


class Transducer:
    def __init__(self, words: Sequence[bytes], levels: list[Level]):
        self.words, self.levels = list(words), levels

    @classmethod
    def of(cls, words: Sequence[bytes], rows: np.ndarray, weights: np.ndarray) -> Transducer:
        """From distinct n-grams in sorted order: rows of labels, which number the sorted words."""
        n, order = rows.shape
        levels, number = [], np.full(n, -1, np.int64)
        fresh = np.zeros(n, bool)
        news = []
        for d in range(order):
            if n:
                fresh[0] = True
                fresh[1:] |= rows[1:, d] != rows[:-1, d]
            news.append(np.flatnonzero(fresh))
        for d in range(order - 1, -1, -1):
            at = news[d]  # the arcs of this depth; the state they leave is new where the depth above has an arc
            start = np.searchsorted(at, news[d - 1]) if d else np.array([0])
            level = Level(np.r_[start, len(at)], rows[at, d], weights[at] if d == order - 1 else np.zeros(len(at), np.int64), number if d < order - 1 else np.full(len(at), -1, np.int64))
            if d:
                level, number = _registered(level)
            levels.append(level)
        return cls(words, levels[::-1])

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """The n-grams as rows of labels, in sorted order, and their weights."""
        state, columns, weight = np.zeros(1, np.int64), [], np.zeros(1, np.int64)
        for level in self.levels:
            sizes = level.start[state + 1] - level.start[state]
            arcs = np.repeat(level.start[state], sizes) + _ramp(sizes)
            columns = [np.repeat(c, sizes) for c in columns] + [level.label[arcs]]
            state, weight = level.target[arcs], level.weight[arcs]
        return np.stack(columns, axis=1).astype(np.int64).reshape(-1, len(self.levels)), weight

    def weights_of(self, wanted: Transducer) -> np.ndarray:
        """Composition with an acceptor of the same order: the weight of each of its n-grams in sorted order, 0 for what is not here."""
        mine = {w: i for i, w in enumerate(self.words)}
        known = np.array([mine.get(w, -1) for w in wanted.words] or [-1], np.int64)
        theirs, here, weight = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
        span = max(len(self.words), 1)
        for a, b in zip(wanted.levels, self.levels, strict=True):
            sizes = a.start[theirs + 1] - a.start[theirs]
            arcs = np.repeat(a.start[theirs], sizes) + _ramp(sizes)
            label, at = known[a.label[arcs]], np.repeat(here, sizes)
            keys = np.repeat(np.arange(len(b.start) - 1), np.diff(b.start)) * span + b.label
            key = at * span + label
            spot = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
            met = (at >= 0) & (label >= 0) & ((keys[spot] == key) if len(keys) else False)
            theirs, here, weight = a.target[arcs], np.where(met, b.target[spot] if len(keys) else -1, -1), np.where(met, b.weight[spot] if len(keys) else 0, 0)
        return weight

    def at_least(self, least: int) -> Transducer:
        """The n-grams of that weight or more."""
        rows, weights = self.paths()
        rows, weights = rows[weights >= least], weights[weights >= least]
        used, labels = np.unique(rows, return_inverse=True)
        return Transducer.of([self.words[i] for i in used], labels.reshape(rows.shape), weights)

    def to_bytes(self) -> bytes:
        arrays: list[np.ndarray] = []
        for x in self.levels:
            arrays += [np.diff(x.start), x.label, x.weight, x.target + 1]
        arrays = [a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0)) for a in arrays]
        text = b" ".join(self.words)
        head = [len(self.levels), len(self.words), len(text), *[v for a in arrays for v in (len(a), a.dtype.itemsize)]]
        return np.array(head, np.int64).tobytes() + text + b"".join(a.tobytes() for a in arrays)

    @classmethod
    def from_bytes(cls, data: bytes) -> Transducer:
        n_levels, n_words, n_text = (int(x) for x in np.frombuffer(data, np.int64, 3))
        sizes = np.frombuffer(data, np.int64, 8 * n_levels, 24).reshape(-1, 2)
        at = 24 + 64 * n_levels
        words = data[at : at + n_text].split(b" ") if n_words else []
        at += n_text
        arrays = []
        for n, width in sizes.tolist():
            arrays.append(np.frombuffer(data, np.dtype(f"u{width}"), n, at).astype(np.int64))
            at += n * width
        return cls(words, [Level(np.r_[0, np.cumsum(a)], b, c, d - 1) for a, b, c, d in (arrays[i : i + 4] for i in range(0, len(arrays), 4))])


def union(some: Sequence[Transducer]) -> Transducer:
    """The sum of transducers of one order: weights of equal n-grams are added."""
    words = sorted(set().union(*(t.words for t in some)))
    number = {w: i for i, w in enumerate(words)}
    renamed = [np.array([number[w] for w in t.words] or [0], np.int64) for t in some]
    union_state, state = np.zeros(len(some), np.int64), np.arange(len(some))
    levels = []
    for d in range(len(some[0].levels)):
        parts = [t.levels[d] for t in some]
        # all states of this depth, one transducer after another
        n_states = np.array([len(p.start) - 1 for p in parts])
        n_arcs = np.array([len(p.label) for p in parts])
        first_arc = np.cumsum(n_arcs) - n_arcs
        start = np.concatenate([p.start[:-1] + f for p, f in zip(parts, first_arc, strict=True)])
        degree = np.concatenate([np.diff(p.start) for p in parts])
        label = np.concatenate([r[p.label] for p, r in zip(parts, renamed, strict=True)])
        weight = np.concatenate([p.weight for p in parts])
        below = np.array([len(t.levels[d + 1].start) - 1 if d + 1 < len(t.levels) else 0 for t in some])
        shift = np.cumsum(below) - below
        target = np.concatenate([np.where(p.target >= 0, p.target + f, -1) for p, f in zip(parts, shift, strict=True)])
        assert n_states.sum() == len(start)
        sizes = degree[state]
        arcs = np.repeat(start[state], sizes) + _ramp(sizes)
        keys = np.repeat(union_state, sizes) * max(len(words), 1) + label[arcs]
        order = np.argsort(keys, kind="stable")
        keys, arcs = keys[order], arcs[order]
        fresh = np.r_[True, keys[1:] != keys[:-1]] if len(keys) else np.empty(0, bool)
        first = np.flatnonzero(fresh)
        sums = np.add.reduceat(weight[arcs], first) if len(first) else np.empty(0, np.int64)
        at, names = np.divmod(keys[first], max(len(words), 1))
        n_union = int(union_state.max()) + 1 if len(union_state) else 0
        down = d + 1 < len(some[0].levels)
        levels.append(Level(np.searchsorted(at, np.arange(n_union + 1)), names, sums, np.arange(len(first)) if down else np.full(len(first), -1, np.int64)))
        union_state, state = np.cumsum(fresh) - 1, target[arcs]
    return Transducer(words, levels)


def split(words: Sequence[bytes], rows: np.ndarray, weights: np.ndarray, where: np.ndarray) -> Iterator[tuple[int, Transducer]]:
    """A transducer for each range: n-grams in sorted order with the range of each."""
    if not len(where):
        return
    order = np.argsort(where, kind="stable")
    cuts = np.flatnonzero(np.r_[True, where[order][1:] != where[order][:-1]])
    for lo, hi in zip(cuts, [*cuts[1:], len(order)], strict=True):
        own = order[lo:hi]
        mine = rows[own]
        used = np.zeros(len(words), bool)
        used[mine.ravel()] = True
        number = np.cumsum(used) - 1
        yield int(where[own[0]]), Transducer.of([words[i] for i in np.flatnonzero(used)], number[mine], weights[own])
