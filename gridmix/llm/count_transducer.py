"""Weighted acyclic automata that hold counts of phrases.

A path of words from the start state spells a phrase; the sum of its arcs' weights is the phrase's count.  Weights are
differences to the count of the phrase without its last word, so what follows a word rarely depends on where it came from:
phrases that go on alike share states.  Counts of 0 are phrases that don't count themselves and only lead to longer ones.

``Levels`` is the working form: distinct phrases in byte order, by length, each with the place of its phrase without the last
word.  All steps on it are array operations.  ``pack`` builds the minimal automaton of it.  Input is sorted, so a state is
complete when the next phrase leaves it, and states are settled from the longest phrases back; a complete state that is
equal to an earlier one (same words, weights and targets) becomes that one.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

_LOW = (1 << 32) - 1


class Levels(NamedTuple):
    """Level k (from 0) holds the phrases of k + 1 words, sorted by (parent, word)."""

    vocabulary: list[bytes]      # sorted
    parent: list[np.ndarray]     # place in the level before; level 0 has zeros
    word: list[np.ndarray]       # place in the vocabulary
    count: list[np.ndarray]

    @property
    def size(self) -> int:
        return sum(len(w) for w in self.word)

    def words(self, level: int) -> np.ndarray:
        """A row of word places for every phrase of a level."""
        at, columns = np.arange(len(self.word[level])), []
        for k in range(level, -1, -1):
            columns.append(self.word[k][at])
            at = self.parent[k][at]
        return np.stack(columns[::-1], axis=1)


def _summed(key: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the sums of their counts, and each row's place among the keys."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    place = np.empty(len(key), np.int64)
    place[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return key[first], np.add.reduceat(count[order], first) if len(first) else count[:0], place


def from_tokens(tokens: np.ndarray, vocabulary: list[bytes], longest: int) -> Levels:
    """Counts of all phrases of up to ``longest`` words; -1 between tokens parts pieces."""
    at = np.flatnonzero(tokens >= 0)
    place = np.zeros(len(tokens), np.int64)
    parent, word, count = [], [], []
    for k in range(longest):
        if k:
            at = at[at + k < len(tokens)]
            at = at[tokens[at + k] >= 0]
        key, n, here = _summed(place[at] << 32 | tokens[at + k], np.ones(len(at), np.int64))
        parent.append(key >> 32)
        word.append(key & _LOW)
        count.append(n)
        place[at] = here
    return Levels(vocabulary, parent, word, count)


def from_phrases(groups: list[np.ndarray], vocabulary: list[bytes]) -> tuple[Levels, list[np.ndarray]]:
    """The phrases of matrices of word places (one phrase a row) with count 1, those that only lead to them with 0; and the
    place of each matrix's rows in their level."""
    places = [np.zeros(len(g), np.int64) for g in groups]
    parent, word, count = [], [], []
    for k in range(max((g.shape[1] for g in groups), default=0)):
        going = [i for i, g in enumerate(groups) if g.shape[1] > k]
        key = np.concatenate([places[i] << 32 | groups[i][:, k] for i in going])
        final = np.concatenate([np.full(len(groups[i]), int(groups[i].shape[1] == k + 1)) for i in going])
        key, n, here = _summed(key, final)
        parent.append(key >> 32)
        word.append(key & _LOW)
        count.append(np.minimum(n, 1))
        for i, part in zip(going, np.split(here, np.cumsum([len(groups[i]) for i in going])[:-1])):
            places[i] = part
    return _compact(vocabulary, parent, word, count), places


def _compact(vocabulary, parent, word, count) -> Levels:
    """Only the words that occur."""
    used = np.unique(np.concatenate(word)) if word else np.zeros(0, np.int64)
    return Levels([vocabulary[i] for i in used.tolist()], parent, [np.searchsorted(used, w) for w in word], count)


def union(parts: list[Levels]) -> Levels:
    """All phrases of the parts, counts summed."""
    if len(parts) == 1:
        return parts[0]
    vocabulary = sorted(set().union(*(p.vocabulary for p in parts)))
    rank = {w: i for i, w in enumerate(vocabulary)}
    ranks = [np.fromiter((rank[w] for w in p.vocabulary), np.int64, len(p.vocabulary)) for p in parts]
    before = [np.zeros(1, np.int64) for _ in parts]
    parent, word, count = [], [], []
    for k in range(max((len(p.word) for p in parts), default=0)):
        going = [i for i, p in enumerate(parts) if len(p.word) > k]
        key, n, here = _summed(
            np.concatenate([before[i][parts[i].parent[k]] << 32 | ranks[i][parts[i].word[k]] for i in going]),
            np.concatenate([parts[i].count[k] for i in going]))
        parent.append(key >> 32)
        word.append(key & _LOW)
        count.append(n)
        for i, part in zip(going, np.split(here, np.cumsum([len(parts[i].word[k]) for i in going])[:-1])):
            before[i] = part
    return Levels(vocabulary, parent, word, count)


def at_least(levels: Levels, least: int) -> Levels:
    """Phrases with that count or more, and those that lead to them (which keep their own count if it is 0)."""
    keep = [n >= least for n in levels.count]
    for k in range(len(keep) - 1, 0, -1):
        keep[k - 1][levels.parent[k][keep[k]]] = True
    place = [np.cumsum(x) - 1 for x in keep]
    parent = [p[x] if k == 0 else place[k - 1][p[x]] for k, (p, x) in enumerate(zip(levels.parent, keep))]
    return _compact(levels.vocabulary, parent, [w[x] for w, x in zip(levels.word, keep)],
                    [n[x] for n, x in zip(levels.count, keep)])


def compose(asked: Levels, counts: Levels) -> Levels:
    """The phrases of ``asked`` with their counts in ``counts``: 0 where that has none, or ``asked`` has 0."""
    rank = {w: i for i, w in enumerate(counts.vocabulary)}
    ranks = np.fromiter((rank.get(w, -1) for w in asked.vocabulary), np.int64, len(asked.vocabulary))
    node, found = np.zeros(1, np.int64), []
    for k in range(len(asked.word)):
        n = len(asked.word[k])
        if k >= len(counts.word) or not len(counts.word[k]):
            node = np.full(n, -1)
            found.append(np.zeros(n, np.int64))
            continue
        above, word = node[asked.parent[k]], ranks[asked.word[k]]
        key = counts.parent[k] << 32 | counts.word[k]
        want = np.maximum(above, 0) << 32 | np.maximum(word, 0)
        at = np.minimum(np.searchsorted(key, want), len(key) - 1)
        hit = (above >= 0) & (word >= 0) & (key[at] == want)
        node = np.where(hit, at, -1)
        found.append(np.where(hit & (asked.count[k] > 0), counts.count[k][at], 0))
    return asked._replace(count=found)


def ranges(levels: Levels, lang: str, cuts: list[tuple[str, bytes, bytes]]) -> Iterator[tuple[int, Levels]]:
    """(range, its phrases) of one language's phrases.

    Cuts are sorted (language, first word, second word or empty); range r holds what is below cut r and not below cut r - 1.
    A phrase of three words or more is where its first two are.  Phrases of a range that begins inside a word lead there
    with count 0."""
    vocabulary = levels.vocabulary

    def places(cut) -> list[int]:
        """How many phrases of each level are below the cut."""
        a = bisect_left(vocabulary, cut[1])
        same = a < len(vocabulary) and vocabulary[a] == cut[1]
        out = [int(np.searchsorted(levels.word[0], a, "right" if same and cut[2] else "left"))]
        for k in range(1, len(levels.word)):
            if k == 1:
                up = int(np.searchsorted(levels.word[0], a))
                second = bisect_left(vocabulary, cut[2]) if same and cut[2] else 0
                out.append(int(np.searchsorted(levels.parent[1] << 32 | levels.word[1], up << 32 | second)))
            else:
                out.append(int(np.searchsorted(levels.parent[k], out[-1])))
        return out

    if not len(levels.word[0]):
        return
    r = bisect_left(cuts, (lang, b"", b""))
    low = [0] * len(levels.word)
    while True:
        last = r >= len(cuts) or cuts[r][0] != lang
        high = [len(w) for w in levels.word] if last else places(cuts[r])
        if high != low:
            yield r, _part(levels, low, high)
        if last:
            return
        low, r = high, r + 1


def _part(levels: Levels, low: list[int], high: list[int]) -> Levels:
    first, end = low[0], high[0]
    if len(low) > 1 and high[1] > low[1]:
        first = min(first, int(levels.parent[1][low[1]]))
        end = max(end, int(levels.parent[1][high[1] - 1]) + 1)
    own = np.arange(first, end)
    start = [first, *low[1:]]
    parent, word, count = [], [], []
    for k, (lo, hi) in enumerate(zip(start, [end, *high[1:]])):
        parent.append(levels.parent[k][lo:hi] - (start[k - 1] if k else 0))
        word.append(levels.word[k][lo:hi])
        count.append(levels.count[k][lo:hi])
    count[0] = np.where((own >= low[0]) & (own < high[0]), count[0], 0)
    return _compact(levels.vocabulary, parent, word, count)


# --- automata -----------------------------------------------------------------------------------

class Automaton(NamedTuple):
    """State s has the arcs ``offset[s]`` to ``offset[s + 1]``.  State 0 has none; the last state is the start."""

    vocabulary: list[bytes]
    offset: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    target: np.ndarray


def _same(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A first row for each class of equal rows, and every row's class."""
    mixed = np.zeros(len(rows), np.uint64)
    for column in rows.T:
        mixed = (mixed ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed, kind="stable")
    ordered = rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)  # rows themselves decide
    classes = np.empty(len(rows), np.int64)
    classes[order] = np.cumsum(new) - 1
    return order[new], classes


def build(levels: Levels) -> Automaton:
    """The automaton of the phrases, equal states made one."""
    states, arcs, sizes = 1, [], [np.zeros(1, np.int64)]
    depth = len(levels.word)
    target = np.zeros(len(levels.word[-1]), np.int64) if depth else np.zeros(0, np.int64)
    for k in range(depth - 1, 0, -1):
        weight = levels.count[k] - levels.count[k - 1][levels.parent[k]]
        n = np.bincount(levels.parent[k], minlength=len(levels.word[k - 1]))
        begin = np.cumsum(n) - n
        state = np.zeros(len(n), np.int64)  # no arcs: state 0
        for size in np.unique(n[n > 0]).tolist():
            nodes = np.flatnonzero(n == size)
            at = begin[nodes][:, None] + np.arange(size)
            rows = np.concatenate([levels.word[k][at], weight[at], target[at]], axis=1)
            first, classes = _same(rows) if len(nodes) > 1 else (np.zeros(1, np.int64), np.zeros(1, np.int64))
            state[nodes] = states + classes
            states += len(first)
            arcs.append(rows[first].reshape(len(first), 3, size).transpose(1, 0, 2).reshape(3, -1))
            sizes.append(np.full(len(first), size))
        target = state
    if depth:
        arcs.append(np.stack([levels.word[0], levels.count[0], target]))
        sizes.append(np.array([len(levels.word[0])]))
    flat = np.concatenate(arcs, axis=1) if arcs else np.zeros((3, 0), np.int64)
    return Automaton(levels.vocabulary, np.concatenate([[0], np.cumsum(np.concatenate(sizes))]), *flat)


def paths(automaton: Automaton) -> Levels:
    """All phrases of an automaton."""
    sizes = np.diff(automaton.offset)
    state, above = np.array([len(sizes) - 1]), np.zeros(1, np.int64)
    parent, word, count = [], [], []
    while len(state):
        n = sizes[state]
        up = np.repeat(np.arange(len(state)), n)
        arc = np.arange(len(up)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(automaton.offset[state], n)
        if not len(arc):
            break
        above = above[up] + automaton.weight[arc]
        parent.append(up)
        word.append(automaton.label[arc])
        count.append(above)
        state = automaton.target[arc]
    if not word:
        parent, word, count = ([np.zeros(0, np.int64)] for _ in range(3))
    return Levels(automaton.vocabulary, parent, word, count)


_KINDS = [np.dtype(x) for x in ("<i1", "<i2", "<i4", "<i8")]


def _narrow(values: np.ndarray) -> bytes:
    most = int(max(values.max(initial=0), -1 - values.min(initial=0)))
    code = next(i for i, k in enumerate(_KINDS) if most <= np.iinfo(k).max)
    return bytes([code]) + len(values).to_bytes(8, "little") + values.astype(_KINDS[code]).tobytes()


def pack(levels: Levels) -> bytes:
    """The automaton as bytes: words between spaces, then arrays of the narrowest kind."""
    a = build(levels)
    words = b" ".join(a.vocabulary)
    return b"".join([len(words).to_bytes(8, "little"), words,
                     *map(_narrow, (np.diff(a.offset), a.label, a.weight, a.target))])


def unpack(data: bytes) -> Levels:
    end = 8 + int.from_bytes(data[:8], "little")
    vocabulary, arrays = data[8:end].split(b" ") if end > 8 else [], []
    while end < len(data):
        kind, n = _KINDS[data[end]], int.from_bytes(data[end + 1:end + 9], "little")
        arrays.append(np.frombuffer(data, kind, n, end + 9).astype(np.int64))
        end += 9 + n * kind.itemsize
    return paths(Automaton(vocabulary, np.concatenate([[0], np.cumsum(arrays[0])]), *arrays[1:]))
