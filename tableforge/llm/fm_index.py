"""A bidirectional FM-index over delimited words, with all queries of a block advancing together in numpy.

The text is the block's words with a delimiter (0) before, between and after them; words are Latin-1 letters, so a symbol
is a byte. One index is over the text, one over its reverse. A pattern's occurrences are an interval of suffix ranks in
either; both are kept, so a pattern can grow to the left or to the right. Ranks come from a wavelet matrix (a level per
bit), which also says how many smaller symbols an interval holds: by that number the other side's interval moves.
"""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray) -> np.ndarray:
    """The suffixes' starts in order, by prefix doubling (rounds grow with the log of the longest repeat)."""
    n, step = len(text), 1
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    while True:
        follow = np.zeros(n, np.int64)
        follow[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + follow
        order = np.argsort(key, kind="stable")
        new = np.zeros(n, np.int64)
        new[order[1:]] = np.cumsum(key[order[1:]] != key[order[:-1]])
        rank = new
        if rank[order[-1]] == n - 1:
            return order
        step *= 2


class Wavelet:
    """Ranks of bytes in a sequence: eight levels of zero counts."""

    def __init__(self, symbols: np.ndarray):
        self.zeros, self.split = [], []
        s = symbols.astype(np.uint8)
        for bit in range(7, -1, -1):
            one = (s >> bit & 1).astype(bool)
            self.zeros.append(np.append(np.int32(0), np.cumsum(~one, dtype=np.int32)))
            self.split.append(int(self.zeros[-1][-1]))
            s = np.concatenate([s[~one], s[one]])

    def step(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each symbol: its occurrences before lo and before hi, and how many smaller symbols lie in [lo, hi)."""
        base, less = np.zeros_like(lo), np.zeros_like(lo)
        lo, hi = lo.copy(), hi.copy()
        for bit, zeros, split in zip(range(7, -1, -1), self.zeros, self.split, strict=True):
            one = (symbol >> bit & 1).astype(bool)
            a, b, c = zeros[lo], zeros[hi], zeros[base]
            less += np.where(one, b - a, 0)
            lo, hi = np.where(one, lo - a + split, a), np.where(one, hi - b + split, b)
            base = np.where(one, base - c + split, c)
        return lo - base, hi - base, less

    def kinds(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(interval, symbol) of every different symbol in each interval."""
        row, symbol = np.arange(len(lo)), np.zeros(len(lo), np.int64)
        for bit, zeros, split in zip(range(7, -1, -1), self.zeros, self.split, strict=True):
            a, b = zeros[lo], zeros[hi]
            left, right = b > a, hi - b > lo - a
            row, symbol = np.concatenate([row[left], row[right]]), np.concatenate([symbol[left], symbol[right] | 1 << bit])
            lo, hi = np.concatenate([a[left], (lo - a + split)[right]]), np.concatenate([b[left], (hi - b + split)[right]])
        return row, symbol


class Index:
    """Interval states are (start in the text's suffix order, start in the reverse's, size)."""

    def __init__(self, words: list[bytes]):
        text = np.frombuffer(b"\0" + b"\0".join(words) + b"\0", np.uint8)
        self.starts = np.append(0, np.cumsum([len(w) + 1 for w in words]))  # of the delimiter before each word
        self.first = np.searchsorted(np.sort(text), np.arange(257))  # symbols that are smaller
        self.size = len(text)
        self.order, self.waves = suffix_order(text), []
        back = suffix_order(text[::-1])
        self.waves = [Wavelet(text[self.order - 1]), Wavelet(text[::-1][back - 1])]  # to the left, to the right

    def all(self, n: int) -> list[np.ndarray]:
        return [np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, self.size, np.int64)]

    def grow(self, state: list[np.ndarray], symbol: np.ndarray, right: bool) -> list[np.ndarray]:
        """The states of the patterns that have one more symbol at their left or right end; size 0: no occurrence."""
        own, other = state[right], state[1 - right]
        lo, hi, less = self.waves[right].step(symbol, own, own + state[2])
        moved = self.first[symbol] + lo
        return [other + less, moved, hi - lo] if right else [moved, other + less, hi - lo]

    def next_symbols(self, state: list[np.ndarray], right: bool) -> tuple[np.ndarray, np.ndarray]:
        return self.waves[right].kinds(state[right], state[right] + state[2])

    def words_at(self, state: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(state, word) of every occurrence; the patterns begin with the delimiter."""
        n = state[2]
        row = np.repeat(np.arange(len(n)), n)
        place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        return row, np.searchsorted(self.starts, self.order[state[0][row] + place])


def one_error(index: Index, queries: list[bytes], right: bool) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) of all words at one inserted, deleted or replaced symbol from a query that match its first half
    exactly (``right``: the search then goes to the right) or its second half. A pair comes once."""
    none = np.zeros(0, np.int64)
    if not queries or not len(index.starts) - 1:
        return none, none
    size = np.array([len(q) for q in queries])
    half = size // 2 if right else size - size // 2
    table = np.zeros((len(queries), int(size.max()) + 1), np.int64)  # in the direction of the search, 0 behind the end
    for k, q in enumerate(queries):
        table[k, : len(q)] = np.frombuffer(q if right else q[::-1], np.uint8)

    def some(keep: np.ndarray, row, at, state):
        return row[keep], at[keep], [s[keep] for s in state]

    row, at, state = np.arange(len(queries)), np.zeros(len(queries), np.int64), index.all(len(queries))
    state = index.grow(state, np.zeros(len(row), np.int64), right)
    clean, ready = [], np.zeros(0, bool)
    while len(row):  # the exact half, queries that have it go on to the other
        ready = at == half[row]
        clean.append((row[ready], at[ready], [s[ready] for s in state]))
        row, at, state = some(~ready, row, at, state)
        state = index.grow(state, table[row, at], right)
        row, at, state = some(state[2] > 0, row, at + 1, state)
    row, at = (np.concatenate([c[k] for c in clean]) for k in (0, 1))
    state = [np.concatenate([c[2][k] for c in clean]) for k in range(3)]

    errors, hits = [], []  # patterns with their error, by how much they still have to match
    while len(row):  # without an error so far
        edge = at == size[row]
        owner, symbol = index.next_symbols(state, right)
        letter = symbol > 0
        owner, symbol = owner[letter], symbol[letter]
        grown = index.grow([s[owner] for s in state], symbol, right)
        errors.append((row[owner], at[owner], grown))  # inserted
        other = ~edge[owner] & (symbol != table[row[owner], at[owner]])
        errors.append((row[owner][other], at[owner][other] + 1, [s[other] for s in grown]))  # replaced
        row, at, state = some(~edge, row, at, state)
        errors.append((row, at + 1, state))  # deleted
        state = index.grow(state, table[row, at], right)
        row, at, state = some(state[2] > 0, row, at + 1, state)
    row, at = (np.concatenate([e[k] for e in errors]) for k in (0, 1))
    state = [np.concatenate([e[2][k] for e in errors]) for k in range(3)]
    while len(row):  # the rest without a further one; behind the query's end comes the delimiter
        edge = at == size[row]
        state = index.grow(state, table[row, at], right)
        done = edge & (state[2] > 0)
        hits.append((row[done], [s[done] for s in state]))
        row, at, state = some(~edge & (state[2] > 0), row, at + 1, state)
    row = np.concatenate([h[0] for h in hits]) if hits else none
    found, word = index.words_at([np.concatenate([h[1][k] for h in hits]) for k in range(3)]) if hits else (none, none)
    real = word < len(index.starts) - 1  # the text goes on at its beginning: its last delimiter is followed by the first
    pairs = np.unique(np.stack([row[found[real]], word[real]], 1), axis=0) if real.any() else np.zeros((0, 2), np.int64)
    return pairs[:, 0], pairs[:, 1]
