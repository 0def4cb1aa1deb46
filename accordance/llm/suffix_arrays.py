"""Suffix arrays of shards of byte strings, and the common prefixes of neighbours, in numpy.

A shard is a number of strings, each closed by an end sign that is no byte and equals nothing.  Suffixes are ordered
by Larsson and Sadakane's refinement: they are sorted by their first seven signs, and in each round only the groups that are
still equal are sorted again, by the ranks of what follows, which doubles the length looked at.  Common prefixes follow
Kasai's rule that a suffix shares with its predecessor at least one sign less than the suffix before it in the text: where
the predecessor moves along with the text the length falls by one, elsewhere it is compared.
"""

from __future__ import annotations

import numpy as np

END = 256
_FAR = 8


class Shard:
    """Strings one after another, as signs with ends between them."""

    def __init__(self, strings: list[bytes]):
        self.starts = np.cumsum([0] + [len(s) + 1 for s in strings])[:-1]
        size = int(sum(len(s) + 1 for s in strings))
        self.signs = np.full(size, END, np.uint16)
        data = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
        inside = np.ones(size, bool)
        inside[self.starts[1:] - 1] = False
        inside[-1:] = False
        self.signs[inside] = data[inside]

    def suffixes(self, depth: int) -> np.ndarray:
        """The suffix array, in the order of at least the first ``depth`` signs of each suffix."""
        n = len(self.signs)
        # Seven signs of nine bits make a first key.
        key = np.zeros(n, np.uint64)
        for k in range(min(7, n)):
            key[: n - k] |= (self.signs[k:].astype(np.uint64) + np.uint64(1)) << np.uint64(9 * (6 - k))
        order = np.argsort(key, kind="stable").astype(np.int64)
        ranks = _ranks(order, key[order])
        del key
        length = 7
        while length < depth:
            first = np.flatnonzero(_open(ranks[order]))
            if not len(first):
                break
            own = order[first]
            follow = own + length
            second = np.where(follow < n, ranks[np.minimum(follow, n - 1)] + 1, 0)
            group = ranks[own]
            key = (group.astype(np.uint64) << np.uint64(32)) | second.astype(np.uint64)
            again = np.argsort(key, kind="stable")
            # Groups lie together in the order, so sorting by group first keeps their places.
            own, key = own[again], key[again]
            order[first] = own
            new = np.append(True, key[1:] != key[:-1])
            at = np.flatnonzero(new)
            ranks[own] = first[at][np.cumsum(new) - 1]
            length *= 2
        return order

    def common(self, order: np.ndarray) -> np.ndarray:
        """How many signs each suffix of the array shares with the one before it; ends equal nothing."""
        n = len(order)
        before = np.full(n, -1, np.int64)
        before[order[1:]] = order[:-1]
        shared = np.zeros(n, np.int64)
        moves = np.zeros(n, bool)  # the predecessor moves along, and the sign left behind was shared
        moves[1:] = (before[1:] == before[:-1] + 1) & (before[:-1] >= 0)
        left = np.flatnonzero(moves)
        a, b = self.signs[left - 1], self.signs[before[left - 1]]
        moves[left] = (a == b) & (a != END)
        heads = np.flatnonzero(~moves & (before >= 0))
        shared[heads] = self._compared(heads, before[heads])
        # A suffix that moves along shares one sign less than the one before it in the text.
        head = np.maximum.accumulate(np.where(moves, 0, np.arange(n)))
        shared = np.where(moves, shared[head] - (np.arange(n) - head), shared)
        return shared[order]

    def _compared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many signs the suffixes at a and b share."""
        n = len(self.signs)
        out = np.zeros(len(a), np.int64)
        left = np.arange(len(a))
        step = np.arange(_FAR)
        while len(left):
            x = np.minimum((a[left] + out[left])[:, None] + step, n - 1)
            y = np.minimum((b[left] + out[left])[:, None] + step, n - 1)
            same = (self.signs[x] == self.signs[y]) & (self.signs[x] != END)
            run = np.where(same.all(1), _FAR, same.argmin(1))
            out[left] += run
            left = left[run == _FAR]
        return out


def _open(ranks: np.ndarray) -> np.ndarray:
    """Places of an array of ranks in order that belong to groups of two or more."""
    same = ranks[1:] == ranks[:-1]
    return np.append(False, same) | np.append(same, False)


def _ranks(order: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The rank of each suffix: the first place of its group."""
    ranks = np.empty(len(order), np.int64)
    new = np.append(True, key[1:] != key[:-1])
    at = np.flatnonzero(new)
    ranks[order] = at[np.cumsum(new) - 1]
    return ranks
