"""Words of many texts at once, as hashes.

Texts are taken as UTF-8 bytes, about a megabyte at a time (a longer text by itself).  A word is a run of
letters, digits and bytes outside ASCII; marks are runs of other printable characters; what is left separates.
A-Z and the accented Latin capitals are lower-cased for hashes.  A hash is a polynomial of the
bytes modulo 2^64, read off from sums over the whole chunk, so nothing is done word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

CHUNK = 1 << 20
SPACE, WORD, MARK = 0, 1, 2
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_CLASS = np.full(256, MARK, np.uint8)
_CLASS[:33] = SPACE
_CLASS[127] = SPACE
_CLASS[128:] = WORD
for _first, _last in (("0", "9"), ("A", "Z"), ("a", "z")):
    _CLASS[ord(_first) : ord(_last) + 1] = WORD


def mixed(h: np.ndarray) -> np.ndarray:
    """All bits of the hash depend on all of its bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class _Powers:
    """Powers of the base and of its inverse, as many as the longest chunk so far has bytes."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            ups, downs = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
            ups[0] = downs[0] = 1
            self.up, self.down = np.multiply.accumulate(ups), np.multiply.accumulate(downs)


_POWERS = _Powers()


@dataclass
class Runs:
    """The runs of a chunk of texts, in order."""

    doc: np.ndarray  # which text of the chunk
    kind: np.ndarray  # WORD or MARK
    hash: np.ndarray
    shape: np.ndarray  # of words: 0 lower or mixed case, 1 capitals, 2 digits; of marks: the hash
    prefix: np.ndarray | None  # hash of the first bytes

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """doc and hash of the words."""
        own = self.kind == WORD
        return self.doc[own], self.hash[own]


def chunks(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """Where a chunk starts, and its texts."""
    start, size, out = 0, 0, []
    for n, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass") if text else b""
        if out and size + len(data) > CHUNK:
            yield start, out
            start, size, out = n, 0, []
        out.append(data)
        size += len(data) + 1
    if out:
        yield start, out


def runs(texts: list[bytes], prefix: int = 0, shapes: bool = False) -> Runs:
    """The runs of texts; with hashes of the first ``prefix`` bytes of each if asked for."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    bounds = np.cumsum([len(t) + 1 for t in texts])
    kinds = _CLASS[data]
    low = data.copy()
    capital = (data >= 65) & (data <= 90)
    low[capital] += 32
    accented = np.flatnonzero(data[:-1] == 0xC3) + 1
    accented = accented[(data[accented] >= 0x80) & (data[accented] <= 0x9E) & (data[accented] != 0x97)]
    low[accented] += 32
    starts = np.concatenate([[0], np.flatnonzero(kinds[1:] != kinds[:-1]) + 1])
    ends = np.append(starts[1:], len(data))
    own = kinds[starts] != SPACE
    starts, ends = starts[own], ends[own]
    _POWERS.grow(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * _POWERS.up[: len(data)], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * _POWERS.down[starts])
    doc = np.searchsorted(bounds, starts, side="right")
    kind = kinds[starts]
    firsts = None
    if prefix:
        cut = np.minimum(ends, starts + prefix)
        firsts = mixed((sums[cut] - sums[starts]) * _POWERS.down[starts])
    shape = hashes
    if shapes:
        ups = np.concatenate([[0], np.cumsum(capital, dtype=np.int64)])
        lows = np.concatenate([[0], np.cumsum((data >= 97) & (data <= 122), dtype=np.int64)])
        digits = np.concatenate([[0], np.cumsum((data >= 48) & (data <= 57), dtype=np.int64)])
        size = ends - starts
        caps = (ups[ends] - ups[starts] > 0) & (lows[ends] == lows[starts]) & (size > 1)
        number = digits[ends] - digits[starts] == size
        of_word = np.where(number, 2, np.where(caps, 1, 0)).astype(np.uint64)
        shape = np.where(kind == WORD, of_word, hashes)
    return Runs(doc, kind, hashes, shape, firsts)
