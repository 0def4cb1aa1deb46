"""An adaptive range coder of token ids that codes many blocks side by side.

Each block starts anew and can be decoded alone.  The predictions of a block are

* order 2: the id that last followed the two ids before, with a confidence,
* order 1: the id that last followed the id before, with a confidence,
* order 0: how often the ids so far fall into each of 508 ranges of ids, brought up to date at
  places that double, with even chances within a range.

How often order 2 is right is estimated twice, by its own confidence and by both confidences, and the estimates are
mixed half and half; likewise for order 1 where order 2 is wrong.  So the events are "as order 2 says", "as order 1 says" and
"neither"; then comes the id by order 0.  Estimates move by a 32nd towards each outcome.
Chances drive a carry-less range coder with a state of 48 bits that sends 16 bits at a time.

Block number n is lane n of all arrays, so that one step of numpy codes one id of every block.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np

#: Ids of a block.
BLOCK = 2048
IDS = 1 << 16
_STATE, _TOP, _LEAST, _DIGIT = (1 << 48) - 1, 1 << 32, 1 << 32, 16
_SLOTS = 1024  # of the tables of predictions
_FINE = 1024  # smaller ids have ranges of 4, others of 256
_RANGES, _TOTAL = 256 + (IDS - _FINE >> 8), 1 << 12
#: Steps that ``encode`` prepares at once; updates fall between them.
_BULK = 32
_UPDATES = (64, 128, 256, 512, 1024)
_NONE = IDS << 2  # no prediction
_CHANCE = 12
_EVEN = 1 << _CHANCE  # all chances


#: For each id its range; for each range its first id, and by how many bits its 256th chances are more than those of an id.
_CLASSES = np.repeat(np.arange(_RANGES, dtype=np.int32), np.where(np.arange(_RANGES) < _FINE >> 2, 4, 256))
_FIRST = np.searchsorted(_CLASSES, np.arange(_RANGES)).astype(np.int32)
_BITS = np.where(np.arange(_RANGES) < _FINE >> 2, 2, 8).astype(np.int32)


class _Lanes:
    """State of the models and coders of blocks, most of them of one length.

    Numbers are as narrow as they can be, and what is done for both orders is done by one call of numpy: for a few
    thousand lanes the calls and the bytes moved cost more than the sums.
    """

    def __init__(self, count: int):
        self.count = count
        lane = np.arange(count)
        self.order0 = lane * (_RANGES + 1)
        self.low = self.all_low = np.zeros(count, np.int64)
        self.range = np.full(count, _STATE, np.int64)
        # Order 2, then order 1.
        self.table = np.full(2 * count * _SLOTS, _NONE, np.int32)
        self.slot = np.stack([lane, lane + count]) * _SLOTS
        # Chances of order 2 by its own confidence and by both, then those of order 1.
        self.right = np.full(count * 40, _EVEN >> 2, np.int32)
        self.row = np.stack([lane * 4, count * 8 + lane * 16, count * 4 + lane * 4, count * 24 + lane * 16])
        self.seen = np.zeros((count, _RANGES), np.int32)
        self.sums = np.zeros((count, _RANGES + 1), np.int32)

    def cut(self, count: int) -> None:
        """Only the first lanes go on."""
        for name in ("order0", "low", "range", "slot", "row"):
            setattr(self, name, getattr(self, name)[..., :count])
        self.count = count

    def count_ranges(self, ids: np.ndarray, t: int, places: bool = False) -> None:
        """Order 0 from the first t ids of each lane, of which ``ids`` are those not counted yet; t is a power of two."""
        lanes = len(self.seen)
        for at in range(0, lanes if t else 0, 256):
            some = _CLASSES[ids[at : at + 256]]
            some += np.arange(len(some), dtype=np.int32)[:, None] * _RANGES
            self.seen[at : at + len(some)] += np.bincount(some.ravel(), minlength=len(some) * _RANGES).reshape(-1, _RANGES)
        n = 1 + (self.seen * (_TOTAL - _RANGES) >> max(t.bit_length() - 1, 0))
        n[np.arange(lanes), n.argmax(1)] += _TOTAL - n.sum(1, dtype=np.int32)
        sums = self.sums.reshape(lanes, -1)
        np.cumsum(n, 1, out=sums[:, 1:])
        sums <<= 8
        self.sums = sums.ravel()
        if places:
            self.place = np.repeat(np.tile(np.arange(_RANGES, dtype=np.int16), lanes), n.ravel())

    def predict(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the chances of order 2 and order 1 end; ``at``: places of their predictions."""
        self.at = at + self.slot
        self.p = self.table.take(self.at)
        self.sure = self.p & 3
        joint = (self.sure[0] << 2) + self.sure[1]
        self.rows = self.row + np.stack([self.sure[0], joint, self.sure[1], joint])
        self.n = self.right.take(self.rows)
        both = self.n[::2] + self.n[1::2]
        first = both[0] >> 1
        return first, first + ((_EVEN - first) * both[1] >> _CHANCE + 1)

    def narrow(self, unit: np.ndarray, start: np.ndarray, width: np.ndarray) -> None:
        self.low += unit * start
        np.multiply(unit, width, out=self.range)

    def narrow_to_event(self, unit: np.ndarray, first: np.ndarray, second: np.ndarray, is2: np.ndarray, other: np.ndarray) -> None:
        """Order 2 is right, else order 1 is, or neither."""
        start = np.where(other, second, np.where(is2, 0, first))
        self.narrow(unit, start, np.where(other, np.int32(_EVEN), np.where(is2, first, second)) - start)

    def learn(self, new: np.ndarray, right: np.ndarray) -> None:
        """new: ids as entries of the tables; right: whether the predictions of order 2 and of order 1 were."""
        n = self.n.reshape(2, 2, -1)
        moves = (right * np.int32(_EVEN - 128) + np.int32(64))[:, None] - n >> 5
        moves[1] *= ~right[0]  # order 1 is not asked then
        self.right[self.rows] = (n + moves).reshape(4, -1)
        sure = self.sure + (right * np.int32(2) - np.int32(1))
        self.table[self.at] = np.where(sure < 0, new, self.p - self.sure + np.minimum(sure, 3))

    def digits(self, move: Callable[[np.ndarray, np.ndarray], None]) -> None:
        """Lanes whose range is small send their highest digits: ``move`` gets these lanes and the digits."""
        ready = (self.range < _LEAST).nonzero()[0]
        while len(ready):
            low, width = self.low.take(ready), self.range.take(ready)
            # Where the highest digit is not certain yet, the range ends at the next one.
            ends = ((low ^ (low + width)) >= _TOP).nonzero()[0]
            if len(ends):
                width[ends] = -low[ends] & (_LEAST - 1)
            move(ready, low >> 32)
            width <<= _DIGIT
            self.low[ready] = (low << _DIGIT) & _STATE
            self.range[ready] = width
            ready = ready[width < _LEAST]


def _slots(before1: np.ndarray, before2: np.ndarray) -> np.ndarray:
    """Places in the tables of order 2 and of order 1; ids are 32-bit numbers without sign, whose products may wrap."""
    by1 = before1 * np.uint32(40503)
    both = np.stack([by1 + before2 * np.uint32(60493) >> np.uint32(5), by1 >> np.uint32(4)], -2)
    return (both & np.uint32(_SLOTS - 1)).view(np.int32)


def _shape(total: int, block: int) -> tuple[int, int]:
    """Blocks, and ids of the last."""
    count = -(-total // block)
    return count, total - (count - 1) * block if count else 0


def encode(ids: np.ndarray, block: int = BLOCK) -> list[tuple[bytes, int]]:
    """The bytes of each block, and the CRC-32 of its ids as little-endian 32-bit numbers."""
    if len(ids) and (ids.min() < 0 or ids.max() >= IDS):
        raise ValueError(f"ids are to be below {IDS}")
    count, last = _shape(len(ids), block)
    if not count:
        return []
    grid = np.zeros(count * block, np.uint16)
    grid[: len(ids)] = ids
    grid = grid.reshape(count, block)
    steps = np.zeros((block + 2, count), np.uint16)  # after two ids that are none
    steps[2:] = grid.T
    lanes = _Lanes(count)
    order0 = lanes.order0
    out = np.zeros((count, 2 * block + 16), np.uint16)
    flat, width = out.ravel(), out.shape[1]
    ends = np.arange(count) * width

    def send(ready: np.ndarray, digit: np.ndarray) -> None:
        at = ends.take(ready)
        flat[at] = digit
        ends[ready] = at + 1

    steps_all, counted = block if count > 1 else last, 0
    for begin in range(0, steps_all, _BULK):
        if begin in (0, *_UPDATES):
            lanes.count_ranges(grid[:, counted:begin], begin)
            counted = begin
        # What the ids alone decide comes for several steps at once.
        some = steps[begin : min(begin + _BULK, steps_all) + 2].astype(np.uint32)
        at, some = _slots(some[1:-1], some[:-2]), some[2:].view(np.int32)
        of = _CLASSES.take(some)
        place = order0 + of
        start = lanes.sums.take(place)
        place += 1
        each = lanes.sums.take(place) - start >> _BITS.take(of)
        start += (some - _FIRST.take(of)) * each
        some <<= 2
        for t in range(len(some)):
            if begin + t == last and count > 1:
                lanes.cut(count - 1)
            new = some[t, : lanes.count]
            first, second = lanes.predict(at[t, :, : lanes.count])
            right = (lanes.p ^ new) < 4
            other = ~(right[0] | right[1])
            lanes.narrow_to_event(lanes.range >> _CHANCE, first, second, right[0], other)
            lanes.narrow(
                lanes.range >> other * 20,
                start[t, : lanes.count] * other,
                np.where(other, each[t, : lanes.count], 1),
            )
            lanes.digits(send)
            lanes.learn(new, right)
    for k in (32, 16, 0):
        flat[ends] = (lanes.all_low >> k) & 0xFFFF
        ends += 1
    size = ends - np.arange(count) * width
    payload = []
    for n in range(count):
        own = grid[n, : last if n == count - 1 else block].astype("<u4")
        payload.append((out[n, : size[n]].astype("<u2").tobytes(), zlib.crc32(own.tobytes())))
    return payload


def decode(payload: list[tuple[bytes, int]], total: int, block: int = BLOCK) -> np.ndarray:
    """The ids of blocks that ``encode`` has made; raises ValueError if a block is damaged."""
    count, last = _shape(total, block)
    if count != len(payload):
        raise ValueError(f"{total} ids have {count} blocks, not {len(payload)}")
    if not count:
        return np.zeros(0, np.uint16)
    width = max(len(p) for p, _ in payload) // 2 + 4
    words = np.zeros((count, width), np.uint16)
    for n, (data, _) in enumerate(payload):
        own = np.frombuffer(data, "<u2")
        words[n, : len(own)] = own
    flat = words.ravel()
    lanes = _Lanes(count)
    grid = np.zeros((block, count), np.uint16)
    code = (words[:, 0].astype(np.int64) << 32) | (words[:, 1].astype(np.int64) << 16) | words[:, 2]
    ends = np.arange(count) * width + 3
    most = count * width - 1

    def fetch(ready: np.ndarray, _: np.ndarray) -> None:
        at = ends.take(ready)
        code[ready] = ((code.take(ready) << _DIGIT) & _STATE) | flat.take(at, mode="clip")
        ends[ready] = at + 1

    before1 = before2 = np.zeros(count, np.uint32)
    chances, counted = np.arange(count) * _TOTAL, 0
    for t in range(block if count > 1 else last):
        if t in (0, *_UPDATES):
            lanes.count_ranges(grid[counted:t].T, t, places=True)
            counted = t
        if t == last and count > 1:
            lanes.cut(count - 1)
            chances, before1, before2 = chances[:-1], before1[:-1], before2[:-1]
        first, second = lanes.predict(_slots(before1, before2))
        unit = lanes.range >> _CHANCE
        ahead = code[: lanes.count] - lanes.low
        is2, other = ahead < unit * first, ahead >= unit * second
        lanes.narrow_to_event(unit, first, second, is2, other)
        unit = lanes.range >> other * 20
        # Floating point divides faster; quotients below 2^20 of numbers below 2^48 are never rounded up to a whole.
        value = (code[: lanes.count] - lanes.low) / unit
        value = np.minimum(np.maximum(value, 0), (1 << 20) - 1).astype(np.int32)
        of = lanes.place.take(chances + (value >> 8)).astype(np.int64)
        place = lanes.order0 + of
        start = lanes.sums.take(place)
        place += 1
        each = lanes.sums.take(place) - start >> _BITS.take(of)
        inside = ((value - start) / each).astype(np.int32)
        x = np.where(other, _FIRST.take(of) + inside, np.where(is2, lanes.p[0], lanes.p[1]) >> 2)
        lanes.narrow(unit, (start + inside * each) * other, np.where(other, each, 1))
        lanes.digits(fetch)
        grid[t, : lanes.count] = x
        new = x << 2
        lanes.learn(new, (lanes.p ^ new) < 4)
        before2, before1 = before1, x.view(np.uint32)
    grid = np.ascontiguousarray(grid.T)
    for n, (_, crc) in enumerate(payload):
        own = grid[n, : last if n == count - 1 else block].astype("<u4")
        if zlib.crc32(own.tobytes()) != crc:
            raise ValueError(f"block {n} is damaged")
    return grid.ravel()[:total]
