"""Adaptive context-mixing range coder for token ids, many blocks side by side.

Each block is coded alone, from a reset model, and is one lane of the arrays
here: step t codes id t of every lane. Order 2 (the id that last followed the
two ids before) and order 1 (after the one id before) guess an id; the surer of
the two is offered. Two adaptive models, by each order's record of success and
whether it guesses the same, give the chance that it is right; they are mixed by
a weight that each lane moves toward the better one. Other ids order 0 codes in
two steps: whether the id is among the common ones that make half of all, by a
chance that starts from the caller's counts and adapts to the block, and the
place among the common or the rare, by those counts. All chances are integers of
12 bits, or 18 for places, so encoder and decoder agree on any machine.

The coder keeps 64 bits of state and puts out 16 at a time, carrying into what
is out already. A range of 2^48 or more is renewed after at most 42 bits, so it
never runs out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LANES = 4096
IDS = 1 << 16
_BITS, _FINE_BITS = np.uint64(12), np.uint64(18)
_ONE, _PLACES = 1 << 12, 1 << 18
_LAST_PLACE = np.uint64(_PLACES - 1)
_WORD = np.uint64(16)
_TOP = np.uint64(48)
_LEAST = np.uint64(1 << 48)
_RATE, _CHANCE_RATE, _MIX_RATE = 5, 5, 6
_LOWEST = 16  # of the chances that adapt
#: A lane's guesses: one bucket for each hash of the last id, of order 1 and then seven of order 2.
_BUCKETS, _BUCKET = 256, 8
#: The next sureness (0: none yet) of a guess, from bit 16 on, by twice its sureness and one if right.
_SURER = np.array([1, 2, 1, 2, 1, 3, 2, 3], np.int32) << 16
_STEPS_AT_ONCE = 64


class Shares:
    """Order 0 of the ids of one file: common or rare, and their places there.

    Ids are ranked by how often they occur, ties by id, and cut where half of all
    occurrences is full. An id that the counts lack cannot be coded.
    """

    def __init__(self, counts: np.ndarray):
        counts = np.asarray(counts, np.int64)
        ranked = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)]
        count = counts[ranked]
        rare = 2 * (np.cumsum(count) - count) >= max(1, int(count.sum()))
        size, start = np.zeros_like(count), np.zeros_like(count)
        self.slots = np.zeros((2, _PLACES), np.uint16)
        for ids, slots in zip((~rare, rare), self.slots, strict=True):
            if ids.any():
                here = count[ids]
                places = 1 + here * (_PLACES - len(here)) // here.sum()
                places[0] += _PLACES - places.sum()
                size[ids], start[ids] = places, np.cumsum(places) - places
                slots[:] = np.repeat(ranked[ids], places)
        #: The id at each place of the common ones, then of the rare.
        self.slots = self.slots.ravel()
        #: Whether an id is rare, its start and its size, 20 bits each.
        self.packed = np.zeros(IDS, np.uint64)
        self.packed[ranked] = (rare.astype(np.int64) << 40 | start << 20 | size).astype(np.uint64)
        share = int(count[~rare].sum()) * _ONE // max(1, int(count.sum()))
        self.common = min(max(share, _LOWEST), _ONE - _LOWEST)


class _Model:
    """State of independent models, one for each lane; arrays of two rows hold orders 1 and 2."""

    def __init__(self, lanes: int, shares: Shares):
        self.lane = np.arange(lanes)
        self.common = np.full(lanes, shares.common, np.int32)
        self.guesses = np.zeros(lanes * _BUCKETS * _BUCKET, np.int32)
        self.chances = np.full(16 * lanes, _ONE // 2, np.int32)
        self.chance_base = np.stack([self.lane * 8, (lanes + self.lane) * 8])
        self.weight = np.full(lanes, 128, np.int32)
        self.last = np.zeros(lanes, np.int64)
        self.last2 = np.zeros(lanes, np.int64)

    def guess(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids offered in the first n lanes, and the mixed chances that they are right."""
        at = self.at = np.empty((2, n), np.int64)
        bucket = (self.last[:n] * 40503 >> 3 & (_BUCKETS - 1)) + self.lane[:n] * _BUCKETS
        np.multiply(bucket, _BUCKET, out=at[0])
        np.add(at[0], (self.last2[:n] * 30011 & 0xFFFF) * (_BUCKET - 1) >> 16, out=at[1])
        at[1] += 1
        found = self.guesses[at]
        self.ids, self.sure = found & 0xFFFF, found >> 16
        offered = self.ids[0] + (self.ids[1] - self.ids[0]) * (self.sure[1] >= self.sure[0])
        self.row = self.chance_base[:, :n] + self.sure * 2
        self.row += self.ids == offered
        first, second = self.chance = self.chances[self.row]
        self.mixed = first + ((second - first) * self.weight[:n] >> 8)
        return offered, self.mixed

    def learn_right(self, n: int, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Updates what being right or wrong teaches; returns its start and size in the range."""
        sign = right * np.int32(2) - np.int32(1)
        first, second = self.chance
        weight = self.weight[:n] + ((second - first) * sign >> _MIX_RATE)
        np.minimum(np.maximum(weight, 16), 240, out=self.weight[:n])
        goal = right * np.int32(_ONE - 2 * _LOWEST) + np.int32(_LOWEST)
        self.chances[self.row] = self.chance + (goal - self.chance >> _CHANCE_RATE)
        start = self.mixed * ~right
        return start.astype(np.uint64), (self.mixed * sign + (start > 0) * _ONE).astype(np.uint64)

    def learn_id(self, n: int, here: np.ndarray) -> None:
        record = self.sure * 2 + (self.ids == here)
        kept = (record & 5) > 0
        self.guesses[self.at] = here + (self.ids - here) * kept + _SURER[record]
        self.last2[:n] = self.last[:n]
        self.last[:n] = here

    def learn_rare(self, lane: np.ndarray, common: np.ndarray, rare: np.ndarray):
        """Updates the chances of common ids; returns the start and size of what is coded."""
        start = common * rare
        goal = (_ONE - _LOWEST) - rare * np.int32(_ONE - 2 * _LOWEST)
        self.common[lane] = common + (goal - common >> _RATE)
        return start.astype(np.uint64), (common - 2 * start + rare * np.int32(_ONE)).astype(np.uint64)


def _places(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return packed >> np.uint64(20) & np.uint64(0xFFFFF), packed & np.uint64(0xFFFFF)


def _steps(sizes: list[int]) -> Iterator[tuple[slice, list[int]]]:
    """Runs of steps, and how many lanes, longest first, have an id at each step of them."""
    longest = sizes[0] if sizes else 0
    active = np.searchsorted(-np.array(sizes), -np.arange(longest), "left").tolist()
    for start in range(0, longest, _STEPS_AT_ONCE):
        run = slice(start, min(start + _STEPS_AT_ONCE, longest))
        yield run, active[run]


def encode(blocks: list[np.ndarray], shares: Shares | None = None) -> list[bytes]:
    """Coded bytes of each block of ids below 2^16; longest blocks first."""
    shares = shares or Shares(np.ones(IDS))
    lanes, sizes = len(blocks), [len(block) for block in blocks]
    ids = np.zeros((lanes, max(sizes, default=0)), np.int32)
    for row, block in zip(ids, blocks, strict=True):
        row[: len(block)] = block
    model = _Model(lanes, shares)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
    width = 3 * ids.shape[1] + 8
    out = np.zeros(lanes * width, np.uint16)
    place = np.arange(lanes) * width

    def step(here: np.ndarray, n: int) -> None:
        before = low[:n].copy()
        offered, _ = model.guess(n)
        right = offered == here
        start, size = model.learn_right(n, right)
        unit = span[:n] >> _BITS
        low[:n] += unit * start
        np.multiply(unit, size, out=span[:n])
        left = np.flatnonzero(~right)
        packed = shares.packed[here[left]]
        rare = (packed >> np.uint64(40)).astype(np.int32)
        start, size = model.learn_rare(left, model.common[left], rare)
        unit = span[left] >> _BITS
        ahead, unit = unit * start, unit * size >> _FINE_BITS
        start, size = _places(packed)
        low[left] += ahead + unit * start
        span[left] = unit * size
        carried = place[np.flatnonzero(low[:n] < before)]
        while len(carried):
            carried -= 1
            out[carried] += np.uint16(1)
            carried = carried[out[carried] == 0]
        lane = np.flatnonzero(span[:n] < _LEAST)
        while len(lane):
            at, first, wide = place[lane], low[lane], span[lane] << _WORD
            out[at] = first >> _TOP
            place[lane] = at + 1
            low[lane], span[lane] = first << _WORD, wide
            lane = lane[wide < _LEAST]
        model.learn_id(n, here)

    for run, active in _steps(sizes):
        for here, n in zip(np.ascontiguousarray(ids[:, run].T), active, strict=True):
            step(here[:n], n)
    tail = np.stack([low >> np.uint64(shift) & np.uint64(0xFFFF) for shift in (48, 32, 16, 0)], 1)
    coded = out.astype("<u2", copy=False)
    starts = (np.arange(lanes) * width).tolist()
    return [
        coded[start:end].tobytes() + rest.tobytes()
        for start, end, rest in zip(starts, place.tolist(), tail.astype("<u2"), strict=True)
    ]


def decode(coded: list[bytes], sizes: list[int], shares: Shares | None = None) -> list[np.ndarray]:
    """The ids of each block; longest blocks first."""
    shares = shares or Shares(np.ones(IDS))
    lanes = len(coded)
    width = max(map(len, coded), default=0) // 2 + 8
    words = np.zeros((lanes, width), np.uint16)
    for lane, block in enumerate(coded):
        words[lane, : len(block) // 2] = np.frombuffer(block, "<u2")
    ids = np.zeros((lanes, max(sizes, default=0)), np.int32)
    model = _Model(lanes, shares)
    code, span = np.zeros(lanes, np.uint64), np.full(lanes, 2**64 - 1, np.uint64)
    for i in range(4):
        code = code << _WORD | words[:, i]
    place, words = np.arange(lanes) * width + 4, words.ravel()

    def step(n: int) -> np.ndarray:
        here, mixed = model.guess(n)
        unit = span[:n] >> _BITS
        right = code[:n] < unit * mixed.astype(np.uint64)
        start, size = model.learn_right(n, right)
        code[:n] -= unit * start
        np.multiply(unit, size, out=span[:n])
        left = np.flatnonzero(~right)
        rest, unit = code[left], span[left] >> _BITS
        common = model.common[left]
        rare = (rest >= unit * common.astype(np.uint64)).astype(np.int32)
        start, size = model.learn_rare(left, common, rare)
        rest -= unit * start
        unit = unit * size >> _FINE_BITS
        place_of = np.minimum(rest // unit, _LAST_PLACE).astype(np.int64)
        found = shares.slots[rare * _PLACES + place_of]
        start, size = _places(shares.packed[found])
        code[left] = rest - unit * start
        span[left] = unit * size
        here[left] = found
        lane = np.flatnonzero(span[:n] < _LEAST)
        while len(lane):
            at, wide = place[lane], span[lane] << _WORD
            code[lane] = code[lane] << _WORD | words[at]
            place[lane] = at + 1
            span[lane] = wide
            lane = lane[wide < _LEAST]
        model.learn_id(n, here)
        return here

    for run, active in _steps(sizes):
        part = np.zeros((len(active), lanes), np.int32)
        for row, n in zip(part, active, strict=True):
            row[:n] = step(n)
        ids[:, run] = part.T
    return [row[:size] for row, size in zip(ids, sizes, strict=True)]
