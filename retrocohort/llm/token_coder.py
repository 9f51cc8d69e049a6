"""Adaptive context-mixing range coder for token ids, many blocks side by side.

Blocks have the same number of ids and start from the same empty model, so any
block can be decoded by itself. All blocks of a call advance together, one id
at a time, which makes every step a handful of array operations. The encoder
knows the ids and does what does not depend on the step before for many steps
at once.

Each id is predicted three ways. Order 2 and order 1 remember the id that last
followed the two, or one, ids before, with a confidence from 0 to 3. Order 0
counts the high and the low byte of all ids so far. Whether an id is the one of
order 2, of order 1 or another is coded with frequencies mixed from three
counts: by order 2's confidence, by order 1's and over the whole block. If it
is another, its two bytes are coded with order 0's frequencies. Frequencies are
renewed from the counts after 8, 16, 32 and every 64 ids. A remembered id loses
confidence before another replaces it. Order 0 works on bytes, the high and the
low one independently, not on ids.

The three frequencies of an id are multiplied to one span of 42 bits, by which
the interval is narrowed once. Carries stay in the words and are settled at the
end of a block, so the decoder needs the interval's width alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LIMIT = 1 << 16  # ids have two bytes
_BITS = 14  # of all frequencies
_ONE = 1 << _BITS
_TWO = np.int64(2 * _BITS)
_EARLY, _RENEW = (8, 16, 32), 64
_TOGETHER = 16  # steps that the encoder prepares at once
_GAIN = 16  # weight of a byte that was seen, against 1 of every other
_SLOTS = 10
_MASK = (1 << _SLOTS) - 1
_UNIT, _WORD, _TOP = np.uint64(3 * _BITS), np.uint64(16), np.uint64(47)
# Least width before an id; the greatest is 2**16 of it, so a low end with its carry has 64 bits.
_LEAST = np.uint64(1 << 47)
_BELOW = _LEAST - np.uint64(1)
_EIGHT = 8  # bytes between the bounds that a search compares first


def _periods(length: int) -> Iterator[tuple[int, int]]:
    """Places between two renewals of the frequencies."""
    cuts = [0, *_EARLY, *range(_RENEW, length, _RENEW)]
    cuts = [*(c for c in cuts if c < length), length]
    yield from zip(cuts, cuts[1:], strict=False)


class _Frequencies:
    """Frequencies of events and bytes as bounds of spans, for ``n`` blocks; blocks are the last axis."""

    def __init__(self, n: int):
        self.n = n
        self.lane = np.arange(n)
        # a row for each symbol; the high byte of every block, then the low one
        self.count = np.ones((256, 2 * n), dtype=np.int32)
        self.total = np.full(n, 256, dtype=np.int64)
        self.bounds = np.zeros((257, 2 * n), dtype=np.int16)
        self.flat = self.bounds.reshape(-1)
        self.begin = np.arange(2 * n).reshape(2, n)
        # times of each event by both confidences
        self.times = np.ones((3, 4, 4, n))
        self.events = np.zeros((4, 4, 4, n), dtype=np.int16)
        self.events[3] = _ONE
        self.flat_events = self.events.reshape(-1)
        self._mix()
        self._share()

    def _mix(self) -> None:
        # whole numbers below 2**45 as doubles, so quotients are exact after floor
        by_two = self.times.sum(axis=2, keepdims=True)
        by_one = self.times.sum(axis=1, keepdims=True)
        mixed = by_two * 4 + by_one * 2 + by_two.sum(axis=1, keepdims=True)
        whole = mixed.sum(axis=0)
        share = np.floor(mixed[:2] * (_ONE - 3) / whole) + 1
        self.events[1] = share[0]
        self.events[2] = share[0] + share[1]

    def _share(self) -> None:
        # a reciprocal with 16 binary places; products stay below 31 bits and their upper half is the share
        scale = np.tile((((_ONE - 256) << 16) // self.total).astype("<i4"), 2)
        bounds, product = self.bounds, np.empty((16, 2 * self.n), dtype="<i4")
        share = product.view("<i2")[:, 1::2]
        for first in range(0, 256, 16):
            np.multiply(self.count[first : first + 16], scale, out=product)
            more = share + np.int16(1)
            for i in range(16):
                np.add(bounds[first + i], more[i], out=bounds[first + i + 1])
        # of each part, every eighth bound and the greatest value that a search may have
        self.coarse = [np.ascontiguousarray(x) for x in np.split(bounds[_EIGHT:256:_EIGHT], 2, axis=1)]
        self.last = np.split((bounds[256] - np.int16(1)).astype(np.int64), 2)

    def renew(self, events: np.ndarray, high: np.ndarray, low: np.ndarray, missed: np.ndarray) -> None:
        """Counts places in ``flat_events`` and ``count``, and bytes of each block."""
        self.times += np.bincount(events, minlength=self.times.size).reshape(self.times.shape)
        count = self.count.reshape(-1)
        np.add.at(count, high, np.int32(_GAIN))
        np.add.at(count, low, np.int32(_GAIN))
        self.total += missed * _GAIN
        self._mix()
        self._share()

    def find(self, part: int, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols whose spans hold the values, their first bounds and sizes: by eighths, then by halves."""
        two = 2 * self.n
        value = np.minimum(value, self.last[part]).astype(np.int16)
        above = (self.coarse[part] <= value).view(np.int8).sum(axis=0, dtype=np.int8)
        at = above * np.int64(_EIGHT * two)
        at += self.begin[part]
        for half in (4, 2, 1):
            later = at + half * two
            at = np.where(self.flat.take(later, mode="clip") <= value, later, at)
        first = self.flat.take(at, mode="clip").astype(np.int64)
        return at // two, first, self.flat.take(at + two, mode="clip") - first


class _Memory:
    """The ids that last followed contexts: order 2 of every block, then order 1."""

    def __init__(self, n: int):
        self.base = np.arange(2 * n) << _SLOTS
        self.table = np.zeros(2 * n << _SLOTS, dtype=np.int32)

    def look(self, at: np.ndarray, out: np.ndarray) -> None:
        self.table.take(at, out=out, mode="clip")

    def learn(self, at: np.ndarray, slot: np.ndarray, fresh: np.ndarray) -> None:
        """``fresh`` is the id that came, without confidence."""
        up = np.minimum(slot + 1, fresh | 3)
        down = np.where(slot & 3, slot - 1, fresh)
        self.table[at] = np.where((slot ^ fresh) < 4, up, down)


def encode(ids: np.ndarray) -> list[bytes]:
    """Codes of the rows of ``ids`` (blocks by places), each id below ``LIMIT``."""
    n, length = ids.shape
    model, memory = _Frequencies(n), _Memory(n)
    lanes, two = np.tile(model.lane, _TOGETHER), 2 * n
    rows = np.zeros((length + 2, n), dtype=np.int64)  # two ids before the first
    rows[2:] = ids.T
    low, width = np.zeros(n, dtype=np.uint64), np.full(n, 1 << 63, dtype=np.uint64)
    step = 3 * length + 8
    out = np.zeros(n * step, dtype=np.uint32)
    used = np.arange(n) * step
    unit, part = np.empty(n, dtype=np.uint64), np.empty(n, dtype=np.uint64)
    for begin, end in _periods(length):
        seen, highs, lows, missed = [], [], [], np.zeros(n, dtype=np.int64)
        for a in range(begin, end, _TOGETHER):
            k = min(a + _TOGETHER, end) - a
            now = rows[a + 2 : a + 2 + k]
            at = np.empty((k, 2, n), dtype=np.int64)
            np.multiply(rows[a + 1 : a + 1 + k], 40503, out=at[:, 1])
            np.multiply(rows[a : a + k], 60493, out=at[:, 0])
            at[:, 0] += at[:, 1]
            at >>= 5
            at &= _MASK
            at = at.reshape(k, two)
            at += memory.base
            fresh = np.empty((k, 2, n), dtype=np.int32)
            fresh[:] = (now << 2)[:, None]
            slots = np.empty((k, two), dtype=np.int32)
            for i, new in enumerate(fresh.reshape(k, two)):
                memory.look(at[i], slots[i])
                memory.learn(at[i], slots[i], new)
            slots = slots.reshape(k, 2, n)
            wrong = (slots ^ fresh) > 3
            other, miss = wrong[:, 0], wrong[:, 0] & wrong[:, 1]
            event = ((slots[:, 0] & 3) << 2) + (slots[:, 1] & 3)
            event += (other.view(np.int8) + miss.view(np.int8)) * np.int32(16)
            event_at = event * np.int64(n)
            event_at += model.lane
            start = model.flat_events.take(event_at).astype(np.int64)
            size = model.flat_events.take(event_at + 16 * n) - start
            start <<= _TWO
            missing = np.flatnonzero(miss)
            blocks, symbols = lanes.take(missing), now.reshape(-1)[missing]
            high_at = (symbols >> 8) * two + blocks
            low_at = (symbols & 255) * two + (blocks + n)
            high, low_byte = (model.flat.take(x).astype(np.int64) for x in (high_at, low_at))
            high_size = model.flat.take(high_at + two) - high
            low_size = model.flat.take(low_at + two) - low_byte
            whole = size.reshape(-1)[missing]
            start.reshape(-1)[missing] += ((high << _BITS) + low_byte * high_size) * whole
            size <<= _TWO
            size.reshape(-1)[missing] = whole * high_size * low_size
            seen.append(event_at.reshape(-1))
            highs.append(high_at)
            lows.append(low_at)
            missed += miss.sum(axis=0)
            for first, share in zip(start.view(np.uint64), size.view(np.uint64), strict=True):
                np.right_shift(width, _UNIT, out=unit)
                np.multiply(unit, first, out=part)
                np.add(low, part, out=low)
                np.multiply(unit, share, out=width)
                short = width < _LEAST
                out[used] = low >> _TOP
                low = np.where(short, (low & _BELOW) << _WORD, low)
                width = np.where(short, width << _WORD, width)
                used += short
                again = np.flatnonzero(width < _LEAST)
                while len(again):
                    value, left, place = low[again], width[again] << _WORD, used[again]
                    out[place] = value >> _TOP
                    low[again] = (value & _BELOW) << _WORD
                    width[again] = left
                    used[again] = place + 1
                    again = again[left < _LEAST]
        if end < length:
            model.renew(*(np.concatenate(x) for x in (seen, highs, lows)), missed)
    out[used] = low >> _TOP
    for shift in (31, 15, -1):
        used += 1
        out[used] = (low >> np.uint64(shift) if shift > 0 else low << np.uint64(1)) & np.uint64(65535)
    used += 1
    used -= np.arange(n) * step
    words = out.reshape(n, step)[:, : int(used.max(initial=0))].copy()
    flat = words.reshape(-1)
    over = np.flatnonzero(flat >> 16)
    while len(over):
        flat[over] &= 65535
        flat[over - 1] += 1
        over = over[flat[over - 1] > 65535] - 1
    words = words.astype("<u2")
    return [words[i, :k].tobytes() for i, k in enumerate(used.tolist())]


def decode(codes: list[bytes], length: int) -> np.ndarray:
    """The ids of :func:`encode`."""
    n = len(codes)
    model, memory = _Frequencies(n), _Memory(n)
    lane, flat_events, lanes = model.lane, model.flat_events, np.tile(model.lane, _RENEW)
    sizes = [len(c) // 2 for c in codes]
    step = max(sizes, default=0) + 6
    words = np.zeros((n, step), dtype=np.uint16)
    for i, c in enumerate(codes):
        words[i, : sizes[i]] = np.frombuffer(c, dtype="<u2")
    rest = np.zeros(n, dtype=np.uint64)
    for place, shift in enumerate((47, 31, 15)):
        rest |= words[:, place].astype(np.uint64) << np.uint64(shift)
    rest |= words[:, 3].astype(np.uint64) >> np.uint64(1)
    # an interval has 63 bits: later words begin one bit before their place
    flat = words.reshape(-1)
    flat[:-1] = (flat[:-1] << 15) | (flat[1:] >> 1)
    used = np.arange(n) * step + 3
    width = np.full(n, 1 << 63, dtype=np.uint64)
    out = np.zeros((length, n), dtype=np.uint16)
    at, slots = np.empty((2, n), dtype=np.int64), np.empty(2 * n, dtype=np.int32)
    order2, order1 = slots[:n], slots[n:]
    fresh = np.empty((2, n), dtype=np.int32)
    now = before = np.zeros(n, dtype=np.int64)
    for begin, end in _periods(length):
        k = end - begin
        seen = np.empty((k, n), dtype=np.int64)
        misses = np.empty((k, n), dtype=bool)
        for i in range(k):
            np.multiply(now, 40503, out=at[1])
            np.add(at[1], before, out=at[0])
            before = now * 60493
            np.right_shift(at, 5, out=at)
            np.bitwise_and(at, _MASK, out=at)
            where = at.reshape(-1) + memory.base
            memory.look(where, slots)
            sure = slots & 3
            event_at = ((sure[:n] << 2) + sure[n:]) * np.int64(n)
            event_at += lane
            first = flat_events.take(event_at + 16 * n).astype(np.int64)
            second = flat_events.take(event_at + 32 * n).astype(np.int64)
            unit = width >> _UNIT
            value = (rest // unit).view(np.int64)
            event = value >> _TWO
            other, miss = event >= first, event >= second
            event_at += (other.view(np.int8) + miss.view(np.int8)) * np.int64(16 * n)
            start = np.where(miss, second, first * other)
            size = np.where(miss, _ONE, np.where(other, second, first))
            size -= start
            # quotients of whole numbers below 2**43 by less than 2**15, exact after floor
            inside = value - (start << _TWO)
            inside = (inside / size).astype(np.int64)
            high, high_first, high_size = model.find(0, inside >> _BITS)
            inside -= high_first << _BITS
            low, low_first, low_size = model.find(1, (inside / high_size).astype(np.int64))
            begins = ((high_first << _BITS) + low_first * high_size) * miss
            begins *= size
            begins += start << _TWO
            size *= np.where(miss, high_size * low_size, 1 << (2 * _BITS))
            rest -= unit * begins.view(np.uint64)
            width = unit * size.view(np.uint64)
            now = np.where(miss, (high << 8) | low, np.where(other, order1, order2) >> 2)
            out[begin + i] = now
            fresh[:] = now << 2
            memory.learn(where, slots, fresh.reshape(-1))
            seen[i], misses[i] = event_at, miss
            short = width < _LEAST
            rest = np.where(short, (rest << _WORD) | flat.take(used, mode="clip"), rest)
            width = np.where(short, width << _WORD, width)
            used += short
            again = np.flatnonzero(width < _LEAST)
            while len(again):
                place, left = used[again], width[again] << _WORD
                rest[again] = (rest[again] << _WORD) | flat.take(place, mode="clip")
                width[again] = left
                used[again] = place + 1
                again = again[left < _LEAST]
        if end < length:
            missing = np.flatnonzero(misses)
            blocks, symbols = lanes.take(missing), out[begin:end].reshape(-1)[missing].astype(np.int64)
            at_high, at_low = (symbols >> 8) * (2 * n) + blocks, (symbols & 255) * (2 * n) + (blocks + n)
            model.renew(seen.reshape(-1), at_high, at_low, misses.sum(axis=0))
    return out.T
