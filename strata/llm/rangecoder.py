"""Adaptive context-mixing range coder for token ids, in independent blocks.

A block's ids are cut into lanes of equal length that are coded side by side:
each numpy step codes one id of every lane. The lanes share one model, which
starts anew in every block:

* order 2 and order 1 guess the next id: the id last seen after the same two
  (one) ids, with a confidence count;
* order 0 is a frequency table over all ids, rebuilt as the block goes on.

The chance that the order-2 guess is right is mixed, in the logistic domain,
from three adaptive estimates: by its confidence, by the order-1 guess
(confidence, agreement) and by its order-0 frequency; the mixing weights are
trained on the way. The unit interval of one coding step is then the order-2
guess, the order-1 guess and, in the rest, the order-0 table, so one step
codes one id. All arithmetic is on integers: a decoder on another machine
follows exactly.

Each lane has its own 64-bit range coder writing 32-bit words. Block header
and content carry CRC-32 checksums; damage raises ``ValueError``.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"SIC2"
_HEAD = struct.Struct("<4sIQIIIII")  # magic, docs, ids, lanes, steps, symbols, crc of ids, crc of what follows
MAX_LANES = 16384
LANE_IDS = 256
MAX_SYMBOLS = 1 << 17

_SPACE_BITS = 27
_SPACE = 1 << _SPACE_BITS
_REST = 1 << 22  # at least this much of the space is order 0's
_TOTAL_BITS = 20  # of the order-0 table: the ids never seen, one share each, take little of it
_SLOTS = 1 << 18
# what an entry's confidence gains by a hit (second half) or loses by a miss; below 2 a miss replaces the entry
_STEP = np.array([(n >> 1) - n for n in range(16)] + [n < 15 for n in range(16)], np.int32)
_UNIT = np.int32((_SPACE - _REST) >> 12)
_WORD = np.uint64(32)
_LOW = np.uint64(0xFFFFFFFF)
_TOP = np.uint64(1 << 32)


def _logistic_tables() -> tuple[np.ndarray, np.ndarray]:
    """``stretch`` of 12-bit chances (1/256 units) and ``squash`` back, built
    from exact integer powers so that every machine gets the same tables."""
    # squash(x) = 4096 / (1 + e^(-x/256)) at 33 knots, between them linear
    knots = [1, 2, 3, 6, 10, 16, 27, 45, 73, 120, 194, 310, 488, 747, 1101, 1546, 2047]
    knots += [4095 - k for k in reversed(knots[:-1])]
    squash = np.empty(4096, np.int64)
    for i in range(4096):
        k, w = divmod(i, 128)
        squash[i] = (knots[k] * (128 - w) + knots[k + 1] * w + 64) >> 7
    stretch = np.searchsorted(squash, np.arange(4096), side="left") - 2048
    return np.clip(stretch, -2047, 2047).astype(np.int32), np.clip(squash, 1, 4095).astype(np.int32)


_STRETCH, _SQUASH = _logistic_tables()


class _Model:
    """What coder and decoder know alike before each step."""

    def __init__(self, lanes: int, symbols: int):
        self.symbols = symbols
        self.prev1 = np.zeros(lanes, np.int32)
        self.prev2 = np.zeros(lanes, np.int32)
        self.after1 = np.zeros(1 << 16, np.int32)  # id * 16 + confidence
        self.after2 = np.zeros(_SLOTS, np.int32)
        self.by2 = np.linspace(2000, 60000, 16).astype(np.int64)  # 16-bit chances
        self.by1 = np.repeat(np.linspace(1000, 50000, 16).astype(np.int64), 2)
        self.by0 = np.full(_TOTAL_BITS + 2, 8000, np.int64)
        self.second = np.full(256, 12000, np.int64)
        self.weights = [26000, 20000, 20000]  # 16-bit fixed point
        self.counts = np.zeros(symbols, np.int64)
        self.recent: list[np.ndarray] = []
        self.fresh, self.due = 0, lanes
        self.step = 0
        self._rebuild()

    def _rebuild(self) -> None:
        """The order-0 table from the counts: every id at least 1, sum 2^20.
        The ids not seen yet share what the ids seen once suggest (one part in
        ``seen`` each), at most 15 parts of 16."""
        if self.recent:
            self.counts += np.bincount(np.concatenate(self.recent), minlength=self.symbols)
        self.recent = []
        total, seen = 1 << _TOTAL_BITS, int(self.counts.sum())
        new = self.counts == 0
        n_new, once = int(np.count_nonzero(new)), int(np.count_nonzero(self.counts == 1))
        part = min(total * once // seen, total * 15 // 16) if seen else 0
        floor = 1 + max(0, part - n_new) // max(n_new, 1)
        room = total - n_new * floor - (self.symbols - n_new)
        freq = self.counts * room // max(seen, 1)
        freq += new * np.int64(floor - 1)
        freq += 1
        freq[int(freq.argmax())] += total - int(freq.sum())
        self.cum = np.zeros(self.symbols + 1, np.int64)
        np.cumsum(freq, out=self.cum[1:])
        self.symbol_at = None
        self.rarity = np.frexp(freq)[1].astype(np.int32)  # number of bits of the frequency

    def lookup(self) -> np.ndarray:
        if self.symbol_at is None:
            dtype = np.uint16 if self.symbols <= 1 << 16 else np.int32
            self.symbol_at = np.repeat(np.arange(self.symbols, dtype=dtype), np.diff(self.cum))
        return self.symbol_at

    def predict(self) -> None:
        self.at1 = self.prev1.astype(np.int64)
        self.slot = self.prev2.astype(np.int64)
        self.slot *= 40503
        self.slot += self.at1 * 2654435
        self.slot >>= 5
        self.slot &= _SLOTS - 1
        self.at1 &= 0xFFFF
        self.e2 = self.after2.take(self.slot)
        self.e1 = self.after1.take(self.at1)
        self.guess2, self.n2 = self.e2 >> np.int32(4), self.e2 & np.int32(15)
        self.guess1, self.n1 = self.e1 >> np.int32(4), self.e1 & np.int32(15)
        self.differ = self.guess1 != self.guess2
        self.i1 = self.n1 * np.int32(2) + self.differ
        self.i0 = self.rarity.take(self.guess2)
        self.s2 = _STRETCH[self.by2 >> 4].take(self.n2)
        self.s1 = _STRETCH[self.by1 >> 4].take(self.i1)
        self.s0 = _STRETCH[self.by0 >> 4].take(self.i0)
        w2, w1, w0 = map(np.int32, self.weights)
        dot = (w2 * self.s2 + w1 * self.s1 + w0 * self.s0) >> np.int32(16)
        np.minimum(np.maximum(dot, np.int32(-2047), out=dot), np.int32(2047), out=dot)
        dot += np.int32(2048)
        self.chance = _SQUASH.take(dot)
        self.size2 = self.chance * _UNIT  # of _SPACE - _REST, in 4096ths
        self.j = self.n1 * np.int32(16) + self.n2
        chance1 = (self.second >> 4).astype(np.int32).take(self.j) * self.differ
        self.size1 = ((np.int32(_SPACE - _REST) - self.size2) >> np.int32(12)) * chance1
        self.base0 = self.size2 + self.size1
        self.size0 = (np.int32(_SPACE) - self.base0).astype(np.int64)

    def rest(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The order-0 intervals of ``ids``."""
        place = ids.astype(np.int64)
        at = self.cum.take(place)
        place += 1
        end = self.cum.take(place)
        for bound in (at, end):
            bound *= self.size0
            bound >>= _TOTAL_BITS
            bound += self.base0
        return at, end

    def narrow(self, at: np.ndarray, end: np.ndarray, is2: np.ndarray, is1: np.ndarray) -> None:
        """The guesses' intervals where a guess is right (never both ``is2``
        and ``is1``). By masks of bits: where hits are random, copies under a
        condition cost many times as much."""
        first, second = -is2.astype(np.int64), -is1.astype(np.int64)
        other = ~(first | second)
        size2 = self.size2.astype(np.int64)
        at &= other
        at |= size2 & second
        end &= other
        end |= self.base0 & second
        end |= size2 & first

    @staticmethod
    def _train(table: np.ndarray, index: np.ndarray, hit: np.ndarray, among: np.ndarray | None = None) -> None:
        if among is None:
            n, h = np.bincount(index * np.int32(2) + hit, minlength=2 * len(table)).reshape(-1, 2).T
            n = n + h
        else:
            n, h = np.bincount(index * np.int32(4) + among * np.int32(2) + hit, minlength=4 * len(table)).reshape(-1, 4).T[2:]
            n = n + h
        table += (h * 65535 - n * table) // (n + 256)
        np.clip(table, 64, 65535 - 64, out=table)

    def learn(self, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        if self.step < 16 or self.step % 8 == 0:
            self._train(self.by2, self.n2, hit2)
            self._train(self.by1, self.i1, hit2)
            self._train(self.by0, self.i0, hit2)
            self._train(self.second, self.j, hit1, self.differ & ~hit2)
            err = (hit2.astype(np.int64) << 12) - self.chance
            lanes = len(ids)
            for i, s in enumerate((self.s2, self.s1, self.s0)):
                moved = self.weights[i] + int((err * s).sum()) // (lanes * 64)
                self.weights[i] = min(max(moved, -(1 << 17)), 1 << 17)
        fresh = ids * np.int32(16) + np.int32(1)
        for table, slot, entry, n, hit in (
            (self.after2, self.slot, self.e2, self.n2, hit2),
            (self.after1, self.at1, self.e1, self.n1, hit1),
        ):
            after = _STEP.take(n + (hit << np.int32(4)))
            after += entry
            after += (fresh - after) * ((n < 2) & ~hit)
            table[slot] = after
        self.recent.append(ids)
        self.prev2, self.prev1 = self.prev1, ids
        self.step += 1
        self.fresh += len(ids)
        if self.fresh >= self.due:
            self.due = min(2 * self.due, max(1 << 16, len(ids)))
            self.fresh = 0
            self._rebuild()


def _lanes(n: int) -> tuple[int, int]:
    lanes = min(MAX_LANES, max(1, n // LANE_IDS))
    steps = -(-n // lanes)
    return (-(-n // steps) if n else 0), steps


def _code(ids: np.ndarray, lanes: int, steps: int, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Words per lane, and all words lane after lane."""
    by_lane = np.zeros(lanes * steps, np.int32)
    by_lane[: len(ids)] = ids
    by_lane = by_lane.reshape(lanes, steps)
    grid = np.empty((steps, lanes), np.int32)
    for t in range(0, steps, 16):  # a cache line of every lane at a time
        grid[t : t + 16] = by_lane[:, t : t + 16].T
    model = _Model(lanes, symbols)
    low = np.zeros(lanes, np.uint64)
    rng = np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
    out = np.empty((steps + 1, lanes), np.uint32)  # lanes run nearly level: rows are written together
    cells = out.reshape(-1)
    used = np.zeros(lanes, np.int64)
    for now in grid:
        model.predict()
        hit2 = now == model.guess2
        hit1 = now == model.guess1
        at, end = model.rest(now)
        model.narrow(at, end, hit2, hit1 & ~hit2)
        unit = rng >> np.uint64(_SPACE_BITS)
        low += unit * at.view(np.uint64)
        end -= at
        rng = unit * end.view(np.uint64)
        i = np.flatnonzero(rng < _TOP)
        if len(i):
            lo, r = low.take(i), rng.take(i)
            apart = ((lo ^ (lo + r - np.uint64(1))) >> _WORD) != 0
            r = np.where(apart, _TOP - (lo & _LOW), r)  # stop at the word's end: no carry
            row = used.take(i)
            cells[row * lanes + i] = lo >> _WORD
            used[i] = row + 1
            low[i], rng[i] = lo << _WORD, r << _WORD
        model.learn(now, hit2, hit1)
    # every range is 2^32 or more now: the next value whose low word is zero lies in it
    out[used, np.arange(lanes)] = (low + _LOW) >> _WORD
    used += 1
    most = int(used.max())
    return used, out[:most].T[np.arange(most) < used[:, None]]


def _decode(used: np.ndarray, words: np.ndarray, n: int, lanes: int, steps: int, symbols: int) -> np.ndarray:
    after = np.cumsum(used)
    nxt = after - used
    words = np.concatenate((words.astype(np.uint64), np.zeros(1, np.uint64)))

    def read(i: np.ndarray) -> np.ndarray:
        """The next word of the lanes ``i``; zeros follow a lane's end."""
        at = nxt.take(i)
        nxt[i] = at + 1
        return np.where(at < after[i], words[np.minimum(at, len(words) - 1)], np.uint64(0))

    every = np.arange(lanes)
    code = read(every) << _WORD
    code |= read(every)
    model = _Model(lanes, symbols)
    low = np.zeros(lanes, np.uint64)
    rng = np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
    grid = np.empty((steps, lanes), np.int32)
    for t in range(steps):
        model.predict()
        unit = rng >> np.uint64(_SPACE_BITS)
        value = np.minimum((code - low) // unit, np.uint64(_SPACE - 1)).astype(np.int64)
        is2 = value < model.size2
        is1 = ~is2 & (value < model.base0)
        rest = np.maximum(value - model.base0, 0)
        # exact: the quotient is below 2^21 and its fraction at least 2^-27 from the next integer
        place = ((((rest + 1) << _TOTAL_BITS) - 1) / model.size0).astype(np.int64)
        now = model.lookup().take(np.minimum(place, (1 << _TOTAL_BITS) - 1)).astype(np.int32)
        at, end = model.rest(now)
        now += (model.guess1 - now) * is1
        now += (model.guess2 - now) * is2
        model.narrow(at, end, is2, is1)
        low += unit * at.view(np.uint64)
        end -= at
        rng = unit * end.view(np.uint64)
        i = np.flatnonzero(rng < _TOP)
        if len(i):
            lo, r = low.take(i), rng.take(i)
            apart = ((lo ^ (lo + r - np.uint64(1))) >> _WORD) != 0
            r = np.where(apart, _TOP - (lo & _LOW), r)
            code[i] = (code.take(i) << _WORD) | read(i)
            low[i], rng[i] = lo << _WORD, r << _WORD
        if int(now.max()) >= symbols:
            raise ValueError("damaged block: an id out of range")
        grid[t] = now
        model.learn(now, now == model.guess2, now == model.guess1)
    return np.ascontiguousarray(grid.T).reshape(-1)[:n]


def encode_block(keys: list[int | None], lengths, ids, symbols: int) -> bytes:
    """One block: documents ``keys`` of ``lengths`` ids each, ``ids`` all of
    them in order, each below ``symbols``."""
    ids = np.asarray(ids, np.int64)
    if symbols > MAX_SYMBOLS:
        raise ValueError(f"at most {MAX_SYMBOLS} symbols")
    if len(ids) and not (0 <= int(ids.min()) and int(ids.max()) < symbols):
        raise ValueError("an id out of range")
    lanes, steps = _lanes(len(ids))
    used, words = _code(ids, lanes, steps, symbols) if lanes else (np.zeros(0, np.int64), np.zeros(0, np.uint32))
    known = np.array([k is not None for k in keys], np.uint8)
    table = (
        np.array([k or 0 for k in keys], "<i8").tobytes() + known.tobytes() + np.asarray(lengths, "<u8").tobytes()
    )
    table = zlib.compress(table, 6)
    rest = struct.pack("<I", len(table)) + table + used.astype("<u4").tobytes() + words.astype("<u4").tobytes()
    check = zlib.crc32(ids.astype("<u4").tobytes())
    return _HEAD.pack(MAGIC, len(keys), len(ids), lanes, steps, symbols, check, zlib.crc32(rest)) + rest


def decode_block(block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """``(keys, lengths, ids)`` of a block; ids as unsigned 32-bit."""
    if len(block) < _HEAD.size or block[:4] != MAGIC:
        raise ValueError("not a block of token ids")
    _, docs, n, lanes, steps, symbols, check, check_rest = _HEAD.unpack_from(block)
    rest = memoryview(block)[_HEAD.size :]
    if zlib.crc32(rest) != check_rest:
        raise ValueError("damaged block: checksum of the content")
    (size,) = struct.unpack_from("<I", rest)
    table = zlib.decompress(rest[4 : 4 + size])
    keys = np.frombuffer(table, "<i8", docs)
    known = np.frombuffer(table, np.uint8, docs, 8 * docs)
    lengths = np.frombuffer(table, "<u8", docs, 9 * docs).astype(np.int64)
    used = np.frombuffer(rest, "<u4", lanes, 4 + size).astype(np.int64)
    words = np.frombuffer(rest, "<u4", int(used.sum()), 4 + size + 4 * lanes)
    ids = _decode(used, words, n, lanes, steps, symbols) if n else np.zeros(0, np.int64)
    ids = ids.astype("<u4")
    if zlib.crc32(ids.tobytes()) != check:
        raise ValueError("damaged block: checksum of the ids")
    return [int(k) if ok else None for k, ok in zip(keys, known, strict=True)], lengths, ids
