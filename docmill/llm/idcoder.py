"""An adaptive range coder for blocks of token ids, run over many blocks at once with numpy.

A block of up to ``BLOCK`` ids starts from nothing. Ids are numbered by first
appearance in their block; of each next number an order-2 and an order-1
context predict one, with a confidence, and order 0 counts those seen. The three
are mixed: a prediction of order k holds with a probability learned for its
confidence, and weights that follow how well each order did share the code
space between "as order 2 says", "as order 1 says" and "by order 0". An id new to
its block takes order 0's escape and is then coded evenly over the vocabulary.

Blocks depend on nothing but their bytes; lanes only share the loop. Probabilities
are made with single IEEE operations, so every machine decodes the same.
"""

from __future__ import annotations

import numpy as np

#: Ids in a block: a number and its confidence fill 16 bits.
BLOCK = 4096
#: Blocks that are coded together.
LANES = 1024
_SCALE, _BITS = np.float32(65000), np.uint64(16)
_LOW, _WORD = np.uint64(0xFFFFFFFF), np.uint64(32)
_FULL = np.uint64(1 << 32)
_RATE, _FLOOR, _MISS = np.float32(1 / 24), np.float32(1 / 64), np.float32(1 / 32)
_ONE = np.float32(1)
_SUM = np.uint64(0x0101010101010101)
#: What a count of 1 (rows 0 to 15) or 2 (rows 16 to 31) adds to the sums before each of 16 children.
_STEPS = np.concatenate([np.arange(16) > np.arange(16)[:, None]] * 2).astype(np.int16)
_STEPS[16:] *= 2
#: Four sums of 16 bits in a word; none reaches 2 * BLOCK, so none spills into the next.
_STEPS = _STEPS.view(np.uint64)
_TOP = np.uint64(56)


class _Model:
    """What both sides know of each lane's block so far."""

    def __init__(self, n: int):
        self.n, self.lane = n, np.arange(n)
        self.two, self.one = np.zeros(BLOCK * n, np.uint16), np.zeros(BLOCK * n, np.uint16)  # number << 4 | confidence
        start = np.repeat(((np.arange(16) + 0.25) / (np.arange(16) + 2)).astype(np.float32), n)
        self.hit2, self.hit1 = start.copy(), start.copy()
        self.w2, self.w1, self.w0 = (np.full(n, x, np.float32) for x in (0.5, 0.375, 0.125))
        self.last, self.before = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.sums = [np.zeros((n * 16**k, 4), np.uint64) for k in range(3)]
        self.flat = [s.reshape(-1).view(np.int16) for s in self.sums]
        self.count = np.zeros(n * BLOCK, np.int16)
        self.total, self.distinct = np.zeros(n, np.int64), np.zeros(n, np.int64)

    def predict(self) -> tuple[np.ndarray, np.ndarray]:
        """Shares of 65536 of "as order 2" and, beyond it, of "as order 1"."""
        n, lane = self.n, self.lane
        self.i2 = ((self.before * 1597 + self.last) & (BLOCK - 1)) * n + lane
        self.i1 = self.last * n + lane
        self.e2, self.e1 = self.two.take(self.i2), self.one.take(self.i1)
        self.n2, self.n1 = self.e2 >> 4, self.e1 >> 4
        self.j2, self.j1 = (self.e2 & 15) * np.int64(n) + lane, (self.e1 & 15) * np.int64(n) + lane
        self.h2, self.h1 = self.hit2.take(self.j2), self.hit1.take(self.j1)
        self.same = self.n2 == self.n1
        a, b = self.w2 * self.h2, self.w1 * self.h1
        both = (a + b) * _SCALE
        first = np.where(self.same, both, a * _SCALE).astype(np.uint64) + np.uint64(1)
        return first, np.maximum(both.astype(np.uint64) + np.uint64(2), first)

    def learn(self, event: np.ndarray, x: np.ndarray) -> None:
        """event: 0, 1 or 2 as coded; x: the number that came."""
        second = event == 0
        hit1 = (event == 1) | (second & self.same)
        for hits, j, h, right in ((self.hit2, self.j2, self.h2, second), (self.hit1, self.j1, self.h1, hit1)):
            hits[j] = h + (right - h) * _RATE
        w2, w1 = self.w2 * np.where(second, self.h2, _ONE - self.h2), self.w1 * np.where(hit1, self.h1, _ONE - self.h1)
        w0 = self.w0 * np.where(event == 2, _ONE, _MISS)
        share = (_ONE - 3 * _FLOOR) / (w2 + w1 + w0)
        self.w2, self.w1, self.w0 = w2 * share + _FLOOR, w1 * share + _FLOOR, w0 * share + _FLOOR
        fresh = (x << 4).astype(np.uint16)
        for table, i, e, right in ((self.two, self.i2, self.e2, second), (self.one, self.i1, self.e1, hit1)):
            sure = e & 15
            # A hit raises the confidence, a miss halves it, and a miss without confidence replaces the number.
            table[i] = np.where(right, e + (sure < 15), np.where(sure > 0, e - ((sure + 1) >> 1), fresh))
        self.before, self.last = self.last, x

    def places(self, rows: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
        """Where each level's sums have the child on the way to x."""
        return [rows * 16 + (x >> 8), rows * 256 + (x >> 4), rows * BLOCK + x]

    def below(self, places: list[np.ndarray]) -> np.ndarray:
        """Counts of the numbers before x."""
        return sum(s.take(p) for s, p in zip(self.flat, places)).astype(np.int64)

    def find(self, rows: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number whose share of order 0 holds v, and the counts of those before it."""
        rest, node = v.astype(np.int16), rows
        for s, flat in zip(self.sums, self.flat):
            under = (s.take(node, axis=0).view(np.int16) <= rest[:, None]).view(np.uint64)
            child = (((under[:, 0] + under[:, 1]) * _SUM) >> _TOP).astype(np.int64) - 1
            node = node * 16 + child
            rest = rest - flat.take(node)
        return node - rows * BLOCK, v - rest

    def add(self, rows: np.ndarray, places: list[np.ndarray], new: np.ndarray) -> None:
        up = np.where(new, 0, 16)
        for s, p in zip(self.sums, places):
            node = p >> 4
            s[node] = s.take(node, axis=0) + _STEPS.take((p & 15) + up, axis=0)
        self.count[places[2]] += 2 - new.astype(np.int16)
        self.total[rows] += 2 - new
        self.distinct[rows] += new


def _parts(vocab: int) -> list[tuple[int, int]]:
    """(shift, total) of the even steps that code a new id."""
    return [(0, vocab)] if vocab <= 1 << 16 else [(16, (vocab - 1 >> 16) + 1), (0, 1 << 16)]


def _numbers(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row: each id's number by first appearance in the row, and whether it appears for the first time."""
    numbers, first = np.zeros(ids.shape, np.int16), np.zeros(ids.shape, bool)
    small = ids.astype(np.uint16) if ids.size and int(ids.max()) < 1 << 16 else ids  # sorted by digits
    for row, out, new in zip(small, numbers, first):
        order = np.argsort(row, kind="stable")
        key = row[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        where = order[starts]
        new[where] = True
        out[order] = np.repeat((np.cumsum(new) - 1)[where], np.diff(np.append(starts, len(row))))
    return numbers, first


def encode(ids: np.ndarray, vocab: int) -> list[bytes]:
    """The code of each row of ids (all of one length, at most BLOCK)."""
    n, steps = ids.shape
    model, lane = _Model(n), np.arange(n)
    numbers, news = (np.ascontiguousarray(x.T) for x in _numbers(ids))
    ids = np.ascontiguousarray(ids.T)
    low, span = np.zeros(n, np.uint64), np.full(n, ~np.uint64(0))
    out, at = np.zeros((n, 2 * steps + 8), np.uint32), np.zeros(n, np.int64)

    def normalise(rows: np.ndarray | None = None) -> None:
        need = np.flatnonzero(span < _FULL) if rows is None else rows[span[rows] < _FULL]
        if len(need):
            lo, s = low[need], span[need]
            cross = (lo ^ (lo + s - np.uint64(1))) > _LOW
            s = np.where(cross, (~lo + np.uint64(1)) & _LOW, s)
            p = at[need]
            out[need, p] = lo >> _WORD
            at[need] = p + 1
            low[need], span[need] = lo << _WORD, s << _WORD

    for t in range(steps):
        x, new = numbers[t].astype(np.int64), news[t]
        first, second = model.predict()
        event = np.where((x == model.n2) & ~new, 0, np.where((x == model.n1) & ~new, 1, 2))
        r = span >> _BITS
        begin = np.where(event == 0, np.uint64(0), np.where(event == 1, first, second))
        low += r * begin
        span = r * (np.where(event == 0, first, np.where(event == 1, second, np.uint64(65536))) - begin)
        rows = np.flatnonzero(event == 2)
        if len(rows):
            fresh, distinct, known, y = new[rows], model.distinct[rows], model.total[rows], x[rows]
            places = model.places(rows, y)
            r = span[rows] // (known + distinct + 1).astype(np.uint64)
            low[rows] += r * np.where(fresh, known, model.below(places)).astype(np.uint64)
            span[rows] = r * np.where(fresh, distinct + 1, model.count.take(places[2])).astype(np.uint64)
        # The share of order 0 and that of its number, 30 bits together, fit in what is left of 32 or more.
        normalise()
        if len(rows):
            some = rows[fresh]
            if len(some):
                for shift, total in _parts(vocab):
                    part = (ids[t, some].astype(np.int64) >> shift) & 0xFFFF
                    r = span[some] // np.uint64(total)
                    low[some] += r * part.astype(np.uint64)
                    span[some] = r
                    normalise(some)
            model.add(rows, places, fresh)
        model.learn(event, x)
    for shift in (_WORD, np.uint64(0)):
        out[lane, at] = (low >> shift) & _LOW
        at += 1
    return [out[i, : at[i]].astype("<u4").tobytes() for i in range(n)]


def decode(codes: list[bytes], lengths: list[int], vocab: int) -> list[np.ndarray]:
    """The ids of each code. Damaged codes give other ids or not enough of them; the caller compares a checksum."""
    n, steps = len(codes), max(lengths, default=0)
    if not steps:
        return [np.zeros(0, np.uint32) for _ in codes]
    model, lane = _Model(n), np.arange(n)
    sizes = [len(c) // 4 for c in codes]
    width = max(sizes) + 2
    words = np.zeros((n, width), np.uint64)
    for i, c in enumerate(codes):
        words[i, : sizes[i]] = np.frombuffer(c, "<u4", sizes[i])
    low, span = np.zeros(n, np.uint64), np.full(n, ~np.uint64(0))
    code, at = (words[:, 0] << _WORD) | words[:, 1], np.full(n, 2)
    of = np.zeros(n * BLOCK, np.uint32)
    out = np.zeros((steps, n), np.uint32)

    def normalise(rows: np.ndarray | None = None) -> None:
        need = np.flatnonzero(span < _FULL) if rows is None else rows[span[rows] < _FULL]
        if len(need):
            lo, s = low[need], span[need]
            cross = (lo ^ (lo + s - np.uint64(1))) > _LOW
            s = np.where(cross, (~lo + np.uint64(1)) & _LOW, s)
            p = at[need]
            code[need] = (code[need] << _WORD) | words[need, np.minimum(p, width - 1)]
            at[need] = p + 1
            low[need], span[need] = lo << _WORD, np.maximum(s, np.uint64(1)) << _WORD

    for t in range(steps):
        first, second = model.predict()
        r = span >> _BITS
        v = np.minimum((code - low) // r, np.uint64(65535))
        event = (v >= first).astype(np.int64) + (v >= second)
        begin = np.where(event == 0, np.uint64(0), np.where(event == 1, first, second))
        low += r * begin
        span = r * (np.where(event == 0, first, np.where(event == 1, second, np.uint64(65536))) - begin)
        x = np.where(event == 0, model.n2, model.n1).astype(np.int64)
        rows = np.flatnonzero(event == 2)
        if len(rows):
            distinct, known = model.distinct[rows], model.total[rows]
            whole, lo = known + distinct + 1, low[rows]
            r = np.maximum(span[rows] // whole.astype(np.uint64), np.uint64(1))
            v = np.minimum((code[rows] - lo) // r, (whole - 1).astype(np.uint64)).astype(np.int64)
            fresh = v >= known
            y, before = model.find(rows, np.where(fresh, 0, v))
            y = np.where(fresh, np.minimum(distinct, BLOCK - 1), y)
            places = model.places(rows, y)
            low[rows] = lo + r * np.where(fresh, known, before).astype(np.uint64)
            span[rows] = r * np.where(fresh, distinct + 1, np.maximum(model.count.take(places[2]), 1)).astype(np.uint64)
        normalise()
        if len(rows):
            some = rows[fresh]
            if len(some):
                token = np.zeros(len(some), np.uint64)
                for shift, total in _parts(vocab):
                    r = span[some] // np.uint64(total)
                    part = np.minimum((code[some] - low[some]) // r, np.uint64(total - 1))
                    low[some] += r * part
                    span[some] = r
                    normalise(some)
                    token |= part << np.uint64(shift)
                of[some * BLOCK + y[fresh]] = token
            x[rows] = y
            model.add(rows, places, fresh)
        out[t] = of.take(lane * BLOCK + x)
        model.learn(event, x)
    return [np.ascontiguousarray(out[: lengths[i], i]) for i in range(n)]
