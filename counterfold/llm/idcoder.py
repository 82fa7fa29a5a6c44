"""Adaptive range coder for token ids, run over many blocks side by side.

A block is coded on its own, from a fresh model, and carries its length and a crc32.
Its model mixes three predictions of the next id, each learned from the block so far:

* order 2: the id that followed the last two ids before,
* order 1: the id that followed the last id before,
* order 0: the ids seen so far, by their counts (taken anew at the steps of ``RENEW``),
  and beside them a fixed share for ids not seen yet, falling with the id.

Each prediction holds a share of the coding interval.  The shares are the mixing weights
and follow the hits of the predictions, for each level of confidence.  Where two
predictions name the same id, their shares are added.

All blocks of a call advance one id at a time in numpy arrays, one element per block:
that is what keeps an adaptive coder usable from Python.
"""

from __future__ import annotations

import struct
import zlib
from functools import lru_cache

import numpy as np

BLOCK = 4096
VOCABULARY = 1 << 16
NAMED = (1 << 17) - 1  # the bits of an id or of none
ONE = 4096  # the whole of the shares
SLOTS1, SLOTS2, LEVELS = 1 << 12, 1 << 13, 8
RANKED, SORTED, TURNED = 4, 16, 64  # blocks ranked or sorted at a time, steps laid out
APART = 96  # places between blocks, so that these do not share lines of a cache
RENEW = [32, 64, 128, 256, 512, 1024, 2048, 3072]
TOP, LOW, AGAIN = np.uint64(1 << 48), np.uint64(1 << 40), np.uint64(1 << 32)
NONE, ONCE, SHARE, WORD = (np.uint64(x) for x in (0, 1, 12, 16))
HEAD = struct.Struct("<II")
ROW = ONE + 1
STEPS_AT = np.array([[0], [4 * ROW], [8 * ROW]], np.int32)
#: A level after a hit (a miss counts as one of level 0), above the bits of an id.
UP = (np.minimum(np.arange(LEVELS) + 1, LEVELS - 1) << 17).astype(np.int32)


@lru_cache(maxsize=1)
def unseen() -> np.ndarray:
    """Cumulative shares of ids not seen yet: 65,536 of at least one, low ids have more."""
    share = 1 + (1 << 22) // (np.arange(VOCABULARY) + 64) // 16
    return np.concatenate([[0], np.cumsum(share)]).astype(np.int64)


@lru_cache(maxsize=1)
def _steps() -> np.ndarray:
    """What weights become: of order 2, of order 1, of the seen ids.

    A weight of ``w`` stands at ``w + ROW * (hit of order 1 + 2 * hit of order 2)``, from
    ``4 * ROW`` on for order 1, from ``8 * ROW`` on for seen ids and there ``+ 4 * ROW`` where
    the id was seen.
    """
    w = np.arange(ROW, dtype=np.int64)
    down2, up2 = (np.clip(w + ((to - w) >> 4), 16, ONE - 128) for to in (0, ONE))
    down0, up0 = (np.clip(w + ((to - w) >> 5), 64, ONE - 64) for to in (0, ONE))
    return np.concatenate([down2, down2, up2, up2, down2, up2, w, w,
                           down0, w, w, w, up0, w, w, w]).astype(np.int16)


def _slots2(before: np.ndarray, last: np.ndarray) -> np.ndarray:
    return ((before * 40503 + last * 2654435761) >> 7) & (SLOTS2 - 1)


def _shares(weights: np.ndarray, seen: int) -> np.ndarray:
    """Where the shares end of orders 2 and 1 and of the seen ids."""
    ends = weights.copy()
    a2, a1, a0 = (ends[..., i, :] for i in range(3))
    a1 *= ONE - 8 - a2
    a1 >>= 12
    a1 += a2
    a1 += 1
    if seen:
        a0 *= ONE - 2 - a1
        a0 >>= 12
        a0 += a1
        a0 += 1
    else:
        a0[...] = a1
    return ends


class Weights:
    """Weights of ``lanes`` blocks, in one table: of order 2 and of order 1 at each level, of
    the seen ids."""

    def __init__(self, lanes: int):
        self.lanes, self.lane = lanes, np.arange(lanes, dtype=np.int64)
        # a row for a level, as lanes ask for the same ones
        self.weights = np.repeat(
            np.array([ONE // 2, ONE // 4, ONE // 2], np.int16),
            [lanes * LEVELS, lanes * LEVELS, lanes])

    def walk(self, level2, level1, hit2, hit1, old, seen: int) -> np.ndarray:
        """The three weights before each of some steps, given as rows of the first lanes, and
        the weights learned from all of them."""
        n, k = hit2.shape
        at, to = np.empty((n, 3, k), np.int64), np.empty((n, 3, k), np.int64)
        for i, level in enumerate((level2, level1, np.zeros_like(level1))):
            np.multiply(level, self.lanes, out=at[:, i], dtype=np.int64)
            at[:, i] += self.lane[:k] + i * LEVELS * self.lanes
        to[:, 0] = hit2 * (2 * ROW) + hit1 * ROW
        to[:, 1] = to[:, 0] + 4 * ROW
        to[:, 2] = to[:, 1] + (1 + old) * (4 * ROW) if seen else 9 * ROW  # 9: as it was
        at, to = at.reshape(n, -1), to.reshape(n, -1)
        values = np.empty((n, 3 * k), np.int32)
        for row in range(n):
            held = self.weights.take(at[row])
            values[row] = held
            self.weights[at[row]] = _steps().take(to[row] + held)
        return values.reshape(n, 3, k)


class Model(Weights):
    """Predictions of ``lanes`` blocks.  Only the first ``k`` lanes are still running."""

    def __init__(self, lanes: int):
        super().__init__(lanes)
        # what followed at the slots of order 2, then of order 1: an id, or VOCABULARY for
        # none, and above its bits the level of confidence.  Tables have a row for a slot:
        # lanes ask for the same frequent ones
        self.next = np.full(lanes * (SLOTS2 + SLOTS1), VOCABULARY, np.int32)
        self.slot_at = self.lane + np.array([[0], [SLOTS2 * lanes]])
        self.weight_at = self.lane + np.array([[0], [LEVELS * lanes], [2 * LEVELS * lanes]])
        self.last = np.zeros(lanes, np.int64)
        self.before = np.zeros(lanes, np.int64)

    def predict(self, k: int, seen: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of orders 2 and 1, and where the shares end: order 2, order 1, seen ids."""
        last = self.last[:k]
        slots = np.empty((2, k), np.int64)
        slots[0] = _slots2(self.before[:k], last)
        np.bitwise_and(last, SLOTS1 - 1, out=slots[1])
        slots *= self.lanes
        slots += self.slot_at[:, :k]
        held = self.next.take(slots)
        self.named, self.level = held & NAMED, held >> 17
        at = self.weight_at[:, :k].copy()
        at[:2] += self.level * self.lanes
        self.held = self.weights.take(at)
        self.slots, self.at = slots.ravel(), at.ravel()
        return self.named, _shares(self.held.astype(np.int64), seen)

    def learn(self, k: int, ids: np.ndarray, in_seen: np.ndarray, seen: int) -> None:
        """``ids``: int32, what came."""
        hits = self.named == ids
        to = self.held + (hits[0] * np.int32(2 * ROW) + hits[1] * np.int32(ROW))
        if seen:
            to[2] += in_seen * np.int32(4 * ROW)
        else:
            to[2] = self.held[2] + np.int32(ROW)  # stays as it is
        to += STEPS_AT
        self.weights[self.at] = _steps().take(to.ravel())
        self.next[self.slots] = (UP.take(self.level * hits) | ids).ravel()
        self.before[:k] = self.last[:k]
        self.last[:k] = ids


def _ready(low: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Where the upper 16 bits of intervals are settled.  An interval that is narrow but not
    settled is cut off at the border."""
    spread = low + width
    spread -= ONCE
    spread ^= low
    is_settled = spread < TOP
    narrow = ((width < LOW) > is_settled).nonzero()[0]
    if len(narrow):
        width[narrow] = (~low[narrow] + ONCE) & (LOW - ONCE)
        is_settled[narrow] = True
    return is_settled


def _settled(low: np.ndarray, width: np.ndarray):
    """Moves intervals on by 16 bits, as often as their upper 16 bits are settled; yields the
    lanes and the lower ends before."""
    at = _ready(low, width).nonzero()[0]
    while len(at):
        l, h = low.take(at), width.take(at)
        low[at], width[at] = l << WORD, h << WORD
        yield at, l
        at = at.take((h <= AGAIN).nonzero()[0])  # only these can have settled anew
        if len(at):
            h = width.take(at)
            is_settled = _ready(low.take(at), h)
            width[at] = h
            at = at.take(is_settled.nonzero()[0])


def _order(lengths: list[int]) -> np.ndarray:
    return np.argsort(-np.asarray(lengths, np.int64), kind="stable")


def _flat_order(keys: np.ndarray) -> np.ndarray:
    """The places of each row in the order of its keys, counted over all rows."""
    order = np.argsort(keys, axis=1, kind="stable")
    order += np.arange(len(keys))[:, None] * keys.shape[1]
    return order.ravel()


def _ranks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each id, where it lies among the sorted ids of the block at the last renewal.

    ``ids``: a block, or blocks of one length as rows.
    """
    rows = np.atleast_2d(ids)
    first, end = np.zeros(rows.shape, np.uint16), np.zeros(rows.shape, np.uint16)
    if rows.size:
        order = _flat_order(rows)
        sorted_ids = rows.ravel().take(order).reshape(rows.shape)
        new = np.ones(rows.shape, bool)
        new[:, 1:] = sorted_ids[:, 1:] != sorted_ids[:, :-1]
        place = np.empty(rows.size, np.int64)  # different ids, counted over all rows
        place[order] = np.cumsum(new) - 1
        place = place.reshape(rows.shape)
        before, done = np.arange(len(rows))[:, None], 0
        count = np.zeros(np.count_nonzero(new), np.int64)
        for n, to in zip(RENEW, RENEW[1:] + [BLOCK]):
            if n >= rows.shape[1]:
                break
            count += np.bincount(place[:, done:n].ravel(), minlength=len(count))
            done, at = n, place[:, n:to]
            ends = np.cumsum(count).take(at) - n * before
            end[:, n:to], first[:, n:to] = ends, ends - count.take(at)
    return first.reshape(ids.shape), end.reshape(ids.shape)


def _foretold(rows: np.ndarray) -> np.ndarray:
    """How a model predicts each id of blocks of one length, given as rows: the levels of
    orders 2 and 1, three bits each, whether order 2 names the id, whether order 1 does.

    The ids that came at a slot before tell this, without weights or intervals: a level
    counts the hits without a break before.
    """
    if not rows.size:
        return np.zeros(rows.shape, np.uint8)
    last, before = np.zeros(rows.shape, np.uint32), np.zeros(rows.shape, np.uint32)
    last[:, 1:], before[:, 2:] = rows[:, :-1], rows[:, :-2]
    out = np.zeros(rows.size, np.uint8)
    for bits, slots in ((0, _slots2(before, last)), (1, last & (SLOTS1 - 1))):
        slots = slots.astype(np.uint16)
        order = _flat_order(slots)
        slot, ids = slots.ravel().take(order), rows.ravel().take(order)
        again = np.zeros(rows.size, bool)  # not the first at its slot
        np.equal(slot[1:], slot[:-1], out=again[1:])
        again[:: rows.shape[1]] = False
        hit = again.copy()
        hit[1:] &= ids[1:] == ids[:-1]
        run, runs = hit.copy(), hit.astype(np.uint8)  # hits up to here, as far as levels go
        for back in range(1, LEVELS - 2):
            run[back:] &= hit[:-back]
            run[:back] = False
            runs += run
        level = again.astype(np.uint8)
        level[1:] += runs[:-1] * again[1:]
        out[order] |= level << (3 * bits) | hit.view(np.uint8) << (6 + bits)
    return out.reshape(rows.shape)


#: Bits of a packed run: where it begins, its length, its id.
BEGIN, LENGTH, LENGTH_AT, ID_AT = (np.uint64(x) for x in (0xFFFFFF, 0xFFFF, 24, 40))


@lru_cache(maxsize=1)
def _unseen_runs() -> np.ndarray:
    """For each unit of the shares of ``unseen`` its run."""
    cum = unseen()
    share = np.diff(cum)
    run = cum[:-1] | (share << 24) | (np.arange(VOCABULARY) << 40)
    return np.repeat(run.view(np.uint64), share)


def _packed_runs(rows: np.ndarray, out: np.ndarray) -> None:
    """For each place of the sorted rows the run of equal ids that it is in."""
    k, n = rows.shape
    for lane in range(0, k, SORTED):
        some = np.sort(rows[lane : lane + SORTED], axis=1, kind="stable")
        new = np.ones(some.shape, bool)
        new[:, 1:] = some[:, 1:] != some[:, :-1]
        at = new.ravel().nonzero()[0]  # runs end with their rows
        length = np.diff(at, append=some.size)
        run = (at % n) | (length << 24) | (some.ravel().take(at).astype(np.int64) << 40)
        out[lane * n : lane * n + some.size] = np.repeat(run.view(np.uint64), length)


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """Coded blocks of at most ``BLOCK`` ids below 65,536 each (uint16)."""
    if not blocks:
        return []
    order = _order([len(b) for b in blocks])
    lengths = np.array([len(blocks[i]) for i in order])
    n, longest = len(blocks), int(lengths[0])
    shape = n, longest + APART
    rows, told = np.zeros(shape, np.uint16), np.zeros(shape, np.uint8)
    first, end = np.zeros(shape, np.uint16), np.zeros(shape, np.uint16)
    for lane, i in enumerate(order):
        rows[lane, : len(blocks[i])] = blocks[i]
    lane = 0
    while lane < n:  # rows of one length, as many as fit a fast memory
        size = int(lengths[lane])
        to = min(lane + RANKED, int(np.searchsorted(-lengths, -size, "right")))
        first[lane:to, :size], end[lane:to, :size] = _ranks(rows[lane:to, :size])
        told[lane:to, :size] = _foretold(rows[lane:to, :size])
        lane = to
    cum = unseen()
    share, whole = np.diff(cum), int(cum[-1])
    weights = Weights(n)
    low, width = np.zeros(n, np.uint64), np.full(n, np.uint64(2**64 - 1))
    most = 3 * longest + APART
    out, used = np.zeros(n * most, np.uint16), np.arange(n) * most
    running = np.searchsorted(-lengths, -np.arange(longest), "left")
    # steps between these have the same lanes and the same seen ids
    borders = np.union1d([0, *RENEW, *range(0, BLOCK, TURNED), longest],
                         np.flatnonzero(np.diff(running)) + 1)
    borders = borders[borders <= longest].tolist()
    seen = 0
    for t, to in zip(borders, borders[1:]):
        k = int(running[t])
        if t in RENEW:
            seen = t
        turned = (np.ascontiguousarray(x[:k, t:to].T) for x in (rows, told, first, end))
        ids, tell, begins, ends = turned
        hit2, hit1, old = (tell & 64) > 0, tell > 127, ends > begins
        values = weights.walk(tell & 7, (tell >> 3) & 7, hit2, hit1, old, seen)
        a2, a1, a0 = _shares(values, seen).swapaxes(0, 1)
        start = np.where(hit1, a2, np.where(old, a1, a0))
        start[hit2] = 0
        size = np.where(hit1, a1, np.where(hit2, a2, np.where(old, a0, ONE))) - start
        start, size = start.astype(np.uint64), size.astype(np.uint64)
        at, rest = (~(hit1 | hit2)).nonzero()
        cuts = np.searchsorted(at, np.arange(to - t + 1)).tolist()
        flat = at * k + rest
        x, was, begin, stop = (v.ravel().take(flat) for v in (ids, old, begins, ends))
        total = np.where(was, max(seen, 1), whole).astype(np.uint64)
        part = np.where(was, stop - begin, share.take(x)).astype(np.uint64)
        begin = np.where(was, begin, cum.take(x)).astype(np.uint64)
        lo, wi = low[:k], width[:k]
        for row, (a, b) in enumerate(zip(cuts, cuts[1:])):
            wi >>= SHARE
            lo += wi * start[row]
            wi *= size[row]
            some = rest[a:b]
            unit = wi.take(some) // total[a:b]
            wi[some] = unit * part[a:b]
            lo[some] = lo.take(some) + unit * begin[a:b]
            for at, l in _settled(lo, wi):
                held = used.take(at)
                out[held] = l >> np.uint64(48)
                used[at] = held + 1
    for shift in (48, 32, 16, 0):
        out[used] = (low >> np.uint64(shift)) & np.uint64(0xFFFF)
        used += 1
    out, used = out.reshape(n, -1), used - np.arange(n) * most
    coded: list[bytes] = [b""] * n
    for lane, i in enumerate(order):
        head = HEAD.pack(len(blocks[i]), zlib.crc32(blocks[i].astype("<u2").tobytes()))
        coded[i] = head + out[lane, : used[lane]].astype("<u2").tobytes()
    return coded


def decode(coded: list[bytes]) -> list[np.ndarray]:
    """The ids of coded blocks; a block that does not match its crc32 raises ValueError."""
    if not coded:
        return []
    heads = [HEAD.unpack_from(c) for c in coded]
    order = _order([h[0] for h in heads])
    lengths = np.array([heads[i][0] for i in order])
    n, longest = len(coded), int(lengths[0])
    most = max(len(c) for c in coded) // 2 + 8
    words, used = np.zeros((n, most), np.uint16), np.arange(n) * most + 4
    for lane, i in enumerate(order):
        w = np.frombuffer(coded[i], "<u2", offset=HEAD.size)
        words[lane, : len(w)] = w
    code = np.zeros(n, np.uint64)  # as counted from the interval's lower end
    for c in range(4):
        code = (code << np.uint64(16)) | words[:, c]
    words = words.ravel()
    ids = np.zeros((n, longest + APART), np.uint16)[:, :longest]
    recent = np.zeros((TURNED, n), np.uint16)
    model, unseen_runs = Model(n), _unseen_runs()
    whole = len(unseen_runs)
    runs = np.empty(whole + n * max([0, *(r for r in RENEW if r < longest)]), np.uint64)
    runs[:whole] = unseen_runs
    low, width = np.zeros(n, np.uint64), np.full(n, np.uint64(2**64 - 1))
    running = np.searchsorted(-lengths, -np.arange(longest), "left").tolist()
    seen, done, totals = 0, 0, np.array([1, whole], np.uint64)
    for t in range(longest):
        k = running[t]
        if t - done == TURNED or t in RENEW:
            ids[:, done:t] = recent[: t - done].T
            done = t
        if t in RENEW:
            seen = t
            totals[0] = t
            _packed_runs(ids[:k, :t], runs[whole:])
        named, shares = model.predict(k, seen)
        lo, wi, co = low[:k], width[:k], code[:k]
        ends = np.empty((4, k), np.uint64)
        wi >>= SHARE
        np.multiply(shares.view(np.uint64), wi, out=ends[:3])
        np.left_shift(wi, SHARE, out=ends[3])
        np.copyto(ends[0], ends[1], where=named[0] == named[1])
        inside = co < ends[:3]
        start = np.where(inside[0], NONE, ends[0])
        np.subtract(np.where(inside[0], ends[0], ends[1]), start, out=wi)
        x = np.where(inside[0], named[0], named[1])
        rest = (~inside[1]).nonzero()[0]
        if len(rest):
            is_new = ~inside[2].take(rest)
            at = is_new * k
            at += rest
            at += k
            begin, unit = ends.take(at), ends.take(at + k)
            unit -= begin
            total = totals.take(is_new)
            unit //= total
            u = co.take(rest)
            u -= begin
            u //= unit
            total -= ONCE
            np.minimum(u, total, out=u)
            held = runs.take(u.view(np.int64) + np.where(is_new, 0, rest * seen + whole))
            x[rest] = held >> ID_AT
            part = held & BEGIN
            part *= unit
            part += begin
            start[rest] = part
            held >>= LENGTH_AT
            held &= LENGTH
            held *= unit
            wi[rest] = held
        lo += start
        co -= start
        recent[t - done, :k] = x
        model.learn(k, x, inside[2] > inside[1], seen)
        for at, _ in _settled(lo, wi):
            to = used.take(at)
            # words behind the last are read only where a block is damaged
            co[at] = (co.take(at) << WORD) | words.take(to, mode="clip")
            used[at] = to + 1
    ids[:, done:] = recent[: longest - done].T
    plain: list[np.ndarray] = [ids[:0, 0]] * n
    for lane, i in enumerate(order):
        size, crc = heads[i]
        block = ids[lane, :size].copy()
        if zlib.crc32(block.astype("<u2").tobytes()) != crc:
            raise ValueError(f"block {i} is damaged: its ids do not match its crc32")
        plain[i] = block
    return plain
