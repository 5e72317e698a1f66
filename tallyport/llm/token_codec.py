"""Token ids in compact binary blocks: adaptive range coder over mixed order-0 to order-2 predictions.

A block is coded by itself: all models start empty in it, and it carries checksums. Its ids are
dealt to lanes, consecutive stretches that are coded side by side (one numpy operation handles a
step of all lanes) and share the block's models, which are updated after each step.

An id's probability is a mixture of three predictions: its adaptive frequency in the block
(order 0), the id last seen after the previous one (order 1), and the one last seen after
the previous two (order 2). The weights of the last two are the adaptive hit rates of their
confidence. The mixture's cumulative frequencies drive one range coder for each lane.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

# Lanes of a block at most, by the sign that it begins with; blocks are written with the last one's.
LANES = {b"TKB1": 1024, b"TKB2": 8192}
MAGIC, MIN_STEPS = b"TKB2", 64
# Weights are 256ths; the frequency model keeps at least some of them.
WHOLE, MOST = 256, 252
CONFIDENCE = 8
# The frequency table is summed up anew after this many steps.
REFRESH = 8
GAIN = 8
SLOTS = 1 << 18

# A confidence after a miss and after a hit; after a miss with little of it the guess changes.
NEXT = np.array([1, 1, *(c // 2 for c in range(2, CONFIDENCE)), *range(1, CONFIDENCE), CONFIDENCE - 1])

U = np.uint64
_LOW_16, _TOP, _BOTTOM = U(48), U(1 << 48), U(1 << 40)


class Models:
    """The adaptive state of a block; coder and decoder make the same updates."""

    def __init__(self, vocabulary: int, lanes: int):
        self.counts = np.ones(vocabulary, np.int64)
        self.sums = np.zeros(vocabulary + 1, np.int64)
        self.after_one, self.sure_one = np.zeros(vocabulary, np.int64), np.zeros(vocabulary, np.int64)
        self.after_two, self.sure_two = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
        self.hits = np.ones((2, CONFIDENCE), np.int64)
        self.tries = np.full((2, CONFIDENCE), 4, np.int64)
        self.one, self.two = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.step = 0

    def predict(self, active: int) -> tuple[np.ndarray, ...]:
        """Predicted ids of both orders, their masses and the weight of the frequencies, for the first lanes."""
        if self.step % REFRESH == 0 or self.step < REFRESH:
            np.cumsum(self.counts, out=self.sums[1:])
            self.held = self.counts.copy()
        one, two = self.one[:active], self.two[:active]
        self.slot = ((two * 0x9E3779B1 + one * 0x85EBCA77) >> 7) & (SLOTS - 1)
        self.guess_one, self.guess_two = self.after_one[one], self.after_two[self.slot]
        self.trust_one, self.trust_two = self.sure_one[one], self.sure_two[self.slot]
        odds = self.hits * MOST // self.tries
        k_two = odds[1].take(self.trust_two)
        # by both confidences
        rest = odds[0][:, None] * (MOST - odds[1]) // MOST
        k_one = rest.reshape(-1).take(self.trust_one * CONFIDENCE + self.trust_two)
        return self.guess_one, self.guess_two, k_one, k_two, WHOLE - k_one - k_two

    def update(self, ids: np.ndarray) -> None:
        active = len(ids)
        one = self.one[:active]
        for order, guess, trust, at, after, sure in (
            (0, self.guess_one, self.trust_one, one, self.after_one, self.sure_one),
            (1, self.guess_two, self.trust_two, self.slot, self.after_two, self.sure_two),
        ):
            # the place in NEXT: the confidence, and behind all of them that with a hit
            place = trust + (guess == ids) * CONFIDENCE
            missed, hit = np.bincount(place, minlength=2 * CONFIDENCE).reshape(2, CONFIDENCE)
            self.tries[order] += missed + hit
            self.hits[order] += hit
            change = np.flatnonzero(place <= 1)
            after[at[change]] = ids[change]
            sure[at] = NEXT.take(place)
        np.add.at(self.counts, ids, GAIN)
        self.two[:active] = one
        self.one[:active] = ids
        self.step += 1


def _layout(n: int, magic: bytes) -> tuple[int, int]:
    """Number of lanes and steps for `n` ids."""
    lanes = max(1, min(LANES[magic], n // MIN_STEPS))
    return lanes, -(-n // lanes)


def _shares(n: int, lanes: int) -> np.ndarray:
    """Ids of each lane, the longer lanes first."""
    return np.full(lanes, n // lanes) + (np.arange(lanes) < n % lanes)


def encode(ids: np.ndarray, vocabulary: int) -> bytes:
    """The coded form of ids below `vocabulary`."""
    n = len(ids)
    if not n:
        return b""
    lanes, steps = _layout(n, MAGIC)
    shares = _shares(n, lanes)
    begins = np.cumsum(shares) - shares
    models = Models(vocabulary, lanes)
    low, width = np.zeros(lanes, U), np.full(lanes, ~U(0), U)
    words = np.zeros((lanes, 3 * steps + 8), np.uint16)
    used = np.zeros(lanes, np.int64)
    for step in range(steps):
        active = lanes if step < n // lanes else n % lanes
        x = ids[begins[:active] + step]
        g1, g2, k1, k2, k0 = models.predict(active)
        total = models.sums[-1]
        start = models.sums[x] * k0 + total * (k1 * (g1 < x) + k2 * (g2 < x))
        size = models.held[x] * k0 + total * (k1 * (g1 == x) + k2 * (g2 == x))
        part = width[:active] // U(total * WHOLE)
        low[:active] += start.astype(U) * part
        width[:active] = size.astype(U) * part
        _shift_out(low, width, words, used, active)
        models.update(x)
    for _ in range(4):
        words[np.arange(lanes), used] = (low >> _LOW_16).astype(np.uint16)
        low <<= U(16)
        used += 1
    flat = words[np.arange(words.shape[1]) < used[:, None]]
    return used.astype("<u4").tobytes() + flat.astype("<u2").tobytes()


def _shift_out(low: np.ndarray, width: np.ndarray, words: np.ndarray, used: np.ndarray, active: int) -> None:
    at = _settled(low[:active], width[:active])
    while len(at):
        words[at, used[at]] = (low[at] >> _LOW_16).astype(np.uint16)
        used[at] += 1
        low[at] <<= U(16)
        width[at] <<= U(16)
        at = at[_settled(low, width, at)]


def _settled(low: np.ndarray, width: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """Which lanes (of those at `at`) have 16 bits to shift out."""
    a, w = (low, width) if at is None else (low[at], width[at])
    same = (a ^ (a + w)) < _TOP
    short = ~same & (w < _BOTTOM)
    cut = np.flatnonzero(short)
    if len(cut):
        # the interval straddles a boundary: it is cut down to this side of it
        width[cut if at is None else at[cut]] = (~a[cut] + U(1)) & (_BOTTOM - U(1))
    return np.flatnonzero(same | short)


def decode(data: bytes, n: int, vocabulary: int, magic: bytes = MAGIC) -> np.ndarray:
    """The `n` ids of a coded form."""
    out = np.empty(n, np.int64)
    if not n:
        return out
    lanes, steps = _layout(n, magic)
    shares = _shares(n, lanes)
    begins = np.cumsum(shares) - shares
    used = np.frombuffer(data, "<u4", lanes).astype(np.int64)
    words = np.append(np.frombuffer(data, "<u2", offset=4 * lanes), np.zeros(8, np.uint16)).astype(U)
    at = np.cumsum(used) - used
    models = Models(vocabulary, lanes)
    low, width, code = np.zeros(lanes, U), np.full(lanes, ~U(0), U), np.zeros(lanes, U)
    for _ in range(4):
        code = code << U(16) | words[at]
        at += 1
    for step in range(steps):
        active = lanes if step < n // lanes else n % lanes
        g1, g2, k1, k2, k0 = models.predict(active)
        total = models.sums[-1]
        part = width[:active] // U(total * WHOLE)
        value = np.minimum((code[:active] - low[:active]) // part, U(total * WHOLE - 1)).astype(np.int64)
        # the two predicted ids in order, with their masses; behind each its mass is taken off
        a, b = np.minimum(g1, g2), np.maximum(g1, g2)
        # of equal ones the first has both masses
        ka = np.where(g1 < g2, k1, np.where(g1 > g2, k2, k1 + k2)) * total
        kb = np.where(g1 < g2, k2, np.where(g1 > g2, k1, 0)) * total
        from_a = models.sums[a] * k0
        past_a = value >= models.sums[a + 1] * k0 + ka
        rest = value - ka * past_a
        from_b = models.sums[b] * k0
        past_b = past_a & (rest >= models.sums[b + 1] * k0 + kb)
        in_a, in_b = ~past_a & (value >= from_a), past_a & ~past_b & (rest >= from_b)
        x = np.where(in_a, a, b)
        other = np.flatnonzero(~(in_a | in_b))
        # whole numbers below 2^44 over weights up to 256: the quotient's floor is exact as a double
        own = ((rest[other] - kb[other] * past_b[other]) / k0[other]).astype(np.int64)
        x[other] = _looked_up(models.sums, own)
        x = np.minimum(x, vocabulary - 1)
        start = models.sums[x] * k0 + total * (k1 * (g1 < x) + k2 * (g2 < x))
        size = models.held[x] * k0 + total * (k1 * (g1 == x) + k2 * (g2 == x))
        low[:active] += start.astype(U) * part
        width[:active] = size.astype(U) * part
        out[begins[:active] + step] = x
        _shift_in(low, width, code, words, at, active)
        models.update(x)
    return out


def _looked_up(sums: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The ids in whose share of the sums the values lie; asked nearly in order, which keeps to the same part of the table."""
    # 16 bits are ordered by their digits, faster than whole values
    shift = max(0, int(sums[-1]).bit_length() - 16)
    order = np.argsort((values >> shift).astype(np.uint16), kind="stable")
    found = np.empty(len(values), np.int64)
    found[order] = np.searchsorted(sums, values[order], side="right") - 1
    return found


def _shift_in(low: np.ndarray, width: np.ndarray, code: np.ndarray, words: np.ndarray, at: np.ndarray, active: int) -> None:
    lane = _settled(low[:active], width[:active])
    while len(lane):
        code[lane] = code[lane] << U(16) | words[np.minimum(at[lane], len(words) - 1)]
        at[lane] += 1
        low[lane] <<= U(16)
        width[lane] <<= U(16)
        lane = lane[_settled(low, width, lane)]


def pack(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray, vocabulary: int) -> bytes:
    """A block: header, document ids and lengths, coded ids, checksums of the ids and of the block."""
    known = np.array([i is not None for i in doc_ids], np.uint8)
    names = np.array([0 if i is None else i for i in doc_ids], "<i8")
    head = zlib.compress(known.tobytes() + names.tobytes() + counts.astype("<u4").tobytes(), 1)
    body = encode(ids, vocabulary)
    check = zlib.crc32(ids.astype("<u4").tobytes())
    block = MAGIC + struct.pack("<IIIIII", len(doc_ids), len(ids), vocabulary, len(head), len(body), check) + head + body
    return block + struct.pack("<I", zlib.crc32(block))


def unpack(block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, numbers of ids and all ids of a block; ValueError if it is damaged."""
    if block[:4] not in LANES or zlib.crc32(block[:-4]) != struct.unpack("<I", block[-4:])[0]:
        raise ValueError("damaged block")
    docs, n, vocabulary, head_size, body_size, check = struct.unpack("<IIIIII", block[4:28])
    head = zlib.decompress(block[28 : 28 + head_size])
    known = np.frombuffer(head, np.uint8, docs)
    names = np.frombuffer(head, "<i8", docs, docs)
    counts = np.frombuffer(head, "<u4", docs, 9 * docs).astype(np.int64)
    ids = decode(block[28 + head_size : 28 + head_size + body_size], n, vocabulary, block[:4])
    if zlib.crc32(ids.astype("<u4").tobytes()) != check:
        raise ValueError("damaged ids")
    return [int(i) if k else None for i, k in zip(names, known, strict=True)], counts, ids
