"""A context-mixing range coder for blocks of token ids.

A block is cut into lanes of equal length that advance in step, one token each, so that every
operation is one numpy operation over all lanes. All lanes learn one model, which a block
starts anew:

* order 2 and order 1 predict the id last seen after the two, or the one, ids before; a
  confidence counts how often in a row that was right;
* how far the two predictions are trusted, against each other and against order 0, is learned
  for every pair of confidences: that mixes the three distributions into one;
* order 0 is the adaptive frequency of the ids.

The mixed distribution drives a 64-bit range coder per lane; a carry goes into the words that
the lane has given. Words lie in the order in which a decoder asks for them, so that it reads
slices. Block layout, all numbers little-endian: MAGIC, crc32 of what follows, then a header
(ids, lanes, ids' range, crc32 of the ids), and the words, 16 bits each.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"TSM2"
HEADER = struct.Struct("<QIII")
LANES, LANE_IDS = 4096, 512
MIX_BITS, ID_BITS = 16, 18
PAIR_BITS = 20
WINDOW = 4  # words of 16 bits in the 64 bits of a lane
BOTTOM = np.uint64(1 << 48)  # a wider span is left for MIX_BITS and ID_BITS together
U0, U16, U48, MIX, ORDER0 = (np.uint64(n) for n in (0, 16, 48, MIX_BITS, ID_BITS))
ID, TRUST, MOST = np.uint32(0xFFFF), np.uint32(1 << 16), np.uint32(7 << 16)


class Model:
    """The state both sides keep alike. ``vocabulary`` is at most 2 ** 16."""

    def __init__(self, vocabulary: int, lanes: int):
        self.one = np.zeros(vocabulary, np.uint32)  # predicted id | confidence << 16
        self.two = np.zeros(1 << PAIR_BITS, np.uint32)
        self.seen = np.ones((64, 3), np.int64)  # by confidences: order 2 right, order 1, neither
        self.count = np.zeros(vocabulary, np.int64)
        self.last = self.before = np.zeros(lanes, np.uint32)
        self.last_at = np.zeros(lanes, np.intp)  # last, as an index
        self.held = np.zeros((2, lanes), np.uint32)  # what two and one hold for each lane
        self.step, self.next_table = 0, 0
        self.ids, self.events = [], []  # not yet counted: counts matter when tables are made
        self.tables()
        self.shares()

    def tables(self) -> None:
        """Order 0 again from the counts: first at every doubling, later every 64 steps."""
        if self.ids:
            self.count += np.bincount(np.concatenate(self.ids), minlength=len(self.count))
            self.seen += np.bincount(np.concatenate(self.events), minlength=192).reshape(64, 3)
            self.ids, self.events = [], []
        room = (1 << ID_BITS) - len(self.count)
        total = max(1, int(self.count.sum()))
        self.freq = (1 + self.count * room // total).astype(np.uint64)
        self.start = np.cumsum(self.freq) - self.freq
        self.by_value = None
        self.next_table = self.step + min(64, max(1, self.step))

    def shares(self) -> None:
        f = 1 + self.seen * ((1 << MIX_BITS) - 3) // self.seen.sum(axis=1, keepdims=True)
        f[:, 2] += (1 << MIX_BITS) - f.sum(axis=1)
        mix = f.astype(np.uint64)
        start = np.cumsum(mix, axis=1) - mix
        # By state * 3 + event; and the two inner bounds by state.
        self.mix, self.mix_start = mix.ravel(), start.ravel()
        self.first, self.second = start[:, 1].copy(), start[:, 2].copy()

    def predict(self) -> None:
        h = (self.before * np.uint32(0x9E3779B1)) ^ (self.last * np.uint32(0x85EBCA6B))
        self.at = (h >> np.uint32(32 - PAIR_BITS)).astype(np.intp)
        self.two.take(self.at, out=self.held[0], mode="clip")
        self.one.take(self.last_at, out=self.held[1], mode="clip")
        self.id2, self.id1 = self.held & ID
        trust2, trust1 = self.held >> np.uint32(16)
        self.state = ((trust2 << np.uint32(3)) | trust1).astype(np.intp)

    def learn(self, ids: np.ndarray, at_event: np.ndarray) -> None:
        """The ids of a step and their events, each as state * 3 + event."""
        # Right: one more confidence, up to the most. Wrong: half of it; without any, the new id.
        # Masks of all bits stand for the conditions: cheaper than choosing lane by lane.
        held, differs = self.held, self.held ^ ids
        right = ((differs & ID) - np.uint32(1)).view(np.int32) >> 31
        unsure = (held - TRUST).view(np.int32) >> 31
        more = held + TRUST
        less = held - ((more >> np.uint32(17)) << np.uint32(16))
        less ^= differs & unsure.view(np.uint32)
        np.minimum(more, held | MOST, out=more)
        new = less ^ ((less ^ more) & right.view(np.uint32))
        self.two[self.at], self.one[self.last_at] = new
        ids_at = ids.astype(np.intp)
        self.events.append(at_event)
        self.ids.append(ids_at)
        self.before, self.last, self.last_at = self.last, ids, ids_at
        self.step += 1
        if self.step >= self.next_table:
            self.tables()
            self.shares()


def _rows(n: int) -> tuple[int, int]:
    lanes = max(1, min(LANES, n // LANE_IDS))
    return lanes, -(-n // lanes)


def _shift(state: np.ndarray, span: np.ndarray, which: np.ndarray, below: np.ndarray | np.uint64) -> np.ndarray:
    """Moves the lanes ``which`` on by a word; the lanes of them whose span is narrow still."""
    state[which] = (state.take(which) << U16) | below
    spans = span.take(which) << U16
    span[which] = spans
    return which[spans < BOTTOM]


def encode_block(ids: np.ndarray) -> bytes:
    n = len(ids)
    lanes, steps = _rows(n)
    vocabulary = int(ids.max()) + 1 if n else 1
    if vocabulary > 1 << 16:
        raise ValueError("ids must be below 65536")
    padded = np.zeros(lanes * steps, np.uint16)
    padded[:n] = ids
    columns = np.ascontiguousarray(padded.reshape(lanes, steps).T)
    model = Model(vocabulary, lanes)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, np.iinfo(np.uint64).max, np.uint64)
    # A row holds one word of every lane: lanes move on much alike, so writes lie close together.
    words = np.zeros((steps + 2 * WINDOW) * lanes, np.uint16)
    places, given = np.arange(lanes), []  # of each lane's next word; of all words, in order

    def add(up: np.ndarray) -> None:
        np.add(low, up, out=low)
        over = np.flatnonzero(low < up)
        carried = places[over] - lanes
        while len(carried):
            words[carried] += np.uint16(1)
            carried = carried[words[carried] == 0] - lanes

    for now in columns:
        now = now.astype(np.uint32)
        model.predict()
        miss2 = model.id2 != now
        miss = miss2 & (model.id1 != now)
        at_event = model.state * 3 + miss2 + miss
        part = span >> MIX
        up = part * model.mix_start.take(at_event)
        np.multiply(part, model.mix.take(at_event), out=span)
        rest = np.flatnonzero(miss)
        if len(rest):
            part, ids_at = span.take(rest) >> ORDER0, now.take(rest).astype(np.intp)
            up[rest] += part * model.start.take(ids_at)
            span[rest] = part * model.freq.take(ids_at)
        add(up)
        which = np.flatnonzero(span < BOTTOM)
        while len(which):
            at = places.take(which)
            words[at] = low.take(which) >> U48
            given.append(at)
            places[which] = at + lanes
            which = _shift(low, span, which, U0)
        model.learn(now, at_event)
        if places.max() + 2 * WINDOW * lanes > len(words):
            words = np.concatenate([words, np.zeros_like(words)])
    # One word and zeros name a number within the span.
    add(np.full(lanes, BOTTOM - np.uint64(1)))
    words[places] = low >> U48
    given = np.concatenate([np.arange(-WINDOW * lanes, 0), *given])
    body = HEADER.pack(n, lanes, vocabulary, zlib.crc32(ids.astype("<u4")))
    body += words[given + WINDOW * lanes].astype("<u2").tobytes()
    return MAGIC + struct.pack("<I", zlib.crc32(body)) + body


def decode_block(block: bytes) -> np.ndarray:
    """The ids of a block. A block that is not whole raises ValueError."""
    if block[:4] != MAGIC or struct.unpack_from("<I", block, 4)[0] != zlib.crc32(block[8:]):
        raise ValueError("not a block, or a damaged one")
    n, lanes, vocabulary, check = HEADER.unpack_from(block, 8)
    steps = -(-n // lanes)
    words = np.frombuffer(block, "<u2", -1, 8 + HEADER.size)
    model = Model(vocabulary, lanes)
    span = np.full(lanes, np.iinfo(np.uint64).max, np.uint64)
    code = np.zeros(lanes, np.uint64)  # how far the number lies above the low of the encoder
    for row in words[: WINDOW * lanes].reshape(WINDOW, lanes):
        code = (code << U16) | row
    at = WINDOW * lanes
    out = np.zeros((steps, lanes), np.uint16)
    for step in range(steps):
        model.predict()
        part = span >> MIX
        value = code // part
        miss2, miss = value >= model.first.take(model.state), value >= model.second.take(model.state)
        at_event = model.state * 3 + miss2 + miss
        code -= part * model.mix_start.take(at_event)
        np.multiply(part, model.mix.take(at_event), out=span)
        now = np.where(miss2, model.id1, model.id2)
        rest = np.flatnonzero(miss)
        if len(rest):
            if model.by_value is None:
                model.by_value = np.repeat(np.arange(vocabulary, dtype=np.uint16), model.freq.astype(np.int64))
            part, codes = span.take(rest) >> ORDER0, code.take(rest)
            ids_at = model.by_value.take((codes // part).astype(np.intp), mode="clip").astype(np.intp)
            now[rest] = ids_at
            code[rest] = codes - part * model.start.take(ids_at)
            span[rest] = part * model.freq.take(ids_at)
        which = np.flatnonzero(span < BOTTOM)
        while len(which):
            to = at + len(which)
            which = _shift(code, span, which, words[at:to])
            at = to
        out[step] = now
        model.learn(now, at_event)
    ids = out.T.reshape(-1)[:n].astype(np.uint32)
    if zlib.crc32(ids.astype("<u4")) != check:
        raise ValueError("the ids of a block differ from what was written")
    return ids
