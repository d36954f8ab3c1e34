"""Adaptive context-mixing coder for token ids, all streams of a block at a time.

Each block begins with an empty model, so it can be decoded alone. Three orders predict the next id: order 2 and order 1
each the id that last followed the last two ids, or the last one, in the block, and order 0 a frequency for every id met
in it. Their distributions are mixed to one: each combination of the two predictors' confidences has shares for order 2,
order 1 and order 0, which are learned from how often they were right. The id is coded with its part of that mixture by
rANS. An id that no order knows is coded as an escape, and stands by itself behind the words.

A block is cut to streams of neighbouring ids, which share the model; numpy works on one position of all streams at
once. The model learns after every position; frequencies and shares are counted anew each time the ids seen since have
reached a share of all before, so their cost is the logarithm of the block's length.

A payload is the number of escapes (4 bytes), the last state of each stream (8 each), words (4 each), escaped ids (2 each).
"""

from __future__ import annotations

import zlib
from math import isqrt

import numpy as np

#: Ids are below this number, which itself stands for an escape.
IDS = ESCAPE = 1 << 16
#: Order-0 frequencies of a block add up to 2^TABLE_BITS, the shares of the orders to 2^TRUST_BITS.
TABLE_BITS, TRUST_BITS = 18, 12
SCALE_BITS = TABLE_BITS + TRUST_BITS
#: Slots of order 2.
SLOTS = 1 << 18
#: How sure a prediction can be, in SURE_BITS bits; 0 where nothing has followed yet.
SURE_BITS = 3
MOST_SURE = (1 << SURE_BITS) - 1
#: Combinations of both confidences, and whether both predict the same id.
_TRUSTS = 2 << 2 * SURE_BITS
#: What an occurrence adds to a count that starts with 1; a block's counts then stay below 2^16.
STEP = 6
#: Most positions of a stream. A block of BLOCK_IDS then has 4,096 streams.
ROUNDS = 1024
BLOCK_IDS = 1 << 22
_LOW32 = (1 << 32) - 1
_LOWEST, _WORD, _SCALE = np.uint64(1 << 31), np.uint64(32), np.uint64(SCALE_BITS)
_FULL, _BELOW = np.uint64(1 << SCALE_BITS), np.uint64((1 << SCALE_BITS) - 1)
#: A state times this stays below 2^63 after an id is coded if it was below this times the id's part.
_MOST = np.uint64(63 - SCALE_BITS)


class _Counts:
    """Adaptive frequencies of symbols in many contexts, kept as running sums: a row has the total in front, then the
    sums before each symbol but the first."""

    def __init__(self, contexts: int, symbols: int, longest: int):
        self.kind = np.uint16 if STEP * longest + symbols < 1 << 16 else np.uint32
        row = np.arange(symbols, dtype=self.kind)
        self.steps = STEP * (row > row[:, None]).astype(self.kind)
        row[0], self.steps[:, 0] = symbols, STEP
        self.symbols = symbols
        self.sums = np.tile(row, (contexts, 1))
        self.bits = np.dtype(f"u{symbols // 8}") if symbols >= 8 else None

    def rows(self, contexts: np.ndarray) -> np.ndarray:
        return self.sums.take(contexts, axis=0)

    def bounds(self, rows: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum before the symbol of each row, and the symbol's own frequency."""
        starts, flat = np.arange(0, rows.size, self.symbols), rows.ravel()
        low = flat.take(starts + symbol) * (symbol > 0)
        # behind the last symbol stands the total, at the front
        return low, flat.take(starts + (symbol + 1) % self.symbols) - low

    def symbol(self, rows: np.ndarray, share: np.ndarray) -> np.ndarray:
        """The symbol in whose part of each row's sums `share` lies, which is below the total."""
        reached = rows <= share.astype(self.kind)[:, None]
        if self.bits is None:
            return reached.sum(axis=1)
        # one bit for each sum, and the number of bits set
        return np.bitwise_count(np.packbits(reached).view(self.bits)).astype(np.int64)

    def add(self, contexts: np.ndarray, rows: np.ndarray, symbol: np.ndarray) -> None:
        rows += self.steps.take(symbol, axis=0)
        self.sums[contexts] = rows


class _Model:
    """What a block has shown so far: followers in orders 1 and 2, frequencies of ids, and how often each was right."""

    def __init__(self) -> None:
        # what followed last, and in the lowest bits how sure that is
        self.held = [np.zeros(IDS, np.int64), np.zeros(SLOTS, np.int64)]
        # times that order 2, else order 1, else neither predicted the id
        self.right = np.tile(np.array([1, 1, 2]), (_TRUSTS, 1))
        self.counts = np.zeros(IDS, np.int64)
        self.seen = self.fresh = 0
        self.ids: list[np.ndarray] = []
        self.outcomes: list[np.ndarray] = []
        self.size = np.zeros(IDS + 1, np.int64)
        self.size[ESCAPE] = 1 << TABLE_BITS
        self._tables()

    def _tables(self) -> None:
        # first place of each id in the table and, in the low 32 bits, its places
        self.span = (np.cumsum(self.size) - self.size) << 32 | self.size
        self.id_at = np.repeat(np.arange(IDS + 1, dtype=np.int32), self.size)
        shares = 1 + self.right[:, :2] * ((1 << TRUST_BITS) - 3) // self.right.sum(axis=1, keepdims=True)
        self.share_two, self.share_one = np.ascontiguousarray(shares.T) << TABLE_BITS
        self.share_table = (1 << TRUST_BITS) - shares.sum(axis=1)

    def look(self, last: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, ...]:
        """What orders 1 and 2 predict behind the last id and the one before, their shares of the whole, and how
        much of it each place in the table has."""
        second = (last * 0x9E3779B1 + before * 0x85EBCA6B) >> 13 & SLOTS - 1
        self.at = last, second
        one, two = self.found = self.held[0].take(last), self.held[1].take(second)
        self.sures = one & MOST_SURE, two & MOST_SURE
        one, two = one >> SURE_BITS, two >> SURE_BITS
        self.row = row = (self.sures[0] << SURE_BITS + 1) + (self.sures[1] << 1) + (one == two)
        return one, two, self.share_one.take(row), self.share_two.take(row), self.share_table.take(row)

    def learn(self, ids: np.ndarray, is_one: np.ndarray, is_two: np.ndarray) -> None:
        new = ids << SURE_BITS | 1
        for held, at, found, sure, right in zip(self.held, self.at, self.found, self.sures, (is_one, is_two)):
            # a wrong guess is given up once little speaks for it any more
            wrong = np.where(sure > 2, found - 2, new)
            held[at] = np.where(right, found + (sure < MOST_SURE), wrong)
        self.outcomes.append(np.where(is_two, self.row, np.where(is_one, self.row + _TRUSTS, self.row + 2 * _TRUSTS)))
        self.ids.append(ids)
        self.fresh += len(ids)
        if 2 * self.fresh >= self.seen:
            self._settle()

    def _settle(self) -> None:
        """Count what was seen since the last time, and share out the table anew."""
        outcomes = np.bincount(np.concatenate(self.outcomes), minlength=3 * _TRUSTS)
        self.right += outcomes.reshape(3, _TRUSTS).T
        counts = np.bincount(np.concatenate(self.ids), minlength=IDS)
        unknown = np.count_nonzero(counts[self.counts == 0])
        self.counts += counts
        self.seen += self.fresh
        # an escape is as likely as new ids were of late, and at most a quarter of the table
        known = self.counts > 0
        places = (1 << TABLE_BITS) - 1 - (unknown << TABLE_BITS - 2) // self.fresh
        self.size[:IDS] = self.counts * (places - np.count_nonzero(known)) // self.seen + known
        self.size[ESCAPE] = (1 << TABLE_BITS) - self.size[:IDS].sum()
        self.ids, self.outcomes, self.fresh = [], [], 0
        self._tables()


def _shape(n: int) -> tuple[int, int, int]:
    """Positions of a stream of a block of n ids, streams, and positions of the last one, which may be shorter."""
    rounds = min(ROUNDS, isqrt(4 * n) + 1)
    streams = -(-n // rounds)
    return rounds, streams, n - (streams - 1) * rounds


def _turned(grid: np.ndarray) -> np.ndarray:
    out = np.empty(grid.shape[::-1], grid.dtype)
    for at in range(0, len(grid), 64):
        out[:, at : at + 64] = grid[at : at + 64].T
    return out


def _encode_block(ids: np.ndarray) -> bytes:
    if not len(ids):
        return b""
    rounds, streams, last_rounds = _shape(len(ids))
    grid = np.zeros((streams, rounds), np.int32)
    grid.ravel()[: len(ids)] = ids
    model, parts, escaped = _Model(), [], []
    last = before = np.zeros(streams, np.int64)
    for position, row in enumerate(_turned(grid)):
        now = row[: streams - (position >= last_rounds)].astype(np.int64)
        one, two, share_one, share_two, share_table = model.look(last[: len(now)], before[: len(now)])
        span = share_table * model.span.take(now)
        is_one, is_two = one == now, two == now
        # an id's part of the mixture, behind those of all smaller ids
        size = (span & _LOW32) + share_one * is_one + share_two * is_two
        start = (span >> 32) + share_one * (one < now) + share_two * (two < now)
        unknown = np.flatnonzero(size == 0)
        if len(unknown):
            escaped.append(now[unknown])
            span = share_table[unknown] * model.span[ESCAPE]
            size[unknown] = span & _LOW32
            start[unknown] = (span >> 32) + share_one[unknown] + share_two[unknown]
        parts.append((start.astype(np.uint32), size.astype(np.uint32)))
        model.learn(now, is_one, is_two)
        last, before = now, last
    # rANS gives back last what was coded first, so it goes from the end to the beginning
    states, words = np.full(streams, _LOWEST), []
    for start, size in reversed(parts):
        size, state = size.astype(np.uint64), states[: len(size)]
        large = np.flatnonzero(state >= size << _MOST)
        word = state[large]
        words.append(word.astype(np.uint32))
        state[large] = word >> _WORD
        # state // size * 2^SCALE_BITS + state % size + start
        state += state // size * (_FULL - size) + start
    words.reverse()
    arrays = [np.array([sum(map(len, escaped))]), states, np.concatenate(words), np.concatenate([*escaped, ids[:0]])]
    return b"".join(a.astype(kind).tobytes() for a, kind in zip(arrays, ("<u4", "<u8", "<u4", "<u2")))


def _decode_block(payload: bytes, n: int) -> np.ndarray:
    if not n:
        return np.empty(0, np.int32)
    rounds, streams, last_rounds = _shape(n)
    escapes = int(np.frombuffer(payload, "<u4", 1)[0])
    ends = 4 + 8 * streams, len(payload) - 2 * escapes
    states = np.frombuffer(payload[4 : ends[0]], "<u8").astype(np.uint64)
    words = np.frombuffer(payload[ends[0] : ends[1]], "<u4").astype(np.uint64)
    escaped = np.frombuffer(payload[ends[1] :], "<u2").astype(np.int64)
    next_word = next_escape = 0
    grid, model = np.zeros((rounds, streams), np.int32), _Model()
    last = before = np.zeros(streams, np.int64)
    for position in range(rounds):
        m = streams - (position >= last_rounds)
        one, two, share_one, share_two, share_table = model.look(last[:m], before[:m])
        state = states[:m]
        place = (state & _BELOW).view(np.int64)
        # where in the mixture the predicted ids begin and end
        span = share_table * model.span.take(one)
        one_start = (span >> 32) + share_two * (two < one)
        one_end = one_start + (span & _LOW32) + share_one
        span = share_table * model.span.take(two)
        two_start = (span >> 32) + share_one * (one < two)
        two_end = two_start + (span & _LOW32) + share_two
        rest = place - share_one * (place >= one_end) - share_two * (place >= two_end)
        # a quotient of such small numbers is never rounded up to the next whole one
        at = (rest / share_table).astype(np.int64)
        now = model.id_at.take(at, mode="clip").astype(np.int64)
        one_end += share_two * (one == two)
        now = np.where((place >= one_start) & (place < one_end), one, now)
        now = np.where((place >= two_start) & (place < two_end), two, now)
        span = share_table * model.span.take(now)
        is_one, is_two = one == now, two == now
        size = (span & _LOW32) + share_one * is_one + share_two * is_two
        start = (span >> 32) + share_one * (one < now) + share_two * (two < now)
        state = (state >> _SCALE) * size.view(np.uint64) + (place - start).view(np.uint64)
        small = np.flatnonzero(state < _LOWEST)
        state[small] = state[small] << _WORD | words[next_word : next_word + len(small)]
        next_word += len(small)
        states[:m] = state
        unknown = np.flatnonzero(now == ESCAPE)
        if len(unknown):
            now[unknown] = escaped[next_escape : next_escape + len(unknown)]
            next_escape += len(unknown)
        model.learn(now, is_one, is_two)
        grid[position, :m] = now
        last, before = now, last
    return _turned(grid).ravel()[:n]


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """A payload for each block of ids below 2^16. Others would come back as other ids, so they are an error."""
    for block in blocks:
        if len(block) and (np.min(block) < 0 or np.max(block) >= IDS):
            raise ValueError(f"ids must be from 0 to {IDS - 1}")
    return [_encode_block(block) for block in blocks]


def decode_blocks(payloads: list[bytes], lengths: list[int]) -> list[np.ndarray]:
    """The ids of each block again."""
    return [_decode_block(payload, n) for payload, n in zip(payloads, lengths)]


# checksums of parts

_POLYNOMIAL = 0xEDB88320


def _times(matrix: list[int], vector: int) -> int:
    total, at = 0, 0
    while vector:
        if vector & 1:
            total ^= matrix[at]
        vector >>= 1
        at += 1
    return total


def _zero_steps() -> list[list[int]]:
    """For each k the effect on a CRC-32 of 2^k zero bytes."""
    step = [_POLYNOMIAL, *(1 << i for i in range(31))]  # of one zero bit
    for _ in range(3):
        step = [_times(step, row) for row in step]
    out = [step]
    for _ in range(47):
        step = [_times(step, row) for row in step]
        out.append(step)
    return out


_ZEROS = _zero_steps()


def crc32_joined(first: int, second: int, second_bytes: int) -> int:
    """The CRC-32 of two strings of bytes, one behind the other, from their own and the length of the second."""
    at = 0
    while second_bytes:
        if second_bytes & 1:
            first = _times(_ZEROS[at], first)
        second_bytes >>= 1
        at += 1
    return first ^ second


def crc32_ids(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
