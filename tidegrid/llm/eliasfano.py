"""Elias-Fano coding of non-decreasing numbers, with select."""

from __future__ import annotations

import struct

import numpy as np

HEAD = struct.Struct("<4sQqQBI")  # mark, count, base, range, low bits, words of high bits
MARK = b"EF01"
STEP = 256  # every so many ones, their place is kept, counted in 32 bits from the last kept block place
BLOCK = 1 << 16
BITS = np.array([bin(b).count("1") for b in range(256)], np.uint8)


class EliasFano:
    """``count`` numbers from ``base``: the low bits side by side, the high bits in unary, some two bits a number more."""

    def __init__(self, count: int, base: int, span: int, low: int, lows: np.ndarray, highs: np.ndarray):
        self.count, self.base, self.span, self.low, self.lows, self.highs = count, base, span, low, lows, highs
        ones = np.cumsum(BITS[highs], dtype=np.int64)
        # select: the byte of every STEP-th one, relative to the byte where its block of ones begins
        wanted = np.arange(0, count, STEP)
        place = np.searchsorted(ones, wanted, side="right")
        self.block_place = place[:: BLOCK // STEP]
        self.step_place = (place - np.repeat(self.block_place, BLOCK // STEP)[: len(place)]).astype(np.uint32)
        self.step_rank = (ones[place] - BITS[highs[place]] if count else place).astype(np.int64) - wanted  # ones before that byte, less the rank
        self.step_rank = self.step_rank.astype(np.int8)

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        if len(values) and (np.diff(values) < 0).any():
            raise ValueError("numbers must not decrease")
        base = int(values[0]) if len(values) else 0
        rest = (values - base).astype(np.uint64)
        span = int(rest[-1]) if len(values) else 0
        low = max(0, (span // max(1, len(values))).bit_length() - 1)
        bits = (rest[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
        lows = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        high = (rest >> np.uint64(low)).astype(np.int64)
        marks = np.zeros((int(high[-1]) if len(high) else 0) + len(high) + 1, np.uint8)
        marks[high + np.arange(len(high))] = 1
        return cls(len(values), base, span, low, lows, np.packbits(marks, bitorder="little"))

    def to_bytes(self) -> bytes:
        return HEAD.pack(MARK, self.count, self.base, self.span, self.low, len(self.highs)) + self.lows.tobytes() + self.highs.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> tuple[EliasFano, int]:
        """The numbers coded at ``at``, and where their code ends."""
        mark, count, base, span, low, n_high = HEAD.unpack_from(data, at)
        if mark != MARK:
            raise ValueError("no Elias-Fano block here")
        at += HEAD.size
        n_low = (count * low + 7) // 8
        lows = np.frombuffer(data, np.uint8, n_low, at)
        highs = np.frombuffer(data, np.uint8, n_high, at + n_low)
        return cls(count, base, span, low, lows, highs), at + n_low + n_high

    def _low(self, k: np.ndarray) -> np.ndarray:
        bit = k[:, None] * self.low + np.arange(self.low)
        one = (self.lows[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1
        return (one.astype(np.int64) << np.arange(self.low)).sum(axis=1) if self.low else np.zeros(len(k), np.int64)

    def select(self, k: int) -> int:
        """The k-th number, from the kept places and a scan of the few bytes behind one."""
        if not 0 <= k < self.count:
            raise IndexError(k)
        step = k // STEP
        byte = int(self.block_place[step // (BLOCK // STEP)]) + int(self.step_place[step])
        rank = step * STEP + int(self.step_rank[step])
        while rank + int(BITS[self.highs[byte]]) <= k:
            rank += int(BITS[self.highs[byte]])
            byte += 1
        ones = np.flatnonzero(np.unpackbits(self.highs[byte : byte + 1], bitorder="little"))
        high = byte * 8 + int(ones[k - rank]) - k
        return self.base + (high << self.low) + int(self._low(np.array([k]))[0])

    def decode(self) -> np.ndarray:
        """All numbers."""
        k = np.arange(self.count)
        ones = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))
        return self.base + ((ones - k) << self.low) + self._low(k)
