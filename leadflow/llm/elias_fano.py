"""Elias-Fano coding of non-decreasing integers: low bits packed, high bits in unary with sampled select."""

from __future__ import annotations

import struct

import numpy as np

#: Every so many ones of the high bits, the place of one is kept.
EVERY = 256
_HEAD = struct.Struct("<4sQqBQQ")


class EliasFano:
    """About 2 + log2(range / n) bits a value; any value, or a run of them, is read without decoding the rest."""

    def __init__(self, n: int, base: int, width: int, high_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.base, self.width, self.high_bits = n, base, width, high_bits
        self._raw = low, high, samples
        self.low = np.frombuffer(low, np.uint8)
        self.high = np.frombuffer(high, np.uint8)
        self.samples = np.frombuffer(samples, "<u8")

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        if not n:
            return cls(0, 0, 0, 0, b"", b"", b"")
        base = int(values[0])
        v = (values - base).astype(np.uint64)
        width = max(0, (int(v[-1]) // n).bit_length() - 1)
        low = bytearray()
        bits = np.arange(width, dtype=np.uint64)
        for a in range(0, n, 1 << 16):  # 8 divides the block, so each ends on a whole byte
            part = (v[a : a + (1 << 16), None] >> bits) & np.uint64(1)
            low += np.packbits(part.astype(np.uint8).ravel(), bitorder="little").tobytes()
        at = (v >> np.uint64(width)).astype(np.int64) + np.arange(n)
        size = int(at[-1]) + 1
        high = np.zeros(size, np.uint8)
        high[at] = 1
        return cls(n, base, width, size, bytes(low), np.packbits(high, bitorder="little").tobytes(), at[::EVERY].astype("<u8").tobytes())

    def to_bytes(self) -> bytes:
        return _HEAD.pack(b"EFv1", self.n, self.base, self.width, self.high_bits, len(self._raw[0])) + b"".join(self._raw)

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        mark, n, base, width, high_bits, low = _HEAD.unpack_from(data)
        if mark != b"EFv1":
            raise ValueError("not an Elias-Fano block")
        a = _HEAD.size
        b = a + low
        c = b + (high_bits + 7) // 8
        return cls(n, base, width, high_bits, data[a:b], data[b:c], data[c : c + 8 * -(-n // EVERY)])

    def __len__(self) -> int:
        return self.n

    def read(self, first: int, last: int) -> np.ndarray:
        """Values first..last-1: select of the first by its sample, then only the bits between."""
        if not 0 <= first <= last <= self.n:
            raise IndexError((first, last))
        if first == last:
            return np.zeros(0, np.int64)
        k = first // EVERY
        begin = int(self.samples[k])
        stop = int(self.samples[(last - 1) // EVERY + 1]) if (last - 1) // EVERY + 1 < len(self.samples) else self.high_bits
        bits = np.unpackbits(self.high[begin // 8 : (stop + 7) // 8], bitorder="little")
        ones = np.flatnonzero(bits[begin % 8 :])[first - k * EVERY : last - k * EVERY] + begin
        high = (ones - np.arange(first, last)).astype(np.uint64)
        value = high << np.uint64(self.width)
        if self.width:
            a, b = first * self.width, last * self.width
            bits = np.unpackbits(self.low[a // 8 : (b + 7) // 8], bitorder="little")[a % 8 : a % 8 + b - a]
            value += (bits.reshape(-1, self.width).astype(np.uint64) << np.arange(self.width, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return value.astype(np.int64) + self.base

    def __getitem__(self, i: int) -> int:
        return int(self.read(i, i + 1)[0])
