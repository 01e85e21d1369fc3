"""Elias-Fano code of a non-decreasing sequence: near-minimal space, any element by select."""

from __future__ import annotations

import struct

import numpy as np

_HEADER = "<QQB"
#: Ones between two remembered positions of the upper bits.
HINT = 256


class EliasFano:
    """``n`` numbers below ``2**63``, non-decreasing, in about ``2 + log2(last / n)`` bits each.

    The lower bits of each number are stored as they are. The rest go into a bit string
    with a one at (upper part + index): the position of the i-th one, found by select,
    gives the upper part back. Every 256th position is remembered in 32 bits.
    """

    def __init__(self, count: int, last: int, low_bits: int, low: np.ndarray, high: np.ndarray, hints: np.ndarray):
        self.count, self.last, self.low_bits = count, last, low_bits
        self._low, self._high, self._hints = low, high, hints

    @classmethod
    def of(cls, numbers: np.ndarray) -> EliasFano:
        numbers = np.asarray(numbers, np.int64)
        count = len(numbers)
        last = int(numbers[-1]) if count else 0
        if count and (numbers[0] < 0 or (np.diff(numbers) < 0).any()):
            raise ValueError("numbers must not be negative or decrease")
        low_bits = max(0, (last // count).bit_length() - 1) if count else 0
        bits = (numbers[:, None] >> np.arange(low_bits)) & 1
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        ones = (numbers >> low_bits) + np.arange(count)
        high_bits = np.zeros(int(ones[-1]) + 1 if count else 0, np.uint8)
        high_bits[ones] = 1
        high = np.packbits(high_bits, bitorder="little")
        return cls(count, last, low_bits, low, high, ones[::HINT].astype("<u4"))

    def tobytes(self) -> bytes:
        parts = [struct.pack(_HEADER, self.count, self.last, self.low_bits), struct.pack("<QQ", len(self._low), len(self._high))]
        return b"".join([*parts, self._low.tobytes(), self._high.tobytes(), self._hints.tobytes()])

    @classmethod
    def frombuffer(cls, buffer, offset: int = 0) -> tuple[EliasFano, int]:
        """The sequence at ``offset`` and the offset behind it."""
        count, last, low_bits = struct.unpack_from(_HEADER, buffer, offset)
        offset += struct.calcsize(_HEADER)
        n_low, n_high = struct.unpack_from("<QQ", buffer, offset)
        offset += 16
        low = np.frombuffer(buffer, np.uint8, n_low, offset)
        high = np.frombuffer(buffer, np.uint8, n_high, offset + n_low)
        offset += n_low + n_high
        n_hints = -(-count // HINT)
        hints = np.frombuffer(buffer, "<u4", n_hints, offset)
        return cls(count, last, low_bits, low, high, hints), offset + 4 * n_hints

    def _low_part(self, index: int) -> int:
        start = index * self.low_bits
        window = self._low[start >> 3 : (start + self.low_bits + 7) >> 3].tobytes()
        return (int.from_bytes(window, "little") >> (start & 7)) & ((1 << self.low_bits) - 1)

    def select(self, index: int) -> int:
        """Number ``index``, reading a few bytes only."""
        if not 0 <= index < self.count:
            raise IndexError(index)
        position, missing = int(self._hints[index // HINT]), index % HINT
        byte = position >> 3
        # The ones of the first byte below the remembered position belong to earlier numbers.
        missing += (int(self._high[byte]) & ((1 << (position & 7)) - 1)).bit_count()
        while missing >= (ones := int(self._high[byte]).bit_count()):
            missing -= ones
            byte += 1
        value = int(self._high[byte])
        for _ in range(missing):
            value &= value - 1
        one = (byte << 3) + (value & -value).bit_length() - 1
        return ((one - index) << self.low_bits) | self._low_part(index)

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self._high, bitorder="little"))[: self.count]
        upper = (ones - np.arange(self.count)).astype(np.int64) << self.low_bits
        if not self.low_bits:
            return upper
        bits = np.unpackbits(self._low, bitorder="little")[: self.count * self.low_bits]
        weights = np.int64(1) << np.arange(self.low_bits, dtype=np.int64)
        return upper | bits.reshape(self.count, self.low_bits).astype(np.int64) @ weights
