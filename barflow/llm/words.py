"""Words of a piece of text as arrays: places and 64-bit hashes, without a string per word.

Word bytes are told by a table over byte values, so words are maximal runs of such bytes, as the
patterns of the operators say (they name ASCII separators only; every byte of another letter is a
word byte). The hash of a word is the sum over its bytes of a random number for the byte (A-Z as
a-z) times a power of an odd number, modulo 2**64, taken as a difference of running sums; then mixed.
"""

from __future__ import annotations

from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U = np.uint64
#: Any odd number that is 5 modulo 8, and its inverse.
BASE = 0x9E3779B97F4A7C15
BACK = pow(BASE, -1, 1 << 64)

#: Word bytes: digits, letters and all beyond ASCII; or everything but white space.
ALPHANUMERIC = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
NOT_SPACE = np.array([b != 0x20 and not 0x09 <= b <= 0x0D for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed shuffle of 64-bit numbers (xor, shift, multiply)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


@cache
def _byte_values() -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=U) * U(BASE))
    values[ord("A"):ord("Z") + 1] = values[ord("a"):ord("z") + 1]
    return values


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... kept for the next piece."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), base, dtype=U)
        known[0] = 1
        _powers[base] = known = np.multiply.accumulate(known)
    return known[:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array without NULLs; offsets start at 0."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, ends, data = column.buffers()
    if ends is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(ends, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[offsets[0]:offsets[-1]], offsets - offsets[0]


class Words(NamedTuple):
    """``begin`` and ``end`` are byte positions; document i has the words ``first[i]:first[i + 1]``."""

    begin: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def runs(data: np.ndarray, offsets: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the longest runs of member bytes within each text."""
    inside = members[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    filled = offsets[:-1] < offsets[1:]
    at = offsets[:-1][filled]
    opens[at] = inside[at]
    at = offsets[1:][filled] - 1
    closes[at] = inside[at]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def _unspaced() -> np.ndarray:
    """For the first two bytes of a character: is it of a script without spaces (or its marks)?"""
    out = np.zeros((256, 256), bool)
    for first, last in (
        (0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF),  # Thai, Lao, Tibetan; Myanmar; Khmer
        (0x2E80, 0xA4CF), (0xF900, 0xFAFF), (0xFF00, 0xFFEF),  # Han, kana, Yi; compatibility; full width
        (0x1B000, 0x1B16F), (0x20000, 0x3FFFF),  # old kana; rare Han
    ):
        for code in range(first, last + 1, 64):
            a, b = chr(code).encode()[:2]
            out[a, b] = True
    return out


UNSPACED = _unspaced()


def _cut(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs, with every character of a script without spaces a run of its own."""
    at = np.flatnonzero(data[:-1] >= 0xE0)
    at = at[UNSPACED[data[at], data[at + 1]]]
    if not len(at):
        return begin, end
    after = at + np.where(data[at] >= 0xF0, 4, 3)
    begins = np.union1d(np.union1d(begin, at), after[~np.isin(after, end)])
    return begins, np.union1d(np.union1d(end, after), at[~np.isin(at, begin)])


def words(column: pa.Array, word_bytes: np.ndarray, cut: bool = False) -> Words:
    """``cut``: characters of scripts without spaces are words of their own."""
    data, offsets = text_bytes(column)
    begin, end = runs(data, offsets, word_bytes)
    if cut:
        begin, end = _cut(data, begin, end)
    sums = np.zeros(len(data) + 1, U)
    np.cumsum(_byte_values()[data] * _power(BASE, len(data)), out=sums[1:])
    hashes = mix((sums[end] - sums[begin]) * _power(BACK, len(data) + 1)[begin])
    return Words(begin, end, hashes, np.searchsorted(begin, offsets))


class Vocabulary:
    """Numbers of known word hashes, looked up by their highest bits in a table."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = np.unique(hashes)
        self.shift = U(64 - max(10, 8 + len(self.hashes).bit_length()))
        slot = (self.hashes >> self.shift).astype(np.int64)
        self.table = np.zeros(1 << (64 - int(self.shift)), np.int32)
        self.table[slot] = np.arange(len(self.hashes))
        self.shared = np.zeros(len(self.table), bool)  # slots of more than one word
        self.shared[slot[1:][slot[1:] == slot[:-1]]] = True

    def __len__(self) -> int:
        return len(self.hashes)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Place among the sorted hashes, -1 for others."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int32)
        slot = (hashes >> self.shift).astype(np.int64)
        at = self.table[slot]
        if self.shared.any():
            some = np.flatnonzero(self.shared[slot])
            at[some] = np.minimum(np.searchsorted(self.hashes, hashes[some]), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, np.int32(-1))


def word_hash(word: str) -> int:
    """The hash of one word, for tables of known words."""
    return int(words(pa.array([word]), np.ones(256, bool)).hash[0])
