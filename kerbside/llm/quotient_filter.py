"""Counting quotient filters of word-id n-grams, as sorted NumPy arrays.

An n-gram of up to four word ids, each ``width`` bits wide, is two numbers of ``2 * width`` bits. An invertible
permutation spreads them evenly; the upper bits of the first are the quotient, all other bits the remainder. A
filter stores how many entries each quotient has, and per entry its remainder and count, in order. Quotient and
remainder together are the n-gram, so nothing is lost and a filter of n entries takes the bits of n remainders.
"""

from __future__ import annotations

import numpy as np

#: Words in an n-gram, at most; absent words are id 0.
MOST_WORDS = 4
_ROUND_KEYS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def _spread(x: np.ndarray, key: int, bits: int) -> np.ndarray:
    x = (x + np.uint64(key)) * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return (x >> np.uint64(64 - bits)) if bits < 64 else x ^ (x >> np.uint64(29))


def permute(high: np.ndarray, low: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A Feistel network over two halves of ``2 * width`` bits."""
    for key in _ROUND_KEYS:
        high, low = low, high ^ _spread(low, key, 2 * width)
    return high, low


def restore(high: np.ndarray, low: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of ``permute``."""
    for key in reversed(_ROUND_KEYS):
        high, low = low ^ _spread(high, key, 2 * width), high
    return high, low


def pack(words: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to four arrays of word ids as two numbers."""
    ids = [w.astype(np.uint64) for w in words]
    ids += [np.zeros(len(ids[0]), np.uint64)] * (MOST_WORDS - len(ids))
    shift = np.uint64(width)
    return (ids[0] << shift) | ids[1], (ids[2] << shift) | ids[3]


def unpack(high: np.ndarray, low: np.ndarray, width: int) -> list[np.ndarray]:
    shift, mask = np.uint64(width), _mask(width)
    return [high >> shift, high & mask, low >> shift, low & mask]


def counted(high: np.ndarray, low: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct entries with the sums of their counts, or how often they stand."""
    if not len(high):
        return high, low, np.zeros(0, np.int64)
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    first = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])]))
    totals = np.diff(np.append(first, len(high))) if counts is None else np.add.reduceat(counts[order], first)
    return high[first], low[first], totals


def _narrow(numbers: np.ndarray, size: int) -> bytes:
    """The low ``size`` bytes of each number."""
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def _widen(data: bytes, size: int, n: int) -> np.ndarray:
    wide = np.zeros((n, 8), np.uint8)
    if size:
        wide[:, :size] = np.frombuffer(data, np.uint8).reshape(n, size)
    return wide.view("<u8").ravel().astype(np.uint64)


def _small(numbers: np.ndarray) -> bytes:
    """Counters: a byte each; larger ones follow with their places."""
    large = np.flatnonzero(numbers > 254)
    short = np.minimum(numbers, 255).astype(np.uint8)
    return short.tobytes() + large.astype("<u4").tobytes() + numbers[large].astype("<i8").tobytes()


def _read_small(data: bytes, n: int) -> np.ndarray:
    numbers = np.frombuffer(data, np.uint8, n).astype(np.int64)
    large = (len(data) - n) // 12
    if large:
        places = np.frombuffer(data, "<u4", large, n)
        numbers[places] = np.frombuffer(data, "<i8", large, n + 4 * large)
    return numbers


def _sizes(width: int, part_bits: int, quotient_bits: int) -> tuple[int, int, int]:
    """Bits of the first number below the quotient, and bytes of the remainder's two pieces."""
    rest = 2 * width - part_bits - quotient_bits
    return rest, -(-rest // 8), -(-2 * width // 8)


def part_bits(blocks: int, width: int) -> int:
    """Bits of the part number, for at least ``blocks`` parts if the first number has as many bits."""
    return min((blocks - 1).bit_length(), 2 * width)


def parts_of(high: np.ndarray, width: int, bits: int) -> np.ndarray:
    return (high >> np.uint64(2 * width - bits)).astype(np.int64) if bits else np.zeros(len(high), np.int64)


def write(high: np.ndarray, low: np.ndarray, counts: np.ndarray, width: int, bits: int) -> tuple[int, int, bytes, bytes, bytes]:
    """(entries, quotient bits, entries by quotient, remainders, counts) of sorted distinct entries of one part."""
    n = len(high)
    quotient_bits = max(0, min((n - 1).bit_length(), 2 * width - bits))
    rest, upper, lower = _sizes(width, bits, quotient_bits)
    quotients = (high >> np.uint64(rest)) & _mask(quotient_bits)
    runs = np.bincount(quotients.astype(np.int64), minlength=1 << quotient_bits)
    return n, quotient_bits, _small(runs), _narrow(high & _mask(rest), upper) + _narrow(low, lower), _small(counts)


def read(
    part: int, n: int, quotient_bits: int, runs: bytes, remainders: bytes, counts: bytes, width: int, bits: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted entries of a filter and their counts."""
    rest, upper, lower = _sizes(width, bits, quotient_bits)
    quotients = np.repeat(np.arange(1 << quotient_bits, dtype=np.uint64), _read_small(runs, 1 << quotient_bits))
    high = (quotients | np.uint64(part << quotient_bits)) << np.uint64(rest)
    high |= _widen(remainders[:n * upper], upper, n)
    return high, _widen(remainders[n * upper:], lower, n), _read_small(counts, n)
