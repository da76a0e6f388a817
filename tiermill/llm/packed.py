"""Arrays of numbers in few bytes, for what tasks send each other."""

from __future__ import annotations

import numpy as np
import zstandard


def packed(numbers: np.ndarray) -> bytes:
    """Compressed by byte planes, in which similar numbers agree."""
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T)
    return zstandard.compress(planes.tobytes(), 1)


def unpacked(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def narrow(numbers: np.ndarray) -> bytes:
    """Unsigned numbers in as few bytes each as the largest needs."""
    size = np.min_scalar_type(int(numbers.max(initial=0))).itemsize
    return bytes([size]) + packed(numbers.astype(f"<u{size}"))


def widened(data: bytes) -> np.ndarray:
    return unpacked(data[1:], f"<u{data[0]}").astype(np.int64)


def ascending(numbers: np.ndarray) -> bytes:
    """Rising 64-bit numbers as their gaps, in as few bytes as the widest needs."""
    gaps = np.diff(numbers, prepend=np.uint64(0))
    size = np.min_scalar_type(int(gaps.max(initial=0))).itemsize
    return bytes([size]) + packed(gaps.astype(f"<u{size}"))


def ascended(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data[1:], f"<u{data[0]}"), dtype=np.uint64)


def cut(sorted_numbers: np.ndarray, bits: int, slice_bits: int) -> np.ndarray:
    """Where the 2**slice_bits slices of numbers below 2**bits begin and end."""
    borders = np.arange(1, 1 << slice_bits, dtype=np.uint64) << np.uint64(bits - slice_bits)
    return np.concatenate([[0], np.searchsorted(sorted_numbers, borders), [len(sorted_numbers)]])


def distinct(numbers: np.ndarray) -> np.ndarray:
    """The different numbers, rising. By sorting: without further results ``np.unique`` hashes, many times slower for millions."""
    ordered = np.sort(numbers)
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return ordered[new]
