"""Elias-Fano sequences in numpy, and files of arrays that are memory-mapped.

A rising sequence of n integers below u is split: the low bits of each lie
packed side by side, the high bits are a bit vector in which value i sets bit
(value >> low) + i.  A directory of the zeros before each 64-bit word finds
where a high part begins and ends, so a successor search is two selects and a
binary search among the low bits between.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow.fs

U64 = np.uint64
ONE = U64(1)


def filesystem(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}")


def encode(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """The arrays of a non-decreasing uint64 sequence of values below ``universe``."""
    n = len(values)
    low = max(0, min(56, (universe // max(n, 1)).bit_length() - 1))
    lows = values & ((ONE << U64(low)) - ONE)
    packed = np.zeros(n * low // 64 + 2, U64)
    at = np.arange(n, dtype=U64) * U64(low)
    word, shift = (at >> U64(6)).astype(np.int64), at & U64(63)
    np.add.at(packed, word, lows << shift)
    np.add.at(packed, word + 1, (lows >> ONE) >> (U64(63) - shift))
    spot = (values >> U64(low)) + np.arange(n, dtype=U64)
    bits = np.zeros(((universe >> low) + n) // 64 + 2, U64)
    np.add.at(bits, (spot >> U64(6)).astype(np.int64), ONE << (spot & U64(63)))
    zeros = 64 - np.bitwise_count(bits).astype(np.int64)
    return {"low": packed, "high": bits, "zeros": np.cumsum(zeros) - zeros, "shape": np.array([n, low], np.int64)}


class EliasFano:
    def __init__(self, arrays: dict[str, np.ndarray], name: str = "") -> None:
        self.low, self.high, self.zeros = arrays[name + "low"], arrays[name + "high"], arrays[name + "zeros"]
        self.n, self.bits = (int(x) for x in arrays[name + "shape"])

    def _low(self, i: np.ndarray) -> np.ndarray:
        at = i.astype(U64) * U64(self.bits)
        word, shift = (at >> U64(6)).astype(np.int64), at & U64(63)
        both = (self.low[word] >> shift) | ((self.low[word + 1] << ONE) << (U64(63) - shift))
        return both & ((ONE << U64(self.bits)) - ONE)

    @staticmethod
    def _select(word: np.ndarray, r: np.ndarray) -> np.ndarray:
        """The place of the r-th set bit (from 0) in each word."""
        place = np.zeros(len(word), U64)
        for width in (32, 16, 8, 4, 2, 1):
            count = np.bitwise_count(word & U64((1 << width) - 1)).astype(np.int64)
            go = r >= count
            r = r - count * go
            move = go.astype(U64) * U64(width)
            word, place = word >> move, place + move
        return place.astype(np.int64)

    def _after_zero(self, j: np.ndarray) -> np.ndarray:
        """The bit behind the j-th zero (from 0); for -1 the first bit."""
        word = np.maximum(np.searchsorted(self.zeros, j, "right") - 1, 0)
        place = word * 64 + self._select(~self.high[word], j - self.zeros[word]) + 1
        return np.where(j < 0, 0, place)

    def find(self, x: np.ndarray) -> np.ndarray:
        """The first index with each value, or -1; a successor search from the value's high part."""
        out = np.full(len(x), -1, np.int64)
        if not self.n:
            return out
        high = (x >> U64(self.bits)).astype(np.int64)
        want = x & ((ONE << U64(self.bits)) - ONE)
        begin = self._after_zero(high - 1) - high  # values with a smaller high part
        end = self._after_zero(high) - 1 - high  # and those with this one too
        on = np.flatnonzero(begin < end)
        a, b, goal = begin[on], end[on], want[on]
        while len(on):  # halve the run of one high part: a busy context has many words in it
            middle = (a + b) >> 1
            less = self._low(middle) < goal
            a, b = np.where(less, middle + 1, a), np.where(less, b, middle)
            done = a >= b
            if done.any():
                first = np.flatnonzero(done & (a < end[on]))
                first = first[self._low(a[first]) == goal[first]]
                out[on[first]] = a[first]
                on, a, b, goal = on[~done], a[~done], b[~done], goal[~done]
        return out

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at some indexes."""
        ones = np.arange(len(self.zeros)) * 64 - self.zeros  # before each word
        word = np.searchsorted(ones, i, "right") - 1
        place = word * 64 + self._select(self.high[word], i - ones[word])
        return (place - i).astype(U64) << U64(self.bits) | self._low(i)


def write_arrays(path: str, arrays: dict[str, np.ndarray]) -> None:
    """One file: the length of a JSON header, the header, and the arrays at multiples of 8 bytes."""
    shapes, at = {}, 0
    for name, a in arrays.items():
        shapes[name] = (a.dtype.str, len(a), at)
        at += -(-a.nbytes // 8) * 8
    head = json.dumps(shapes).encode()
    head += b" " * (-len(head) % 8)
    where, base = filesystem(path)
    with where.open_output_stream(base) as out:
        out.write(np.array([len(head)], "<u8").tobytes() + head)
        for a in arrays.values():
            out.write(a.tobytes() + b"\0" * (-a.nbytes % 8))


@lru_cache(maxsize=4096)
def read_arrays(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file: memory-mapped where the shared folder is mounted, else read."""
    where, base = filesystem(path)
    if isinstance(where, pyarrow.fs.LocalFileSystem):
        raw = np.memmap(base, np.uint8, "r")
    else:
        with where.open_input_file(base) as source:
            raw = np.frombuffer(source.read(), np.uint8)
    size = int(raw[:8].view("<u8")[0])
    shapes = json.loads(raw[8 : 8 + size].tobytes())
    return {name: raw[8 + size + at : 8 + size + at + n * np.dtype(kind).itemsize].view(kind) for name, (kind, n, at) in shapes.items()}
