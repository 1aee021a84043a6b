"""Whole-column word handling for Arrow tasks: UTF-8 bytes, word bounds and 64-bit word hashes in numpy.

A column of texts is one byte array with an offset for each text.  Words are
maximal runs of bytes that a 256-entry table marks; A-Z count as a-z.  A word's
hash is a polynomial over its bytes, read off one prefix sum, so the cost is
per byte and no Python object is made for a word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

U64 = np.uint64
#: Bytes of text that a task handles at once; a longer text is handled alone, whole.
SLICE_BYTES = 2 << 20

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, size=(3, 256), dtype=U64) * U64(2) + U64(1)
_BASE = (U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0xD6E8FEB86659FD93))
_GRAM = _rng.integers(1, 1 << 63, size=64, dtype=U64) * U64(2) + U64(1)
_upper = np.arange(ord("A"), ord("Z") + 1)
_BYTE[:2, _upper] = _BYTE[:2, _upper + 32]

_ALL = np.arange(256)
#: `[^\x20\x09-\x0D]+`
SPACED = ~((_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D)))
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z
ALNUM = (_ALL >= 0x80) | ((_ALL >= 0x30) & (_ALL <= 0x39)) | ((_ALL >= 0x41) & (_ALL <= 0x5A)) | ((_ALL >= 0x61) & (_ALL <= 0x7A))

_STEP = 16  # powers up to 2**_STEP are kept, and those of that power; any other is a product of two
_powers: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}


def _run(base: np.uint64, n: int) -> np.ndarray:
    run = np.full(n, base, U64)
    run[0] = 1
    return np.cumprod(run, dtype=U64)


def _power(k: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Powers of base ``k`` modulo 2**64 (small steps, large steps), enough for ``n``, and those of its inverse."""
    have = _powers.get(k)
    if have is None or len(have[1]) << _STEP < n:
        large = (n >> _STEP) + 2
        out = []
        for base in (_BASE[k], U64(pow(int(_BASE[k]), -1, 1 << 64))):
            out += [_run(base, 1 << _STEP), _run(U64(pow(int(base), 1 << _STEP, 1 << 64)), large)]
        have = _powers[k] = (out[0], out[1], out[2], out[3])
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its texts; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def release() -> None:
    """Give back memory that earlier work of this worker has freed but still holds."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # another C library
        pass


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text; each text stays whole."""
    release()  # what earlier tasks of this worker held
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to
    release()  # an idle worker goes on living


class Words:
    """Words of a column of texts: byte bounds ``start`` and ``end``, and for each text its run ``at[i]:at[i + 1]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray = SPACED) -> None:
        self.data, self.offsets = data, offsets
        inside = table[data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True  # a word doesn't run on into the next text
        before = np.empty(len(data), bool)
        before[:1] = False
        before[1:] = inside[:-1]
        before &= ~first[:-1]
        self.start = np.flatnonzero(inside & ~before)
        after = np.empty(len(data), bool)
        after[-1:] = False
        after[:-1] = inside[1:]
        after &= ~first[1:]
        self.end = np.flatnonzero(inside & ~after) + 1
        self.at = np.searchsorted(self.start, offsets)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.at)

    @property
    def text(self) -> np.ndarray:
        """Which text each word is of."""
        return np.repeat(np.arange(len(self.at) - 1), self.counts)

    def hashes(self, k: int = 0) -> np.ndarray:
        """A 64-bit hash of each word: 0 and 1 are independent ones of the lower-cased word (A-Z), 2 of the word as it is."""
        return run_hashes(self.data, self.start, self.end, k)


def prefix_sums(data: np.ndarray, k: int = 0) -> np.ndarray:
    """Prefix sums of a polynomial over the bytes, for hashes of any runs."""
    small, large, _, _ = _power(k, len(data) + 1)
    total = np.empty(len(data) + 1, U64)
    total[0] = 0
    values = total[1:]
    for block in range(-(-len(data) >> _STEP)):
        part = slice(block << _STEP, (block + 1) << _STEP)
        raw = _BYTE[k][data[part]]
        raw *= small[: len(raw)]
        raw *= large[block]
        values[part] = raw
    np.cumsum(values, out=values)
    return total


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, k: int = 0, total: np.ndarray | None = None) -> np.ndarray:
    """The hashes of runs of bytes ``start[i]:end[i]``, equal for equal runs anywhere."""
    total = prefix_sums(data, k) if total is None else total
    _, _, small, large = _power(k, len(data) + 1)
    return mix((total[end] - total[start]) * small[start & (1 << _STEP) - 1] * large[start >> _STEP] + (end - start).astype(U64))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` consecutive entries of ``h`` (fewer entries: none)."""
    if len(h) < n:
        return np.empty(0, U64)
    size = len(h) - n + 1
    out = np.zeros(size, U64)
    for j in range(n):
        out += h[j : j + size] * _GRAM[j]
    return mix(out + U64(n))


def expand(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The positions of all runs ``start[i] : start[i] + count[i]``, one after the other."""
    total = int(count.sum())
    if not total:
        return np.empty(0, np.int64)
    shift = np.repeat(start - (np.cumsum(count) - count), count)
    return np.arange(total) + shift


def id_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id gives null."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def is_fold(doc_id: Column, folds: int, remainder: int) -> Column:
    """True in the fold; rows without an id are in no fold."""
    return F.coalesce(id_fold(doc_id, folds) == remainder, F.lit(False))
