"""Token counts by a map-side two-tier lookup: lengths of pre-tokens instead of an encoding of texts.

A text's count is the sum of the counts of its pre-tokens.  Tier one is a
compact hash table of frequent pre-tokens, broadcast with a fixed number of
entries; what it misses is looked up in a worker's own table, tier two, and
what that misses as well is encoded by the library, each distinct pre-token
once.  Nothing is shuffled but the tallies that tier one is made from.

Tier one comes from a tally of all texts' pre-tokens, a first pass; it decides
how fast a count is, never what it is.  What a worker encodes for the tally
stays in its table for the count.

Pre-tokens are those of byte-level BPE: a contraction, or a run of letters, of
digits or of other marks with the one blank before it, or white space.  They
are found on whole columns in numpy; which class a code point has is learned
from the library.  Strings of added tokens are one token each, wherever they
are in a text.  Null and empty texts have no tokens; repeated rows count alike;
a long text is cut into blocks before white space, where a pre-token always
begins, so memory grows only with its longest run without any.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moldwise.llm.labelled import add_columns
from moldwise.llm.textbytes import SLICE_BYTES, U64, run_hashes, slices, text_bytes

LIMIT = 1024
ENTRIES, CACHED = 1 << 16, 1 << 20  # pre-tokens in tier one, and in tier two before it starts anew
TALLIED = 1 << 18  # distinct pre-tokens that a task tallies before it hands them on
BLANK, LETTER, NUMBER, OTHER, UNKNOWN = range(5)


class LengthTable:
    """Numbers of tokens by two 64-bit hashes of a pre-token: open addressing, probed for whole columns."""

    def __init__(self, entries: int) -> None:
        self.entries, self.used = entries, 0
        slots = 1 << max(4, (2 * entries - 1).bit_length())
        self.key, self.check = np.zeros(slots, U64), np.zeros(slots, U64)
        self.length = np.zeros(slots, np.int32)  # 0: a free slot

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key & U64(len(self.key) - 1)).astype(np.int64)

    def find(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """The length of each pre-token; 0 where it isn't in the table."""
        out = np.zeros(len(key), np.int32)
        todo, at = np.arange(len(key)), self._slot(key)
        while len(todo):
            length = self.length[at]
            same = (self.key[at] == key[todo]) & (self.check[at] == check[todo]) & (length > 0)
            out[todo[same]] = length[same]
            on = ~same & (length > 0)
            todo, at = todo[on], (at[on] + 1) & (len(self.key) - 1)
        return out

    def add(self, key: np.ndarray, check: np.ndarray, length: np.ndarray) -> None:
        """Enter distinct pre-tokens that aren't in the table; more than fit start it anew."""
        if self.used + len(key) > self.entries:
            self.length[:] = 0
            self.used = 0
            key, check, length = (x[: self.entries] for x in (key, check, length))
        self.used += len(key)
        todo, at = np.arange(len(key)), self._slot(key)
        while len(todo):
            free = np.flatnonzero(self.length[at] == 0)
            slot, first = np.unique(at[free], return_index=True)
            placed = free[first]
            self.key[slot], self.check[slot], self.length[slot] = (x[todo[placed]] for x in (key, check, length))
            left = np.ones(len(todo), bool)
            left[placed] = False
            todo, at = todo[left], (at[left] + 1) & (len(self.key) - 1)


class PreTokens:
    """Splits whole columns of text as the library's byte-level pre-tokenizer does, and counts tokens."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added):
            raise ValueError("only added tokens that match exactly are handled")
        self.added = sorted((t.content.encode() for t in added), key=len, reverse=True)
        self.pattern = re.compile(b"|".join(map(re.escape, self.added)))
        self.classes = np.full(0x110000, UNKNOWN, np.uint8)
        self.cache = LengthTable(CACHED)

    def _class(self, point: int) -> int:
        for known, mark in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
            if len(self.tokenizer.pre_tokenizer.pre_tokenize_str(mark + chr(point))) == 1:
                return known
        return BLANK

    def classify(self, points: np.ndarray) -> np.ndarray:
        out = self.classes[points]
        if (out == UNKNOWN).any():
            for point in np.unique(points[out == UNKNOWN]).tolist():
                self.classes[point] = self._class(point)
            out = self.classes[points]
        return out

    def split(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where pre-tokens begin in ``data``; ``bounds`` are the offsets of runs of bytes that are split by themselves."""
        if not len(data):
            return np.empty(0, np.int64)
        place = np.flatnonzero((data & 0xC0) != 0x80)  # the first byte of each code point
        points = data.astype(np.uint32) if len(place) == len(data) else np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        kind = self.classify(points)
        n = len(points)
        first = np.zeros(n + 3, bool)
        first[np.searchsorted(place, bounds)] = True
        begins = first[:n].copy()
        begins[1:] |= kind[1:] != kind[:-1]
        # the last of a run of white space goes by itself, or with what follows if it is a blank
        after = 1 + np.flatnonzero((kind[1:] != BLANK) & (kind[:-1] == BLANK) & ~first[1:n])
        begins[after - 1] = True
        begins[after[points[after - 1] == 0x20]] = False
        # contractions, only where a pre-token begins
        seen = np.zeros(n + 3, np.uint32)
        seen[:n] = points
        quote = np.flatnonzero(begins & (points == 0x27))
        one, two = seen[quote + 1], seen[quote + 2]
        inside = ~first[quote + 1]
        short = inside & np.isin(one, [ord(c) for c in "stmd"])
        long = inside & ~first[quote + 2] & np.logical_or.reduce([(one == ord(p[0])) & (two == ord(p[1])) for p in ("re", "ve", "ll")])
        begins[quote[short | long] + 1] = False
        behind = np.concatenate([quote[short] + 2, quote[long] + 3])
        begins[behind[behind < n]] = True
        return place[begins]

    def hashes(self, data: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ends of the pre-tokens, and two hashes of each."""
        end = np.append(start[1:], len(data))
        return end, run_hashes(data, start, end, 2), run_hashes(data, start, end, 1)

    def encoded(self, raw: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Numbers of tokens of some pre-tokens, by the library."""
        out = np.empty(len(start), np.int32)
        for at in range(0, len(start), 4096):
            part = [raw[a:b].decode() for a, b in zip(start[at : at + 4096].tolist(), end[at : at + 4096].tolist())]
            out[at : at + len(part)] = [len(e) for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
        return out

    def lengths(self, data: np.ndarray, start: np.ndarray, frequent: LengthTable) -> np.ndarray:
        """Numbers of tokens of all pre-tokens of ``data``."""
        end, key, check = self.hashes(data, start)
        out = frequent.find(key, check)
        missed = np.flatnonzero(out == 0)
        if len(missed):
            out[missed] = self._known(data, start[missed], end[missed], key[missed], check[missed])
        return out

    def _known(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Numbers of tokens by the worker's table; what isn't in it is encoded and entered."""
        out = self.cache.find(key, check)
        missed = np.flatnonzero(out == 0)
        if len(missed):
            which, first = distinct(key[missed], check[missed])
            new = missed[first]
            found = self.encoded(data.tobytes(), start[new], end[new])
            out[missed] = found[which]
            self.cache.add(key[new], check[new], found)
        return out

    def runs(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Bytes without added tokens, the offsets of what is split by itself, and for each text (runs, added tokens)."""
        raw = data.tobytes()
        if not any(mark in raw for mark in self.added):
            return data, offsets, []
        pieces, bounds, found, at = [], [0], [], 0
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            cut = [(m.start(), m.end()) for m in self.pattern.finditer(raw, a, b)]
            for x, y in zip([a, *(e for _, e in cut)], [*(s for s, _ in cut), b]):
                pieces.append(data[x:y])
                at += y - x
                bounds.append(at)
            found.append(len(cut))
        return np.concatenate(pieces), np.array(bounds), found

    def count(self, data: np.ndarray, offsets: np.ndarray, frequent: LengthTable) -> np.ndarray:
        """Numbers of tokens of some texts; a long one, alone, goes block by block."""
        if is_long(offsets):
            parts = (self._count(block, np.array([0, len(block)]), frequent) for block in blocks(data, SLICE_BYTES))
            return np.array([sum(int(n[0]) for n in parts)])
        return self._count(data, offsets, frequent)

    def tally(self, data: np.ndarray, offsets: np.ndarray):
        """Distinct pre-tokens of some texts, a long one block by block: hashes, numbers of tokens, how often they occur."""
        for part, ends in ((b, np.array([0, len(b)])) for b in blocks(data, SLICE_BYTES)) if is_long(offsets) else [(data, offsets)]:
            clean, bounds, _ = self.runs(part, ends)
            start = self.split(clean, bounds)
            end, key, check = self.hashes(clean, start)
            which, first = distinct(key, check)
            yield key[first], check[first], self._known(clean, start[first], end[first], key[first], check[first]), np.bincount(which, minlength=len(first))

    def _count(self, data: np.ndarray, offsets: np.ndarray, frequent: LengthTable) -> np.ndarray:
        clean, bounds, found = self.runs(data, offsets)
        start = self.split(clean, bounds)
        total = np.append(0, np.cumsum(self.lengths(clean, start, frequent), dtype=np.int64))
        at = total[np.searchsorted(start, bounds)]
        if not found:
            return np.diff(at)
        last = np.cumsum(np.array(found) + 1)
        return np.diff(np.append(0, at[last])) + np.array(found)


def distinct(key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each pair its number among the distinct ones, and where each of those comes first."""
    order = np.lexsort((check, key))
    new = np.ones(len(key), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (check[order][1:] != check[order][:-1])
    which = np.empty(len(key), np.int64)
    which[order] = np.cumsum(new) - 1
    return which, order[new]


def is_long(offsets: np.ndarray) -> bool:
    """Whether this is one long text."""
    return len(offsets) == 2 and offsets[-1] > 2 * SLICE_BYTES


def blocks(data: np.ndarray, size: int):
    """A text in blocks of about ``size`` bytes, each but the first beginning with white space behind another mark."""
    at = 0
    while len(data) - at > size:
        to = at + size
        while to < len(data):
            part = data[to - 1 : to + size]
            blank = (part == 0x20) | (part == 0x0A)
            solid = (part > 0x20) & (part < 0x7F)
            cut = np.flatnonzero(blank[1:] & solid[:-1])
            if len(cut):
                to += int(cut[0])
                break
            to += size
        if to >= len(data):
            break
        yield data[at:to]
        at = to
    yield data[at:]


_splitters: dict[str, PreTokens] = {}


def _splitter(path: str) -> PreTokens:
    if path not in _splitters:
        _splitters[path] = PreTokens(path)
    return _splitters[path]


def _merged(tallies: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Several tallies as one."""
    key, check, length, times = (np.concatenate(x) for x in zip(*tallies))
    which, first = distinct(key, check)
    total = np.zeros(len(first), np.int64)
    np.add.at(total, which, times)
    return key[first], check[first], length[first], total


def frequent_lengths(docs: DataFrame, tokenizer: str, entries: int = ENTRIES, tasks: int | None = None) -> LengthTable:
    """Tier one: the ``entries`` pre-tokens most frequent in all texts.

    Each partition tallies its distinct pre-tokens, ``TALLIED`` at a time;
    their sums are dealt by pre-token over ``tasks`` partitions (None: the
    session's number).
    """

    def run(batches):
        splitter = _splitter(tokenizer)

        def out(tally):
            key, check, length, times = tally
            return pa.RecordBatch.from_arrays([pa.array(c) for c in (key.view(np.int64), check.view(np.int64), length, times)], names=["key", "check", "length", "times"])

        held, size = [], 0
        for batch in slices(batches):
            for tally in splitter.tally(*text_bytes(batch.column(0))):
                held.append(tally)
                size += len(tally[0])
                if size > 2 * TALLIED:
                    held = [_merged(held)]
                    size = len(held[0][0])
                    if size > TALLIED:
                        yield out(held[0])
                        held, size = [], 0
        if held:
            yield out(_merged(held))

    seen = docs.select("text").mapInArrow(run, "key long, check long, length int, times long")
    if tasks:
        seen = seen.repartition(tasks, "key", "check")
    total = seen.groupBy("key", "check").agg(F.max("length").alias("length"), F.sum("times").alias("times"))
    rows = total.orderBy(F.desc("times"), "key", "check").limit(entries).select("key", "check", "length").toArrow()  # at most ``entries``
    table = LengthTable(entries)
    if rows.num_rows:
        key, check, length = (c.to_numpy() for c in rows.columns)
        table.add(key.view(U64), check.view(U64), length)
    return table


def token_counts(docs: DataFrame, tokenizer: str | None = None, name: str = "n_tokens", frequent: LengthTable | None = None) -> DataFrame:
    """``docs`` with the number of tokens of each ``text`` appended."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    table = docs.sparkSession.sparkContext.broadcast(frequent or frequent_lengths(docs, tokenizer))  # 20 bytes a slot, two slots an entry
    return add_columns(docs, [T.StructField(name, T.LongType())], lambda data, offsets: [_splitter(tokenizer).count(data, offsets, table.value)])


def count_report(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    counted = token_counts(docs.select("doc_id", "text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return counted.select("doc_id", size.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
