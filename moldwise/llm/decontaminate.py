"""Benchmark decontamination: prefix-filtered set join of item windows against documents.

A window is ten consecutive words of an item (a shorter item is one window).
Its shingles are its runs of three words (of all its words, if fewer).  All of
them must occur in a document that holds the window, so a prefix of one
shingle is necessary, and the rarest in the corpus is taken.  Documents are
joined on these prefix shingles; the shingle's place in the window says where
the window would lie, which must be inside the document (length and position
bounds), and there each word is compared by two independent 64-bit hashes.

The windows go to the tasks in parts of at most ``part`` rows, so what is
broadcast is bounded; with more windows the documents pass several times, and
hits and items of all parts are united.

Null texts have no words and items without words no window; items without an
id are left out.  Repeated items or documents are each handled by themselves.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moldwise.llm.textbytes import ALNUM, U64, Words, expand, grams, slices, text_bytes
from moldwise.session import reliable_checkpoint

WINDOW, SHINGLE = 10, 3
PART = 100_000
FILTER_BITS = 20


def window_rows(items: DataFrame) -> DataFrame:
    """Distinct (item, size, first, second): the two hashes of each word of every window."""

    def run(batches):
        for batch in slices(batches):
            words = Words(*text_bytes(batch.column(1)), ALNUM)
            if not len(words):
                continue
            pair = [words.hashes(0), words.hashes(1)]
            names = batch.column(0).to_pylist()
            out = [[], [], [], []]
            for i, name in enumerate(names):
                at, to = int(words.at[i]), int(words.at[i + 1])
                size = min(WINDOW, to - at)
                for k in range(at, to - size + 1) if size else ():
                    for column, value in zip(out, (name, size, pair[0][k : k + size].tobytes(), pair[1][k : k + size].tobytes())):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary()), pa.array(out[3], pa.binary())], names=["item", "size", "first", "second"])

    return items.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string").alias("item"), "text").mapInArrow(run, "item string, size int, first binary, second binary").distinct()


@dataclass
class Part:
    """Windows of one part; ``of_item`` and ``size`` by window, words in two arrays filled up with zeros."""

    items: list[str]
    of_item: np.ndarray
    size: np.ndarray
    first: np.ndarray
    second: np.ndarray

    @classmethod
    def collect(cls, rows: DataFrame) -> Part:
        got = rows.collect()
        items = sorted({r.item for r in got})
        number = {name: i for i, name in enumerate(items)}
        words = np.zeros((2, len(got), WINDOW), U64)
        for i, r in enumerate(got):
            words[0, i, : r["size"]] = np.frombuffer(r["first"], U64)
            words[1, i, : r["size"]] = np.frombuffer(r["second"], U64)
        return cls(items, np.array([number[r.item] for r in got], np.int64), np.array([r["size"] for r in got], np.int64), words[0], words[1])

    def shingles(self) -> dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """By shingle length: (hash, window, place) of every shingle of every window."""
        out: dict[int, list] = {}
        for size in np.unique(self.size):
            length = min(SHINGLE, int(size))
            rows = np.flatnonzero(self.size == size)
            for place in range(int(size) - length + 1):
                h = np.array([grams(w, length)[0] for w in self.first[rows, place : place + length]], U64)
                out.setdefault(length, []).append((h, rows, np.full(len(rows), place)))
        return out


class Lookup:
    """Places of hashes in a sorted array, behind a table of a million bits that turns most of the others away."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        self.table = np.zeros(1 << FILTER_BITS, bool)
        self.table[(keys >> U64(64 - FILTER_BITS)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``h`` that hold a key, and which."""
        at = np.flatnonzero(self.table[(h >> U64(64 - FILTER_BITS)).astype(np.int64)])
        key = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        same = self.keys[key] == h[at]
        return at[same], key[same]


def shingle_counts(docs: DataFrame, keys: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Occurrences of the given shingles in all documents, as many as there are keys."""
    shared = docs.sparkSession.sparkContext.broadcast(keys)

    def run(batches):
        lookups = {n: Lookup(k) for n, k in shared.value.items()}
        total = {n: np.zeros(len(k), np.int64) for n, k in shared.value.items()}
        for batch in slices(batches):
            words = Words(*text_bytes(batch.column(0)), ALNUM)
            h = words.hashes() if len(words) else np.empty(0, U64)
            for n, lookup in lookups.items():
                _, key = lookup.find(grams(h, n))
                total[n] += np.bincount(key, minlength=len(lookup.keys))
        for n, count in total.items():
            some = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), n, np.int32)), pa.array(some), pa.array(count[some])], names=["length", "key", "n"])

    out = {n: np.zeros(len(k), np.int64) for n, k in keys.items()}
    for r in docs.select("text").mapInArrow(run, "length int, key long, n long").groupBy("length", "key").agg(F.sum("n").alias("n")).collect():
        out[r["length"]][r["key"]] = r["n"]
    return out


@dataclass
class Index:
    part: Part
    prefix: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # by shingle length: keys, from, count, window, place

    @classmethod
    def build(cls, docs: DataFrame, part: Part) -> Index:
        """Each window under its rarest shingle; of equally rare ones, under that with the smallest hash."""
        found = {n: tuple(np.concatenate(x) for x in zip(*rows)) for n, rows in part.shingles().items()}
        keys = {n: np.unique(h) for n, (h, _, _) in found.items()}
        counts = shingle_counts(docs, keys)
        prefix = {}
        for n, (h, window, place) in found.items():
            order = np.lexsort((place, h, counts[n][np.searchsorted(keys[n], h)], window))
            order = order[np.unique(window[order], return_index=True)[1]]
            order = order[np.argsort(h[order], kind="stable")]
            key, start, count = np.unique(h[order], return_index=True, return_counts=True)
            prefix[n] = (key, start, count, window[order], place[order])
        return cls(part, prefix)

    def matches(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """First word and window of every occurrence in whole texts."""
        h, part = words.hashes(), self.part
        text, second, out = None, None, []
        for n, (keys, start, count, window, place) in self.prefix.items():
            at, key = Lookup(keys).find(grams(h, n))
            if not len(at):
                continue
            text = words.text if text is None else text
            second = words.hashes(1) if second is None else second
            rows = expand(start[key], count[key])
            w = window[rows]
            first = np.repeat(at, count[key]) - place[rows]
            here = text[np.repeat(at, count[key])]
            ok = (first >= words.at[here]) & (first + part.size[w] <= words.at[here + 1])
            first, w = first[ok], w[ok]
            for j in range(WINDOW):
                spot = np.minimum(first + j, len(h) - 1)
                ok = (j >= part.size[w]) | ((h[spot] == part.first[w, j]) & (second[spot] == part.second[w, j]))
                first, w = first[ok], w[ok]
            out.append((first, w))
        if not out:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([f for f, _ in out]), np.concatenate([w for _, w in out])


FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_words", T.ArrayType(T.LongType())),
    T.StructField("items", T.ArrayType(T.StringType())),
]


def _marked(docs: DataFrame, index: Index | None, names: list[str], first: bool) -> DataFrame:
    """``docs`` with the words that windows of one part cover and the items that they are of, added to those of earlier parts."""
    kept = docs.columns if first else [c for c in docs.columns if c not in names]
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        index = shared.value
        for batch in slices(batches):
            words = Words(*text_bytes(batch.column(batch.schema.get_field_index("text"))), ALNUM)
            n = batch.num_rows
            hits: list[list[int]] = [[] for _ in range(n)]
            items: list[list[str]] = [[] for _ in range(n)]
            if not first:
                hits, items = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names[1:])
            if index is not None and len(words):
                at, window = index.matches(words)
                cover = np.zeros(len(words) + 1, np.int64)
                np.add.at(cover, at, 1)
                np.add.at(cover, at + index.part.size[window], -1)
                hit = np.flatnonzero(np.cumsum(cover[:-1]))
                of = words.text[hit]
                for i in np.unique(of):
                    hits[i] = sorted({*hits[i], *(hit[of == i] - words.at[i]).tolist()})
                pairs = np.unique(words.text[at] * max(1, len(index.part.items)) + index.part.of_item[window])
                for pair in pairs:
                    i, item = divmod(int(pair), len(index.part.items))
                    items[i] = sorted({*items[i], index.part.items[item]})
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.array(words.counts, pa.int64()), pa.array(hits, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))], names=[*kept, *names])

    fields = [T.StructField(name, f.dataType) for name, f in zip(names, FIELDS)]
    return docs.mapInArrow(run, T.StructType([*(docs.schema[c] for c in kept), *fields]))


def contamination(docs: DataFrame, items: DataFrame, prefix: str = "", part: int = PART) -> DataFrame:
    """``docs`` with FIELDS appended: words, places of the words inside an occurring window, and items with such windows."""
    names = [prefix + f.name for f in FIELDS]
    rows = reliable_checkpoint(window_rows(items))
    parts = -(-rows.count() // part)
    if not parts:
        return _marked(docs, None, names, True)
    out = docs
    for k in range(parts):
        some = rows.where(F.pmod(F.xxhash64("item", "first"), F.lit(parts)) == k)
        out = _marked(out, Index.build(docs, Part.collect(some)), names, k == 0)
    return out


def contamination_report(docs: DataFrame, items: DataFrame, part: int = PART) -> DataFrame:
    marked = contamination(docs.select("doc_id", "text"), items.select("item_id", "text"), part=part)
    return marked.select(
        "doc_id", "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )


#: Words are compared as one text with a blank around each; regexp_extract_all takes whole texts.
ORACLE_SQL = r"""
with dw as (select doc_id, row_number() over () as r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
iw as (select item_id::varchar as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark where item_id is not null),
win as (select distinct item, least(len(w), 10) as n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as s
        from iw, range(1, len(w) - least(len(w), 10) + 2) t(i) where len(w) > 0),
sizes as (select distinct n from win),
dg as (select r, n, i, array_to_string(w[i:i + n - 1], ' ') as s from dw, sizes, range(1, len(w) - n + 2) t(i)),
hits as (select dg.r, dg.n, dg.i, win.item from dg join win on dg.n = win.n and dg.s = win.s),
words as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from hits) group by r),
its as (select r, count(*) as n_items, string_agg(item, ',' order by item) as ids from (select distinct r, item from hits) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from dw left join words using (r) left join its using (r)
"""
