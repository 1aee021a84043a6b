"""Fill-in-middle transformation: texts are cut at two ranks, found in an indexable skip list of their units.

The bottom lane of the list has a link for each unit of a text (a code point,
or a match of a pattern, from left to right), and each link carries two widths:
units and code points.  An express lane keeps about every eighth node of the
lane below, chosen by a hash of the row's key and the node's place, and its
links carry the sums.  A rank is reached by going along a lane while the
accumulated unit width doesn't pass it, then down a lane; the code-point widths
gathered on the way are the place to cut.

Code points in the bottom lane are alike, so their links are stored as blocks
of 64 (a block's width is its size) and only the block with the cut is opened.

Two ranks, the form and the order of the parts follow from four numbers of a
row's key alone.  Null and empty texts and those that hold a sentinel stay
plain; a row without an id has the key of the empty string; repeated rows are
cut alike.  A text stays whole in a task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moldwise.llm.textbytes import U64, mix, slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FAN, BLOCK = 8, 64
PLAIN_FROM, SUFFIX_FIRST = 90, 20  # of 100


class SkipList:
    """Links of one text's units with their widths in units and code points, lane over lane."""

    def __init__(self, units: np.ndarray, points: np.ndarray, seed: int) -> None:
        self.lanes: list[tuple[list[int], list[int], list[int]]] = []  # of each node: its two widths, and its place in the lane below
        places = np.arange(len(units))
        below = places
        at_unit, at_point = (np.append(0, np.cumsum(w)) for w in (units, points))
        while True:
            ends = np.append(places[1:], len(units))
            self.lanes.append(((at_unit[ends] - at_unit[places]).tolist(), (at_point[ends] - at_point[places]).tolist(), below.tolist()))
            lane = mix(places.astype(U64) + U64((seed + len(self.lanes) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
            rises = lane % U64(FAN) == 0
            rises[:1] = True  # the head is in every lane
            below = np.flatnonzero(rises)
            if len(below) < 2 or len(below) == len(places):
                break
            places = places[below]

    def descend(self, rank: int) -> tuple[int, int]:
        """(units, code points) before the bottom node whose link holds or ends at unit ``rank``."""
        units = points = node = 0
        for depth in range(len(self.lanes) - 1, -1, -1):
            unit_widths, point_widths, below = self.lanes[depth]
            last = len(unit_widths) - 1
            while node < last and units + unit_widths[node] <= rank:
                units += unit_widths[node]
                points += point_widths[node]
                node += 1
            if depth:
                node = below[node]
        if len(unit_widths) and units + unit_widths[node] <= rank:  # the end of the text
            return units + unit_widths[node], points + point_widths[node]
        return units, points


def unit_widths(text: str, pattern: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Widths of the bottom links in units and code points; what no match covers belongs to the unit before it (the first: to the one after)."""
    if pattern is None:
        n = len(text)
        size = np.full(-(-n // BLOCK), BLOCK)
        if n % BLOCK:
            size[-1] = n % BLOCK
        return size, size
    starts = [m.start() for m in regex.finditer(pattern, text) if m.end() > m.start()] or ([0] if text else [])
    if starts:
        starts[0] = 0
    points = np.diff(np.append(np.array(starts, np.int64), len(text))) if starts else np.empty(0, np.int64)
    return np.ones(len(points), np.int64), points


def numbers(key: str, seed: int) -> list[int]:
    """The first four 8-digit groups of the hex sha256 of ``seed:key``."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def cut_ranks(text: str, ranks: list[int], pattern: str | None, seed: int) -> list[int]:
    """The code-point places of unit ranks."""
    units, points = unit_widths(text, pattern)
    if not len(units):
        return [0] * len(ranks)
    steps = SkipList(units, points, seed)
    out = []
    for rank in ranks:
        seen, place = steps.descend(rank)
        out.append(place + rank - seen)  # inside a block of code points a unit is a code point
    return out


def transformed(text: str, key: str, pattern: str | None = None, seed: int = 1) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, code points of the prefix, of the middle, output) of one text."""
    h = numbers(key, seed)
    n = len(text) if pattern is None else int(unit_widths(text, pattern)[0].sum())
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= PLAIN_FROM:
        return n, "plain", None, None, text
    a, b = cut_ranks(text, sorted((h[0] % (n + 1), h[1] % (n + 1))), pattern, h[0])
    first, middle, rest = text[:a], text[a:b], text[b:]
    if h[3] % 100 < SUFFIX_FIRST:
        return n, "spm", a, b - a, f"{SUFFIX}{rest}{PREFIX}{first}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{first}{SUFFIX}{rest}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, pattern: str | None = None, seed: int = 1, prefix: str = "fim_") -> DataFrame:
    """``docs`` (doc_id, text) with n, form, prefix_chars, middle_chars and output appended, their names behind ``prefix``.

    Units are code points, or the matches of ``pattern``.
    """
    types = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]
    spark_types = {pa.int64(): T.LongType(), pa.string(): T.StringType()}
    fields = [T.StructField(prefix + name, spark_types[kind]) for name, kind in types]
    names = [*docs.columns, *(f.name for f in fields)]

    def run(batches):
        for batch in slices(batches):
            ids, texts = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "text"))
            rows = [transformed(text or "", "" if i is None else str(i), pattern, seed) for i, text in zip(ids, texts)]
            columns = [pa.array(values, kind) for values, (_, kind) in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))


def restored(form: Column, output: Column) -> Column:
    """The text that ``output`` was made from.  Parts hold no sentinel, so the first of each is the one that was set."""
    first, second = F.when(form == "psm", PREFIX).otherwise(SUFFIX), F.when(form == "psm", SUFFIX).otherwise(PREFIX)
    head = F.split_part(output, second, F.lit(1))
    tail = F.substr(output, F.char_length(head) + 1 + len(PREFIX))
    one = F.substr(head, F.lit(1 + len(PREFIX)))
    two = F.split_part(tail, F.lit(MIDDLE), F.lit(1))
    middle = F.substr(tail, F.char_length(two) + 1 + len(MIDDLE))
    whole = F.when(form == "psm", F.concat(one, middle, two)).otherwise(F.concat(two, middle, one))
    return F.when(form == "plain", output).when(output.startswith(first), whole)


def infilling_report(docs: DataFrame) -> DataFrame:
    done = fill_in_middle(docs.select("doc_id", "text"))
    form, output = F.col("fim_form"), F.col("fim_output")
    return done.select(
        "doc_id", F.col("fim_n").alias("n"), form.alias("form"), F.col("fim_prefix_chars").alias("prefix_chars"), F.col("fim_middle_chars").alias("middle_chars"),
        F.sha2(output.cast("binary"), 256).alias("output_sha256"), F.sha2(restored(form, output).cast("binary"), 256).alias("restored_sha256"),
    )


ORACLE_SQL = """
with d as (select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents),
k as (select doc_id, t, length(t) as n, ('0x' || substr(h, 1, 8))::ubigint as h1, ('0x' || substr(h, 9, 8))::ubigint as h2,
             ('0x' || substr(h, 17, 8))::ubigint as h3, ('0x' || substr(h, 25, 8))::ubigint as h4 from d),
c as (select *, least(h1 % (n + 1), h2 % (n + 1))::bigint as a, greatest(h1 % (n + 1), h2 % (n + 1))::bigint as b,
             case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
                  when h4 % 100 < 20 then 'spm' else 'psm' end as form from k),
p as (select *, substr(t, 1, a) as one, substr(t, a + 1, b - a) as two, substr(t, b + 1) as three from c),
o as (select *, case form when 'plain' then t when 'psm' then '<P>' || one || '<S>' || three || '<M>' || two else '<S>' || three || '<P>' || one || '<M>' || two end as output from p)
select doc_id, n::bigint as n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
       sha256(output) as output_sha256, sha256(case when form = 'plain' then t else one || two || three end) as restored_sha256
from o
"""
