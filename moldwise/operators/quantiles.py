"""Exact quantiles (linear interpolation) of many columns in two passes.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer; for a global quantile that is one task holding the whole
column.  Here the first pass is one aggregate for all columns: the number of
values of each, and a mergeable sketch (rank error ``1 / ACCURACY``) that gives
a bracket of two data values around each wanted rank.  The second pass counts
the values below each bracket and groups those inside it by value, so a value
that fills a third of a column is one row.  A rank is then read off exactly.

What lies inside the brackets is about ``6 / ACCURACY`` of a column.  If that
is more than ``local_limit`` rows, it is stored and narrowed further by rounds
of grid and histogram over the stored rows; the data itself isn't read again.
Whether a bracket holds its rank is checked, never assumed: one that doesn't is
opened on that side and counted anew.
"""

from __future__ import annotations

import bisect
import math
from typing import NamedTuple, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moldwise.session import reliable_checkpoint

ACCURACY = 4000
GRID = 64
LOCAL_LIMIT = 100_000


def _range_filter(cid: int, lo, hi):
    cond = F.col("c") == F.lit(cid)
    if lo is not None:
        cond = cond & (F.col("v") > F.lit(lo))
    if hi is not None:
        cond = cond & (F.col("v") < F.lit(hi))
    return cond


def _fetch(values: DataFrame, states: dict, limit: int) -> dict:
    """Answer ranks whose ranges are small: one job fetches the distinct
    values of those ranges with their counts (at most ``limit`` pairs, checked)
    and ranks are picked locally from the cumulative counts."""
    ranges = {(cid, lo, hi) for (cid, _k), (lo, hi, _r, _m) in states.items()}
    cond = None
    for cid, lo, hi in ranges:
        c = _range_filter(cid, lo, hi)
        cond = c if cond is None else cond | c
    pairs = values.where(cond).groupBy("c", "v").agg(F.sum("n").alias("count")).limit(limit + 1).collect()
    if len(pairs) > limit:
        raise RuntimeError("quantile search could not narrow a value range below the fetch limit")
    by_col = {}
    for p in pairs:
        by_col.setdefault(p["c"], []).append((p["v"], p["count"]))
    cum = {}
    for cid, lst in by_col.items():
        lst.sort()
        vals, run, total = [], [], 0
        for v, n in lst:
            total += n
            vals.append(v)
            run.append(total)
        cum[cid] = (vals, run)
    out = {}
    for (cid, k), (lo, hi, r, _m) in states.items():
        vals, run = cum.get(cid, ([], []))
        start = 0 if lo is None else bisect.bisect_right(vals, lo)
        stop = len(vals) if hi is None else bisect.bisect_left(vals, hi)
        base = run[start - 1] if start > 0 else 0
        # first value in [start, stop) whose running count exceeds base + r
        j = bisect.bisect_right(run, base + r, start, stop)
        out[(cid, k)] = vals[j] if j < stop else None
    return out


def _select_ranks(values: DataFrame, wanted: dict, local_limit: int, grid: int) -> dict:
    """Values at 0-based ranks: ``wanted`` maps ``(column id, rank)`` to the
    column's value count; ``values`` has columns ``c`` (id), ``v`` and ``n``
    (how often).

    Each round costs two jobs for all pending ranks together: approximate
    grids per distinct range, then one small histogram (range, grid bucket,
    equal-to-grid flag) -> counts, at most ranges x grid x 2 rows.
    """
    v = F.col("v")
    # (cid, rank) -> (exclusive lower bound, exclusive upper bound, rank inside, rows inside)
    pending = {key: (None, None, key[1], n) for key, n in wanted.items()}
    done = {}
    probs = [i / grid for i in range(1, grid)]
    # Every round either answers a rank or excludes at least one grid value
    # (with its rows) from the rank's range, so the loop always ends; with a
    # 64-point grid a round typically shrinks a range about 50-fold.
    while pending:
        small, rows = {}, 0  # ranges that fit the limit all together; the others are narrowed on
        for key, st in sorted(pending.items(), key=lambda item: item[1][3]):
            if rows + st[3] > local_limit:
                break
            small[key], rows = st, rows + st[3]
        if small:
            done.update(_fetch(values, small, local_limit))
            for key in small:
                pending.pop(key)
        if not pending:
            return done
        ranges = sorted({(key[0],) + st[:2] for key, st in pending.items()}, key=str)
        conds = [_range_filter(*r) for r in ranges]
        g = values.agg(*[F.percentile_approx(F.when(c, v), probs, 4 * grid).alias(f"g{i}")
                         for i, c in enumerate(conds)]).first()
        pts = [sorted(set(x for x in (g[f"g{i}"] or []) if x is not None)) for i in range(len(ranges))]
        tags = []
        for i, c in enumerate(conds):
            arr = F.array(*[F.lit(float(x)) for x in pts[i]]) if pts[i] else F.array().cast("array<double>")
            bucket = F.size(F.filter(arr, lambda x: x < v))
            tags.append(F.when(c, F.struct(F.lit(i).alias("rid"), bucket.alias("b"),
                                           F.array_contains(arr, v).alias("eq"))))
        hist = values.select("n", F.explode(F.filter(F.array(*tags), lambda t: t.isNotNull())).alias("t")) \
                     .groupBy("t.rid", "t.b", "t.eq").agg(F.sum("n").alias("count")).collect()
        counts = {(row["rid"], row["b"], row["eq"]): row["count"] for row in hist}
        for key in sorted(pending):
            lo, hi, r, m = pending[key]
            i = ranges.index((key[0], lo, hi))
            cum, prev_le, new_lo, new_hi, new_m, answered = 0, 0, lo, hi, None, False
            for j, p in enumerate(pts[i]):
                at_j = counts.get((i, j, False), 0) + counts.get((i, j, True), 0)
                cum += at_j
                le = cum
                lt = le - counts.get((i, j, True), 0)
                if lt <= r < le:
                    done[key] = p
                    answered = True
                    break
                if r < lt:
                    new_hi, new_m = p, lt - prev_le
                    break
                prev_le, new_lo = le, p
            if answered:
                pending.pop(key)
                continue
            if new_m is None:
                new_m = m - prev_le
            if new_m >= m:  # cannot happen: grid values are data values inside the range
                raise RuntimeError("quantile search made no progress")
            pending[key] = (new_lo, new_hi, r - prev_le, new_m)
    return done


def _value(c: str) -> Column:
    """A column as a number, NaN as NULL."""
    x = F.col(f"`{c}`").cast("double")
    return F.nanvl(x, F.lit(None))


class Sketch(NamedTuple):
    """The first pass: rows, values of each column, and a bracket (low, high) for each column and probability; None is open."""

    rows: int
    counts: dict
    brackets: dict


def sketch_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int = ACCURACY) -> Sketch:
    """One aggregate over all columns."""
    cols, probs = list(cols), list(dict.fromkeys(probs))
    margin = 3 / accuracy
    sides = [min(max(q, 0.0), 1.0) for p in probs for q in (p - margin, p + margin)]
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        aggs += [F.count(_value(c)).alias(f"n{i}"), F.percentile_approx(_value(c), sides, accuracy).alias(f"q{i}")]
    row = df.agg(*aggs).first()
    counts = {c: row[f"n{i}"] for i, c in enumerate(cols)}
    brackets = {}
    for i, c in enumerate(cols):
        for j, p in enumerate(probs):
            # with few values a margin may be less than a rank: all of them are looked at
            few = counts[c] < 2 * accuracy
            low = None if few or p - margin <= 0 else row[f"q{i}"][2 * j]
            high = None if few or p + margin >= 1 else row[f"q{i}"][2 * j + 1]
            brackets[c, p] = (low, high)
    return Sketch(row["rows"], counts, brackets)


def _bracketed(df: DataFrame, cols: Sequence[str], brackets: list[tuple]) -> DataFrame:
    """(c, v, n) of one pass: how often each value is inside bracket number ``c``, and with ``v`` NULL how many are below."""
    found = []
    for b, (i, low, high) in enumerate(brackets):
        x = _value(cols[i])
        kept = x.isNotNull() if high is None else x <= F.lit(high)
        found.append(F.when(kept, F.struct(F.lit(b).alias("c"), (x if low is None else F.when(x >= F.lit(low), x)).alias("v"))))
    rows = df.select(F.explode(F.filter(F.array(*found), lambda p: p.isNotNull())).alias("p")).select("p.c", "p.v")
    return rows.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))


def _ranks_in(df: DataFrame, cols: Sequence[str], wanted: dict, local_limit: int, grid: int) -> tuple[dict, dict]:
    """Values of ``wanted`` ({(column number, low, high): ranks}) by one pass over ``df``, and the brackets that missed, widened."""
    brackets = list(wanted)
    inside = reliable_checkpoint(_bracketed(df, cols, brackets))  # few rows: what all else is read from
    facts = {r["c"]: r for r in inside.groupBy("c").agg(F.sum(F.when(F.col("v").isNull(), F.col("n"))).alias("below"),
                                                        F.sum(F.when(F.col("v").isNotNull(), F.col("n"))).alias("inside")).collect()}
    todo, place, missed = {}, {}, {}
    for b, bracket in enumerate(brackets):
        below, held = (facts[b]["below"] or 0, facts[b]["inside"] or 0) if b in facts else (0, 0)
        for k in wanted[bracket]:
            if k < below or k >= below + held:
                i, low, high = bracket
                missed.setdefault((i, None, high) if k < below else (i, low, None), []).append(k)
                continue
            todo[b, k - below] = held
            place[b, k - below] = (bracket[0], k)
    values = inside.where(F.col("v").isNotNull())
    at = _select_ranks(values, todo, local_limit, grid) if todo else {}
    return {place[key]: v for key, v in at.items()}, missed


def exact_quantiles_multi(df: DataFrame, cols: Sequence[str], probs: Sequence[float], local_limit: int = LOCAL_LIMIT,
                          grid: int = GRID, accuracy: int = ACCURACY, sketch: Sketch | None = None) -> dict:
    """``{column: [quantile for each prob]}`` over the non-null, non-NaN
    values of each column (``None`` for an empty column), by two passes over
    ``df`` for any number of columns; one if ``sketch`` is given."""
    cols = list(cols)
    if not cols:
        return {}
    sketch = sketch or sketch_quantiles(df, cols, probs, accuracy)
    wanted: dict = {}
    for i, c in enumerate(cols):
        n = sketch.counts[c]
        for p in probs if n else []:
            h = (n - 1) * p
            ranks = wanted.setdefault((i, *sketch.brackets[c, p]), [])
            ranks += [k for k in (math.floor(h), math.ceil(h)) if k not in ranks]
    at: dict = {}
    while wanted:  # again only for brackets that missed their rank
        found, wanted = _ranks_in(df, cols, wanted, local_limit, grid)
        at.update(found)
    out = {}
    for i, c in enumerate(cols):
        n, res = sketch.counts[c], []
        for p in probs:
            h = (n - 1) * p
            a, b = (at[i, math.floor(h)], at[i, math.ceil(h)]) if n else (None, None)
            res.append(a + (h - math.floor(h)) * (b - a) if n else None)
        out[c] = res
    return out


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], local_limit: int = LOCAL_LIMIT,
                    grid: int = GRID) -> list:
    """Linear-interpolation quantiles of the non-null, non-NaN values of ``col``.

    Same definition as pandas ``quantile`` and SQL ``quantile_cont``; returns
    ``None`` for every probability when the column is empty.
    """
    return exact_quantiles_multi(df, [col], probs, local_limit, grid)[col]


def approx_quantiles_multi(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                           accuracy: int = 10_000) -> dict:
    """Opt-in approximate quantiles (``percentile_approx``, one pass, bounded
    sketch per column; rank error about n / accuracy)."""
    cols = list(cols)
    if not cols:
        return {}
    r = df.agg(*[F.percentile_approx(F.when(~F.isnan(F.col(f"`{c}`").cast("double")),
                                            F.col(f"`{c}`").cast("double")), list(probs), accuracy).alias(f"q{i}")
                 for i, c in enumerate(cols)]).first()
    return {c: (list(r[f"q{i}"]) if r[f"q{i}"] is not None else [None for _ in probs]) for i, c in enumerate(cols)}


def quantiles_multi(df: DataFrame, cols: Sequence[str], probs: Sequence[float], exact: bool = True,
                    sketch: Sketch | None = None) -> dict:
    """Exact linear-interpolation quantiles, or the approximate sketch when
    ``exact`` is False."""
    if exact:
        return exact_quantiles_multi(df, cols, probs, sketch=sketch)
    return approx_quantiles_multi(df, cols, probs)
