"""Deterministic dataset splits and split reports.

Every split is a pure function of the data and a seed: a group (or row) is
placed by ``md5(key || '#' || seed)``, so the result does not depend on
partitioning, executor count or retries (``randomSplit`` does).  Rows are
labelled in place by comparing their own hash with one cut value; no join
back to a group table is needed.  The cut is the k-th smallest group hash,
found by counting the distinct hashes by prefix, range by range.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moldwise.functions.columns import known
from moldwise.operators.ranking import global_row_number
from moldwise.session import reliable_checkpoint, stored


# A table of class starts is broadcast up to this many rows (a few MB).
CLASSES_TO_SEND = 100_000


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def group_key(cols: Sequence[str]) -> Column:
    """Composite key ``a_b_c`` of the columns as text (NULL -> ``nan``)."""
    return F.concat_ws("_", *[F.coalesce(_q(c).cast("string"), F.lit("nan")) for c in cols])


def key_hash(cols: Sequence[str], seed: int = 42) -> Column:
    return F.md5(F.concat(group_key(cols), F.lit(f"#{seed}")))


def group_split(df: DataFrame, group_cols: Sequence[str], test_size: float = 0.2, seed: int = 42,
                out: str = "split") -> DataFrame:
    """Whole groups go to ``train`` or ``test``: ``ceil(test_size * groups)``
    groups with the smallest hashes form the test side, so no group is on
    both sides."""
    h = key_hash(group_cols, seed)
    hashes = stored(df.select(h.alias("_h")).distinct())
    cut = _kth_hash(hashes, test_size)
    if cut is None:
        return df.withColumn(out, F.lit("train"))
    return df.withColumn(out, F.when(h <= F.lit(cut), "test").otherwise("train"))


# Hashes that are fetched to pick the cut among them.
HASHES_TO_FETCH = 10_000


def _kth_hash(hashes: DataFrame, share: float) -> str | None:
    """The ``ceil(share * n)``-th smallest of the stored distinct hashes; None
    if that is none.  A round counts them by the next four digits (65,536
    ranges at most) within the range that holds the cut, until that range can
    be fetched; hashes spread evenly, so one round serves 600 million."""
    prefix, rank = "", None
    while True:
        within = hashes.where(F.col("_h").startswith(prefix))
        counts = within.groupBy(F.substring("_h", 1, len(prefix) + 4).alias("p")).count().collect()
        if rank is None:
            rank = min(math.ceil(share * sum(r["count"] for r in counts)), sum(r["count"] for r in counts)) - 1
            if rank < 0:
                return None
        for prefix, m in sorted((r["p"], r["count"]) for r in counts):
            if rank < m:
                break
            rank -= m
        if m <= HASHES_TO_FETCH:
            return sorted(r[0] for r in hashes.where(F.col("_h").startswith(prefix)).collect())[rank]


def row_split(df: DataFrame, key_cols: Sequence[str], test_size: float = 0.2, seed: int = 42,
              out: str = "split") -> DataFrame:
    """Row-level 80/20 style split; ``key_cols`` must identify a row."""
    return group_split(df, key_cols, test_size, seed, out)


def stratified_folds(df: DataFrame, label: str, key_cols: Sequence[str], k: int = 5, seed: int = 42,
                     out: str = "fold") -> DataFrame:
    """Fold number 0..k-1 per row, dealt round-robin inside each class in
    hash order, so every fold keeps the class mix (per-class fold sizes
    differ by at most one).

    A class may hold most rows, so positions are not computed with a window
    partitioned by the class (one task per class): rows are globally ranked
    by (class, hash) with range partitioning, and each class's first
    position (one row per class) is subtracted.
    """
    h = key_hash(key_cols, seed)
    ranked = global_row_number(df.withColumn("_h", h), [label, "_h"], "_g")
    # one row per class, stored, so its size is known when the join is planned
    # (small: broadcast); rows of a class never meet in one task for it
    starts = reliable_checkpoint(ranked.groupBy(_q(label).alias("_lab")).agg(F.min("_g").alias("_s")))
    return ranked.join(F.broadcast(starts) if starts.count() <= CLASSES_TO_SEND else starts, _q(label).eqNullSafe(F.col("_lab"))) \
        .withColumn(out, ((F.col("_g") - F.col("_s")) % k).cast("int")).drop("_h", "_g", "_s", "_lab")


def split_report(df: DataFrame, target: str, group_cols: Sequence[str] | None = None,
                 split: str = "split") -> DataFrame:
    """Per side: rows, share of rows, groups, mean rows per group, target
    mean and population std; ``group_overlap`` = groups found on both sides
    (0 for a correct group split)."""
    g = group_key(group_cols) if group_cols else F.lit(None).cast("string")
    base = df.select(_q(split).alias("side"), g.alias("_g"), _q(target).alias("_y"))
    total = df.select(F.count(F.lit(1))).scalar()
    per = base.groupBy("side").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("_g").alias("groups"),
        F.avg("_y").alias("target_mean"), F.stddev_pop("_y").alias("target_std"))
    overlap = base.groupBy("_g").agg(F.count_distinct("side").alias("_k")).where("_k > 1") \
        .select(F.count(F.lit(1))).scalar()
    return per.select("side", "rows", (F.col("rows") / total).alias("share"), "groups",
                      F.try_divide(F.col("rows"), F.col("groups")).alias("rows_per_group"),
                      "target_mean", "target_std", overlap.alias("group_overlap"))


def matrix_summary(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """One row: rows, features, overall missing % of the feature matrix,
    target mean / population std / min / max."""
    n = F.count(F.lit(1))
    if features:
        missing = sum((F.count_if(known(df, c).isNull()) for c in features), F.lit(0))
        miss = F.try_divide(missing * 100.0, n * len(features))
    else:
        miss = F.lit(None).cast("double")
    y = known(df, target)
    return df.agg(n.alias("rows"), F.lit(len(features)).alias("features"), miss.alias("missing_pct"),
                  F.avg(y).alias("target_mean"), F.stddev_pop(y).alias("target_std"),
                  F.min(y).cast("double").alias("target_min"), F.max(y).cast("double").alias("target_max"))
