"""Profiles and summaries of readings, feature tables and ML datasets.

Each summary is one aggregate pass (or a grouped aggregate) whose output is
bounded by the number of columns, variables or machines, never by rows.
Totals used as denominators are scalar subqueries (``DataFrame.scalar``),
evaluated once and broadcast as a constant, so no cross join is planned.
Per-group "top k" lists use ``row_number() <= k``, which Spark turns into a
partial per-partition limit before the shuffle (``WindowGroupLimit``).
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

from moldwise.functions.columns import known, to_number
from moldwise.operators.frequent import distinct_estimates, distinct_sketches, frequent_values, value_counts
from moldwise.operators.ranking import global_row_number

# Suffixes that mark aggregated feature columns.
FEATURE_SUFFIXES = ("_mean", "_max", "_std", "_count", "_mode", "_delta", "_first", "_last")
# Average above which a scrap column is judged a running total, not a daily value.
CUMULATIVE_AVERAGE = 10000


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _parsed(df: DataFrame, col: str) -> Column:
    if isinstance(df.schema[col].dataType, StringType):
        return F.try_to_timestamp(_q(col))
    return _q(col)


def profile_readings(readings: DataFrame, timestamp_col: str = "timestamp", variable_col: str = "variable_name",
                     value_col: str = "value") -> DataFrame:
    """One row: rows, distinct variables, first/last timestamp, rows whose
    timestamp is missing or unparseable, span in whole days + hours, and how
    many values parse as numbers."""
    ts = _parsed(readings, timestamp_col)
    a = readings.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(_q(variable_col)).alias("variables"),
        F.min(ts).alias("ts_min"), F.max(ts).alias("ts_max"),
        F.count_if(ts.isNull()).alias("bad_timestamps"),
        F.count(to_number(_q(value_col))).alias("numeric_values"))
    span = F.unix_timestamp(F.col("ts_max").cast("timestamp")) - F.unix_timestamp(F.col("ts_min").cast("timestamp"))
    return a.select(
        "rows", "variables", "ts_min", "ts_max", "bad_timestamps",
        F.floor(span / 86400).cast("bigint").alias("span_days"),
        F.floor((span % 86400) / 3600).cast("bigint").alias("span_hours"),
        "numeric_values",
        (F.col("rows") - F.col("numeric_values")).alias("non_numeric_values"),
        F.try_divide(F.col("numeric_values") * 100.0, F.col("rows")).alias("numeric_pct"))


def rounded_pct(part: Column, whole: Column, digits: int) -> Column:
    """``part / whole * 100`` rounded half up to ``digits`` decimals with
    integer arithmetic (exact, independent of floating-point rounding)."""
    scale = 10 ** digits
    num = part.cast("bigint") * (scale * 200) + whole.cast("bigint")
    den = whole.cast("bigint") * 2
    return F.when(whole > 0, ((num - F.pmod(num, den)) / den) / scale)


def column_missing(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Per column: missing count and percentage (optionally rounded), one pass."""
    cols = df.columns
    a = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(known(df, c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
    long = a.selectExpr("__n", "stack({}, {}) AS (column, missing)".format(
        len(cols), ", ".join(f"'{c}', m{i}" for i, c in enumerate(cols))))
    if digits is None:
        pct = F.try_divide(F.col("missing") * 100.0, F.col("__n"))
    else:
        pct = rounded_pct(F.col("missing"), F.col("__n"), digits)
    return long.select("column", F.col("missing").cast("bigint").alias("missing"), pct.alias("missing_pct"))


def profile_variables(readings: DataFrame, variable_col: str = "variable_name", value_col: str = "value") -> DataFrame:
    """Per variable, over its numeric values: count, mean, sample std, min, max."""
    v = to_number(_q(value_col))
    return readings.select(_q(variable_col).alias("variable"), v.alias("v")).where(F.col("v").isNotNull()) \
        .groupBy("variable").agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
                                 F.min("v").alias("min"), F.max("v").alias("max"))


def top_values(df: DataFrame, col: str, n: int | None = 10) -> DataFrame:
    """The ``n`` most frequent non-null values with count, percentage of all
    rows and rank (ties -> smaller value first).  A top-k report, exact, by
    bounded summaries and a recount of the candidates; with ``n=None`` every
    value is listed (ranked by a distributed global rank)."""
    total = df.select(F.count(F.lit(1))).scalar()
    if n is None:
        counts = value_counts(df, col)
        ranked = global_row_number(counts.withColumn("_neg", -F.col("count")), ["_neg", "value"], "_i")
        return ranked.select("value", "count", (F.col("count") * 100.0 / total).alias("pct"),
                             (F.col("_i") + 1).cast("bigint").alias("rank"))
    # at most n rows reach this window
    w = Window.orderBy(F.col("count").desc(), F.col("value"))
    top = frequent_values(df, col, n).orderBy(F.col("count").desc(), F.col("value")).limit(n)
    return top.select("value", "count", (F.col("count") * 100.0 / total).alias("pct"),
                      F.row_number().over(w).cast("bigint").alias("rank"))


def value_type_profile(readings: DataFrame, variable_col: str = "variable_name", value_col: str = "value",
                       samples: int = 3) -> DataFrame:
    """Variables holding non-numeric values: how many, and up to ``samples``
    distinct examples (smallest first)."""
    base = readings.select(_q(variable_col).alias("variable"), _q(value_col).alias("value"),
                           to_number(_q(value_col)).isNull().alias("non_numeric"))
    counts = base.groupBy("variable").agg(F.count_if("non_numeric").alias("non_numeric"),
                                          F.count(F.lit(1)).alias("total"))
    distinct = base.where("non_numeric").select("variable", "value").distinct()
    w = Window.partitionBy("variable").orderBy(F.col("value").asc_nulls_first())
    firsts = distinct.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= samples) \
        .groupBy("variable").agg(F.array_sort(F.collect_list(F.coalesce("value", F.lit("<null>")))).alias("samples"))
    return counts.where(F.col("non_numeric") > 0).join(firsts, "variable", "left") \
        .select("variable", "total", "non_numeric", F.concat_ws(", ", "samples").alias("samples"))


def machine_comparison(readings: DataFrame, machine_col: str = "machine_def", timestamp_col: str = "timestamp",
                       variable_col: str = "variable_name", value_col: str = "value") -> DataFrame:
    """Per machine: rows, variables, first/last day, whole days spanned and
    the share of numeric values."""
    ts = _parsed(readings, timestamp_col)
    a = readings.groupBy(_q(machine_col).alias("machine")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(_q(variable_col)).alias("variables"),
        F.min(ts).alias("ts_min"), F.max(ts).alias("ts_max"),
        F.count(to_number(_q(value_col))).alias("numeric_values"))
    span = F.unix_timestamp(F.col("ts_max").cast("timestamp")) - F.unix_timestamp(F.col("ts_min").cast("timestamp"))
    return a.select("machine", "rows", "variables",
                    F.to_date("ts_min").alias("first_date"), F.to_date("ts_max").alias("last_date"),
                    F.floor(span / 86400).cast("bigint").alias("days"),
                    (F.col("numeric_values") * 100.0 / F.col("rows")).alias("numeric_pct"))


def _kind(t) -> str:
    if isinstance(t, NumericType) and not isinstance(t, BooleanType):
        return "numeric"
    return "other"


def column_stats(df: DataFrame, top: int = 5, approx_distinct: bool = False) -> DataFrame:
    """Per column: type, then mean / std / min / max for numeric columns, or
    distinct count and the ``top`` most frequent values (``value:count``
    joined by ``|``, most frequent first) for all others.

    With ``approx_distinct`` the distinct counts are estimates of one sketch
    pass and the (still exact) top values come from bounded summaries, a pass
    for each column over that column, so no column's distinct values are shuffled."""
    num = [f.name for f in df.schema.fields if _kind(f.dataType) == "numeric"]
    oth = [f.name for f in df.schema.fields if _kind(f.dataType) != "numeric"]
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    frames = []
    if num:
        aggs = []
        for i, c in enumerate(num):
            x = known(df, c).cast("double")
            aggs += [F.avg(x).alias(f"a{i}"), F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"l{i}"),
                     F.max(x).alias(f"h{i}")]
        body = ", ".join(f"'{c}', '{types[c]}', a{i}, s{i}, l{i}, h{i}" for i, c in enumerate(num))
        frames.append(df.agg(*aggs).selectExpr(
            f"stack({len(num)}, {body}) AS (column, dtype, mean, std, min, max)")
            .withColumn("unique_count", F.lit(None).cast("bigint"))
            .withColumn("top_values", F.lit(None).cast("string")))
    if oth and approx_distinct:
        frames.append(_sketched_stats(df, oth, types, top))
    elif oth:
        # one shuffle for all non-numeric columns: (column, value) pairs
        pairs = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), _q(c).cast("string").alias("value")) for c in oth])).alias("p")) \
            .select("p.column", "p.value")
        counts = pairs.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        uniq = counts.groupBy("column").agg(F.count(F.lit(1)).alias("unique_count"))
        w = Window.partitionBy("column").orderBy(F.col("n").desc(), F.col("value"))
        tops = counts.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= top) \
            .groupBy("column").agg(F.array_sort(F.collect_list(F.struct("_r", "value", "n"))).alias("t")) \
            .select("column", F.concat_ws("|", F.transform("t", lambda s: F.concat(s["value"], F.lit(":"),
                                                                                 s["n"].cast("string"))))
                    .alias("top_values"))
        names = df.sparkSession.createDataFrame([(c, types[c]) for c in oth], "column string, dtype string")
        frames.append(names.join(uniq, "column", "left").join(tops, "column", "left").select(
            "column", "dtype", *[F.lit(None).cast("double").alias(x) for x in ("mean", "std", "min", "max")],
            F.coalesce("unique_count", F.lit(0)).cast("bigint").alias("unique_count"), "top_values"))
    return reduce(lambda a, b: a.unionByName(b), frames)


def _sketched_stats(df: DataFrame, columns: Sequence[str], types: dict, top: int) -> DataFrame:
    """The part of ``column_stats`` for columns that aren't numbers, without a shuffle of their values."""
    row = distinct_estimates(distinct_sketches(df, columns)).first()
    out = []
    for c in columns:
        text = df.select(_q(c).cast("string").alias("value"))
        best = frequent_values(text, "value", top).orderBy(F.desc("count"), "value").limit(top).collect()  # a top-k report
        out.append((c, types[c], row[f"{c}_distinct"], "|".join(f"{r['value']}:{r['count']}" for r in best)))
    names = df.sparkSession.createDataFrame(out, "column string, dtype string, unique_count bigint, top_values string")
    return names.select("column", "dtype", *[F.lit(None).cast("double").alias(x) for x in ("mean", "std", "min", "max")], "unique_count",
                        F.nullif("top_values", F.lit("")).alias("top_values"))


def cumulative_verdict(df: DataFrame, columns: Sequence[str] = ("shift_scrap", "actual_scrap_qty", "actual_qty"),
                       threshold: float = CUMULATIVE_AVERAGE) -> DataFrame:
    """For each present column: average, maximum and a verdict —
    ``cumulative`` when the average exceeds ``threshold`` (a running total
    rather than daily scrap), else ``daily``."""
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, average double, maximum double, verdict string")
    a = df.agg(*[F.avg(known(df, c)).alias(f"a{i}") for i, c in enumerate(cols)],
               *[F.max(known(df, c)).cast("double").alias(f"m{i}") for i, c in enumerate(cols)])
    body = ", ".join(f"'{c}', a{i}, m{i}" for i, c in enumerate(cols))
    out = a.selectExpr(f"stack({len(cols)}, {body}) AS (column, average, maximum)")
    return out.select("column", "average", "maximum",
                      F.when(F.col("average") > threshold, "cumulative").otherwise("daily").alias("verdict"))


def feature_columns(df: DataFrame, suffixes: Sequence[str] = FEATURE_SUFFIXES) -> list[str]:
    return [c for c in df.columns if any(p in c for p in suffixes)]


def dataset_summary(df: DataFrame, target: str = "actual_scrap_qty", machine_col: str = "machine_id",
                    date_col: str = "date_key", approx_distinct: float | None = None) -> DataFrame:
    """One row describing an ML dataset: size, target statistics (sample std,
    zero and positive counts), mean missing % over feature columns, rows with
    any / no feature value, distinct machines and dates (with
    ``approx_distinct``, a relative error, estimated without a shuffle of them)."""
    count_distinct = F.count_distinct if approx_distinct is None else lambda c: F.approx_count_distinct(c, approx_distinct)
    feats = feature_columns(df)
    t = known(df, target)
    n = F.count(F.lit(1))
    aggs = [n.alias("total_rows"), F.count(t).alias("target_count"), F.avg(t).alias("target_mean"),
            F.stddev_samp(t).alias("target_std"), F.min(t).cast("double").alias("target_min"),
            F.max(t).cast("double").alias("target_max"), F.count_if(t == 0).alias("target_zeros"),
            F.count_if(t > 0).alias("target_non_zeros")]
    if feats:
        missing = reduce(lambda a, b: a + b, [F.count_if(known(df, c).isNull()) for c in feats])
        aggs.append(F.try_divide(missing * 100.0, n * len(feats)).alias("feature_missing_pct"))
        anyf = F.coalesce(*[known(df, c).cast("string") for c in feats]).isNotNull()
        aggs += [F.count_if(anyf).alias("rows_with_features"), F.count_if(~anyf).alias("rows_without_features")]
    else:
        aggs += [F.lit(None).cast("double").alias("feature_missing_pct"), F.lit(0).cast("bigint").alias("rows_with_features"),
                 n.alias("rows_without_features")]
    aggs.append(count_distinct(_q(machine_col)).alias("unique_machines") if machine_col in df.columns
                else F.lit(0).cast("bigint").alias("unique_machines"))
    aggs.append(count_distinct(_q(date_col)).alias("unique_dates") if date_col in df.columns
                else F.lit(0).cast("bigint").alias("unique_dates"))
    return df.agg(*aggs).select(F.lit(len(df.columns)).alias("total_columns"), F.lit(len(feats)).alias("feature_columns"),
                                "*")


def feature_summary(df: DataFrame) -> DataFrame:
    """Per column of an aggregated feature table: its feature kind (suffix)
    and missing percentage rounded to 2 decimals, plus table-level counts
    repeated on every row (rows, columns, features of each kind)."""
    kinds = ("mean", "max", "std", "count", "mode", "delta")
    miss = column_missing(df, digits=2)
    kind = F.lit(None).cast("string")
    for k in reversed(kinds):
        kind = F.when(F.col("column").endswith(f"_{k}"), k).otherwise(kind)
    out = miss.select("column", kind.alias("kind"), "missing_pct")
    counts = {f"{k}_features": len([c for c in df.columns if c.endswith(f"_{k}")]) for k in kinds}
    rows = df.select(F.count(F.lit(1))).scalar()
    return out.select("*", rows.alias("rows"), F.lit(len(df.columns)).alias("columns"),
                      *[F.lit(v).alias(k) for k, v in counts.items()])


def feature_ranges(df: DataFrame) -> DataFrame:
    """Min and max of every numeric feature column, labelled with its kind."""
    kinds = ("mean", "max", "std", "count", "delta", "first", "last")
    cols = [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and any(f.name.endswith(f"_{k}") for k in kinds)]
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, kind string, min double, max double")
    a = df.agg(*[F.min(known(df, c)).cast("double").alias(f"l{i}") for i, c in enumerate(cols)],
               *[F.max(known(df, c)).cast("double").alias(f"h{i}") for i, c in enumerate(cols)])
    body = ", ".join(f"'{c}', '{c.rsplit('_', 1)[1]}', l{i}, h{i}" for i, c in enumerate(cols))
    return a.selectExpr(f"stack({len(cols)}, {body}) AS (column, kind, min, max)")
