"""Time-series operators on the daily scrap panel.

The panel has one row per (date, machine, tool, part) after ``daily_scrap``,
so a window partitioned by the job key holds at most one row per calendar
day: window partitions are bounded by the date range, not by data volume,
even when one job dominates the raw rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from moldwise.functions.columns import risk_status
from moldwise.operators.ranking import dense_codes_multi, global_row_number, join_codes
from moldwise.session import reliable_checkpoint, stored

JOB_KEYS = ("machine_id", "tool_id", "part_number")


def lag_features(daily: DataFrame, keys: Sequence[str] = JOB_KEYS, date: str = "date",
                 value: str = "scrap_quantity", lags: Sequence[int] = (1, 2), window: int = 3,
                 include_current: bool = True, drop_incomplete: bool = True) -> DataFrame:
    """Previous-row lags and a rolling mean per job, ordered by date.

    ``scrap_lag_k`` is the value k rows earlier (rows, not calendar days).
    ``rolling_avg_{window}`` is the mean of the last ``window`` rows, NULL
    unless all of them hold a value.  With ``include_current`` (the default,
    as in the original training code) the frame ends at the current row; set
    it to False for a frame of the ``window`` rows before it.
    ``drop_incomplete`` removes rows with any NULL (warm-up rows).
    """
    w = Window.partitionBy(*keys).orderBy(date)
    frame = w.rowsBetween(-(window - 1), 0) if include_current else w.rowsBetween(-window, -1)
    v = F.col(value)
    out = daily
    for k in lags:
        out = out.withColumn(f"scrap_lag_{k}", F.lag(v, k).over(w))
    out = out.withColumn(f"rolling_avg_{window}",
                         F.when(F.count(v).over(frame) == window, F.avg(v).over(frame)))
    if drop_incomplete:
        out = out.na.drop()
    return out


def label_encode(df: DataFrame, cols: dict, unseen: int | None = None, codes_from: DataFrame | None = None) -> DataFrame:
    """Add integer codes: ``{col: out_col}``; code = rank of the value among the
    sorted distinct values of ``codes_from`` (default: ``df`` itself).

    Values absent from ``codes_from`` get ``unseen`` (NULL by default; the
    monitoring view uses 0).  Code tables hold one row per distinct label.
    """
    src = codes_from if codes_from is not None else df
    tables = dense_codes_multi(src, cols)
    out = df
    for c, o in cols.items():
        codes = tables[c]
        out = join_codes(out, c, codes._replace(table=codes.table.withColumn(o, F.col(o).cast("int"))))
        if unseen is not None:
            out = out.withColumn(o, F.coalesce(F.col(o), F.lit(unseen)))
    return out


def encode_jobs(df: DataFrame, codes_from: DataFrame | None = None, unseen: int | None = None) -> DataFrame:
    return label_encode(df, {"machine_id": "machine_code", "tool_id": "tool_code", "part_number": "part_code"},
                        unseen, codes_from)


def forecast_features(daily: DataFrame, include_current: bool = True) -> DataFrame:
    """Lag features + job codes: the training table of the forecaster."""
    clean = lag_features(daily, include_current=include_current)
    return encode_jobs(clean)


def time_split(df: DataFrame, date: str = "date", train_fraction: float = 0.8, out: str = "split") -> DataFrame:
    """Label rows ``train`` / ``test`` by a cut date.

    The cut is the distinct date at index ``int(n * train_fraction)`` (at
    least 1) in ascending order; rows before it train, rows on or after it
    test.  With a single distinct date every row is ``train``.
    """
    days = df.select(date).where(F.col(date).isNotNull()).distinct()
    if isinstance(df.schema[date].dataType, DateType):
        # a list of days is as long as the calendar at most: one task ranks it
        ranked = days.select(date, (F.row_number().over(Window.orderBy(date)) - 1).alias("_i"), F.count(F.lit(1)).over(Window.partitionBy()).alias("_n"))
        k = F.greatest(F.floor(F.col("_n") * train_fraction), F.lit(1))
        row = ranked.where(F.col("_i") == k).select(date).first()
        cut = row and row[0]
    else:
        ranked = reliable_checkpoint(global_row_number(days, [date], "_i"))
        n = ranked.count()
        k = max(int(n * train_fraction), 1)
        cut = ranked.where(F.col("_i") == k).select(date).first()[0] if k < n else None
    if cut is None:
        return df.withColumn(out, F.lit("train"))
    c = F.col(date)
    return df.withColumn(out, F.when(c < F.lit(cut), "train").when(c >= F.lit(cut), "test"))


def scoring_context(daily: DataFrame, keys: Sequence[str] = JOB_KEYS, date: str = "date",
                    value: str = "scrap_quantity", min_history: int = 3) -> DataFrame:
    """Latest history per job, for every job with at least ``min_history`` rows.

    ``scrap_lag_1`` = last value, ``scrap_lag_2`` = the one before,
    ``rolling_avg_3`` = mean of the last three, ``last_date``, and
    ``forecast_date`` = last date + 1 day.
    """
    keep = max(3, min_history)
    w = Window.partitionBy(*keys).orderBy(F.col(date).desc())
    # row_number() <= keep becomes a per-partition limit before the shuffle
    ranked = daily.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= keep)
    v, rn = F.col(value), F.col("_rn")
    ctx = ranked.groupBy(*keys).agg(
        F.max(F.when(rn == 1, v)).alias("scrap_lag_1"),
        F.max(F.when(rn == 2, v)).alias("scrap_lag_2"),
        F.avg(F.when(rn <= 3, v)).alias("rolling_avg_3"),
        F.max(F.when(rn == 1, F.col(date))).alias("last_date"),
        F.count(F.lit(1)).alias("_n"),
    )
    return ctx.where(F.col("_n") >= min_history).drop("_n") \
              .withColumn("forecast_date", F.date_add("last_date", 1))


def most_active_job(daily: DataFrame, keys: Sequence[str] = JOB_KEYS) -> DataFrame:
    """The job with the most rows (ties -> smallest key); a top-1 report."""
    return daily.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")) \
                .orderBy(F.col("rows").desc(), *[F.col(k) for k in keys]).limit(1)


def planning_kpis(daily: DataFrame, keys: Sequence[str] = JOB_KEYS, value: str = "scrap_quantity") -> DataFrame:
    """Per job: mean daily scrap (24 h), half of it (12 h shift), worst day, days."""
    return daily.groupBy(*keys).agg(
        F.avg(value).alias("avg_scrap_24h"),
        (F.avg(value) / 2).alias("avg_scrap_12h"),
        F.max(value).alias("max_scrap"),
        F.count(value).alias("days"),
    )


def job_combinations(daily: DataFrame, keys: Sequence[str] = JOB_KEYS) -> DataFrame:
    """Distinct (machine, tool, part) combinations with non-null parts."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return daily.select(*keys).where(cond).distinct()


def with_risk_status(df: DataFrame, prediction: str = "prediction", threshold: float = 100.0,
                     out: str = "status") -> DataFrame:
    return df.withColumn(out, risk_status(F.col(prediction), threshold))


def forecast_split(daily: DataFrame, train_fraction: float = 0.8, include_current: bool = True,
                   out: str = "split") -> DataFrame:
    """``time_split(forecast_features(daily))`` with the lag table computed once."""
    clean = stored(lag_features(daily, include_current=include_current))
    return time_split(encode_jobs(clean), out=out, train_fraction=train_fraction)
