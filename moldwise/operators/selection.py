"""Feature selection, numeric coercion, imputation and target labelling.

Selection walks the schema on the driver (no data is read).  Coercion and
imputation are single aggregate passes over all columns at once; the median
is exact and computed with the distributed rank selection of
``moldwise.operators.quantiles`` (Spark's exact ``percentile`` would keep
every distinct value of a column in one task's buffer).
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, DoubleType, FloatType, NumericType, StringType,
                               TimestampNTZType, TimestampType)

from moldwise.functions.columns import clean_column_name, known, to_number
from moldwise.operators.quantiles import Sketch, quantiles_multi, sketch_quantiles
from moldwise.session import stored

# Columns never used as model features by the baseline
# regressor (target and leakage columns, post-hoc values, identifiers, raw
# production fields and categorical columns).
BASELINE_EXCLUDE = [
    "actual_scrap_qty", "shift_scrap", "actual_qty", "target_qty", "shift_qty",
    "Scrap_counter_first", "Scrap_counter_last", "Scrap_counter_delta", "Scrap_counter_mean",
    "Scrap_counter_max", "Scrap_counter_std", "Scrap_counter_count",
    "rest_duration", "actual_cycle_time_per_1000", "shift_production_time", "remaining_runtime",
    "machine_id", "machine_key", "date_key", "agg_date", "machine_def",
    "datetime_last_load", "local_datetime_last_load", "machine_nr", "machine_group_nr", "order_operation",
    "article", "article_description", "tool_number", "order_planned_start", "order_start",
    "order_planned_stop", "order_stop", "actual_order_start", "shift_start_date", "shift_stop_date",
    "stoer_text", "parts_produced_last_updated", "scrap_reason_codes", "local_time_zone", "date", "year",
    "month",
    "Machine_status_mode", "actual_machine_status", "regrind_flag",
]

# Case-insensitive words that drop a column from the risk
# classifier's features.
RISK_FORBIDDEN_WORDS = ["scrap", "risk", "qty", "duration", "runtime", "counter", "production"]

# Columns and case-sensitive substrings dropped by the final
# risk model, its cross-validation and the model comparison.
FINAL_FORBIDDEN = ["target", "actual_scrap_qty", "actual_qty", "machine_id", "date", "order_start", "order_stop",
                   "shift_production_time", "shift_scrap"]
FINAL_FORBIDDEN_SUBSTRINGS = ["actual", "shift"]

# Columns ignored by the sensor model (besides the target).
SENSOR_IGNORE = ["date", "machine_id", "tool_id", "part_number", "scrap_quantity", "machine_definition"]


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _numeric(t) -> bool:
    return isinstance(t, NumericType) and not isinstance(t, BooleanType)


def standardize_columns(df: DataFrame, lower: bool = False) -> DataFrame:
    """Strip surrounding whitespace from column names (optionally also
    lower-case them and turn inner spaces into underscores)."""
    return df.toDF(*[clean_column_name(c, lower) for c in df.columns])


def select_features(df: DataFrame, exclude: Iterable[str] | None = None,
                    forbidden_words: Iterable[str] | None = None, drop_substrings: Iterable[str] | None = None,
                    ignore: Iterable[str] | None = None, first: str | None = None, numeric_only: bool = True,
                    sort: bool = True) -> list[str]:
    """Feature column names from the schema.

    * ``exclude``: exact names removed;
    * ``forbidden_words``: removed when the lower-cased name contains a word;
    * ``drop_substrings``: removed when the name contains one (case-sensitive);
    * ``ignore``: exact names removed, schema order kept;
    * ``numeric_only``: keep numeric (non-boolean) columns;
    * ``first``: put this column first when present; ``sort``: sort by name.
    """
    ex = set(exclude or []) | set(ignore or [])
    words = [w.lower() for w in (forbidden_words or [])]
    subs = list(drop_substrings or [])
    out = []
    for f in df.schema.fields:
        n = f.name
        if n in ex or any(w in n.lower() for w in words) or any(s in n for s in subs):
            continue
        if numeric_only and not _numeric(f.dataType):
            continue
        out.append(n)
    if sort:
        out = sorted(out)
    if first and first in out:
        out = [first] + [c for c in out if c != first]
    return out


def baseline_features(df: DataFrame) -> list[str]:
    """Numeric columns minus the baseline exclusion list, sorted."""
    return select_features(df, exclude=BASELINE_EXCLUDE)


def risk_features(df: DataFrame) -> list[str]:
    """Numeric columns without a forbidden word, minus ``date``."""
    return [c for c in select_features(df, forbidden_words=RISK_FORBIDDEN_WORDS, sort=False) if c != "date"]


def _as_number(df: DataFrame, name: str) -> Column:
    t = df.schema[name].dataType
    c = _q(name)
    if _numeric(t):
        return c.cast("double")
    if isinstance(t, (TimestampType, TimestampNTZType)):
        # epoch nanoseconds, the integer form of a datetime
        return (F.unix_micros(c.cast("timestamp")) * 1000).cast("double")
    if isinstance(t, DateType):
        return (F.unix_micros(c.cast("timestamp")) * 1000).cast("double")
    if isinstance(t, StringType):
        return to_number(c)
    return to_number(c.cast("string"))


def coerce_numeric_frame(df: DataFrame, columns: Sequence[str] | None = None, fill: float = 0.0,
                         keep: Sequence[str] = ()) -> DataFrame:
    """Every column becomes a double (text through the safe number parse,
    datetimes as epoch nanoseconds); columns with no value left are dropped;
    remaining NULLs become ``fill``.  Boolean columns are not numbers and are
    dropped.  ``keep`` columns pass through untouched.  One aggregate pass
    decides which columns survive."""
    cols = [c for c in (columns if columns is not None else df.columns)
            if c not in keep and not isinstance(df.schema[c].dataType, BooleanType)]
    conv = df.select(*[_q(k) for k in keep], *[_as_number(df, c).alias(c) for c in cols])
    counts = conv.agg(*[F.count(_q(c)).alias(f"n{i}") for i, c in enumerate(cols)]).first() if cols else None
    alive = [c for i, c in enumerate(cols) if counts[f"n{i}"] > 0]
    out = conv.select(*[_q(k) for k in keep], *[_q(c) for c in alive])
    return out.na.fill(fill, subset=alive) if alive else out


def final_model_frame(df: DataFrame, target: str = "target") -> DataFrame:
    """Feature frame of the final risk model: forbidden names and names with
    ``actual``/``shift`` dropped, the rest coerced to numbers, filled with 0;
    the target column is kept."""
    feats = [c for c in df.columns if c not in FINAL_FORBIDDEN and not any(s in c for s in FINAL_FORBIDDEN_SUBSTRINGS)]
    return coerce_numeric_frame(df.select(*[_q(c) for c in feats + [target]]), feats, keep=[target])


def column_medians(df: DataFrame, columns: Sequence[str], exact: bool = True, sketch: Sketch | None = None) -> dict:
    """Exact (linearly interpolated) median of each column, or approximate
    with ``exact=False``; columns without values are left out.  ``sketch``
    (the first pass, see ``sketch_quantiles``) saves that pass."""
    q = quantiles_multi(df, columns, [0.5], exact, sketch)
    return {c: v[0] for c, v in q.items() if v[0] is not None}


def fill_median(df: DataFrame, columns: Sequence[str], exact: bool = True, materialize: bool = True) -> DataFrame:
    """Fill missing values (NULL or NaN) of ``columns`` with each column's
    exact median, but only when any of them has a missing value; all-missing
    columns stay NULL.  One pass gives row and value counts and the medians'
    brackets, a second one the medians of the columns with gaps; both read a
    stored copy of the columns, so they see the same values (``materialize=False``
    for a frame that is stored already)."""
    if not columns:
        return df
    values = stored(df.select(*[_q(c) for c in columns])) if materialize else df
    sketch = sketch_quantiles(values, columns, [0.5])
    gaps = [c for c in columns if sketch.counts[c] < sketch.rows]
    if not gaps:
        return df
    med = column_medians(values, gaps, exact, sketch)
    # a filled integer column becomes double (a median can fall between values)
    df = df.withColumns({c: _q(c).cast("double") for c in med if not isinstance(
        df.schema[c].dataType, (DoubleType, FloatType))})
    return df.na.fill(med) if med else df


def high_risk_threshold(df: DataFrame, column: str = "actual_scrap_qty", q: float = 0.75,
                        exact: bool = True) -> float | None:
    return quantiles_multi(df, [column], [q], exact)[column][0]


def label_high_risk(df: DataFrame, column: str = "actual_scrap_qty", q: float = 0.75,
                    out: str = "high_scrap_risk", exact: bool = True) -> DataFrame:
    """1 when the value is strictly above the column's ``q`` quantile, else
    0 (a NULL or NaN value counts as 0)."""
    t = high_risk_threshold(df, column, q, exact)
    if t is None:
        return df.withColumn(out, F.lit(0))
    return df.withColumn(out, F.coalesce((known(df, column) > F.lit(t)).cast("int"), F.lit(0)))
