"""Long -> wide feature aggregation (the core of the sensor pipeline).

All wide tables are built with ONE ``groupBy`` and conditional aggregates
(``agg(when(variable = x, v))``), never with one pivot per statistic followed
by joins: a single hash aggregate with map-side partial aggregation, one
shuffle on the group keys, and a fixed output schema once the variable list
is known.  A hot group (one machine-day holding a large share of the rows) is
collapsed by the partial aggregate before the shuffle, so it cannot skew the
reduce side.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from moldwise.functions.columns import (
    classify_names,
    classify_variable,
    duration_seconds,
    known,
    machine_key,
    or_fail,
    parse_date,
    parse_date_monthfirst,
    present_text,
    to_number,
)

STATS = {
    "mean": F.avg,
    "max": F.max,
    "min": F.min,
    "std": F.stddev_samp,
    # a group without readings of a variable has no statistics at all:
    # its count is NULL, not 0 (a per-variable pivot leaves the cell empty)
    "count": lambda c: F.nullif(F.count(c), F.lit(0)),
    "sum": F.sum,
}


def _q(name: str) -> Column:
    """A column by its literal name (variable names may hold dots or blanks)."""
    return F.col("`" + name.replace("`", "``") + "`")


def discover_values(df: DataFrame, col: str, limit: int | None = None) -> list:
    """Sorted distinct non-null values of a column that is to become column names.

    One distributed ``distinct`` job; the result is as large as the schema that
    it makes.  A ``limit`` fails loudly beyond it.  For variable sets too wide
    for a schema use ``long_features``.
    """
    vals = df.select(col).where(F.col(col).isNotNull()).distinct()
    got = [r[0] for r in (vals if limit is None else vals.limit(limit + 1)).collect()]
    if limit is not None and len(got) > limit:
        raise ValueError(f"column {col!r} has more than {limit} distinct values; pass an explicit list")
    return sorted(got)


def _parsed_ts(df: DataFrame, timestamp_col: str) -> Column:
    dt = df.schema[timestamp_col].dataType
    c = F.col(timestamp_col)
    if isinstance(dt, StringType):
        return F.try_to_timestamp(c)
    return c


def prepare_readings(readings: DataFrame, machine_col: str = "machine_def", timestamp_col: str = "timestamp",
                     variable_col: str = "variable_name", value_col: str = "value",
                     drop_zero_variance: bool = True) -> DataFrame:
    """Parse time, derive ``agg_date``/``hour``, classify variables and coerce values.

    Durations become seconds; categorical values keep their text; everything
    else goes through the safe number parse.  Rows with an unparseable
    timestamp or a NULL machine are dropped (they cannot form a group).
    """
    ts = _parsed_ts(readings, timestamp_col)
    cls = classify_variable(F.col(variable_col))
    out = readings.select(
        F.col(machine_col), F.col(variable_col), F.col(value_col),
        ts.alias("timestamp_parsed"),
    ).withColumn("var_class", cls)
    out = out.withColumn("agg_date", F.date_format("timestamp_parsed", "yyyy-MM-dd")) \
             .withColumn("hour", F.hour("timestamp_parsed"))
    vn = (F.when(F.col("var_class") == "time_duration", duration_seconds(value_col))
           .when(F.col("var_class") == "categorical", F.lit(None).cast("double"))
           .otherwise(to_number(value_col)))
    out = out.withColumn("value_numeric", vn)
    if drop_zero_variance:
        out = out.where(F.col("var_class") != "excluded")
    return out


def daily_features(readings: DataFrame, machine_col: str = "machine_def", timestamp_col: str = "timestamp",
                   variable_col: str = "variable_name", value_col: str = "value", by_date: bool = True,
                   numeric: Sequence[str] = ("mean", "max", "std", "count"), drop_zero_variance: bool = True,
                   variables: Iterable[str] | None = None, split_blocks: bool = False) -> DataFrame:
    """Wide daily features per (machine, day) from long readings.

    * numeric and duration variables -> ``{var}_{stat}`` for ``numeric`` stats
      (sample std, NULL for a single reading);
    * categorical variables -> ``{var}_mode`` (most frequent text, smallest on ties);
    * counters -> ``{var}_first``, ``_last`` (time order, value as tie-break),
      ``_delta`` = last - first, ``_count``.
    Excluded (zero-variance) variables never produce columns.

    A variable without readings in a group gets NULL statistics (count too).

    ``variables`` fixes the output schema; when omitted one small ``distinct``
    job finds the variables that have at least one usable value.
    By default one aggregate with one exchange reads the input once.
    ``split_blocks`` aggregates each variable class separately (see below):
    faster aggregation, but every block scans the input again, so use it
    only for a cached input or one clustered by variable.
    Output is not sorted (sort only at the final sink if needed).
    """
    p = prepare_readings(readings, machine_col, timestamp_col, variable_col, value_col, drop_zero_variance)
    keys = [machine_col] + (["agg_date"] if by_date else [])
    usable = (F.col("var_class") == "categorical") | F.col("value_numeric").isNotNull()
    p = p.where(usable & (F.col("var_class") != "excluded"))
    for k in keys:
        p = p.where(F.col(k).isNotNull())
    if variables is None:
        names = discover_values(p, variable_col)
    else:
        names = sorted(set(variables))
        p = p.where(F.col(variable_col).isin(names))
    aggs, cols = feature_aggregates(names, variable_col, value_col, numeric)
    if not aggs:
        return p.select(*keys).distinct()
    blocks = _class_blocks(names) if split_blocks else [names]
    if len(blocks) <= 1:
        wide = p.groupBy(*keys).agg(*aggs)
        return wide.select(*[F.col(k) for k in keys], *cols)
    # One aggregate per variable class.  Numeric statistics have fixed-width
    # buffers and run as a hash aggregate; only the rows of the status (mode)
    # and counter (ordered first/last) variables go through the sort-based
    # aggregate.  Blocks partition the rows, so the shuffled volume is the
    # same as for a single aggregate; the joins see one row per key and block.
    out = None
    for block in blocks:
        b_aggs, b_cols = feature_aggregates(block, variable_col, value_col, numeric)
        part = p.where(F.col(variable_col).isin(block)).groupBy(*keys).agg(*b_aggs) \
                .select(*[F.col(k) for k in keys], *b_cols)
        out = part if out is None else out.join(part, keys, "full")
    return out.select(*[F.col(k) for k in keys],
                      *[F.col(f"`{c}`") for c in feature_names(names, numeric)])


def _class_blocks(names: Sequence[str]) -> list[list[str]]:
    """Variable names grouped by aggregate kind: numeric + durations, status
    (mode), counters; empty groups left out."""
    cls = classify_names(names)
    groups = [sorted(cls["numeric"] + cls["time_duration"]), sorted(cls["categorical"]), sorted(cls["counters"])]
    return [g for g in groups if g]


def feature_names(names: Sequence[str], numeric: Sequence[str]) -> list[str]:
    """Columns of the wide table of some variables, in order."""
    cls = classify_names(names)
    num_vars = sorted(cls["numeric"] + cls["time_duration"])
    out = [f"{v}_{s}" for s in numeric for v in num_vars]
    out += [f"{v}_mode" for v in sorted(cls["categorical"])]
    out += [f"{v}_{s}" for s in ("first", "last", "delta", "count") for v in sorted(cls["counters"])]
    return out


def feature_aggregates(names: Sequence[str], variable_col: str = "variable_name", value_col: str = "value",
                       numeric: Sequence[str] = ("mean", "max", "std", "count")) -> tuple[list, list]:
    """Conditional aggregates for every variable (by class) and the final
    column list (numeric block, modes, counters first/last/delta/count).

    Expects the columns of ``prepare_readings`` (``value_numeric``,
    ``timestamp_parsed``); shared by the batch and the streaming form.
    """
    cls = classify_names(names)
    num_vars = sorted(cls["numeric"] + cls["time_duration"])
    cat_vars = sorted(cls["categorical"])
    cnt_vars = sorted(cls["counters"])
    var = F.col(variable_col)
    vn = F.col("value_numeric")
    aggs = []
    for stat in numeric:
        fn = STATS[stat]
        for v in num_vars:
            aggs.append(fn(F.when(var == v, vn)).alias(f"{v}_{stat}"))
    for v in cat_vars:
        aggs.append(F.mode(F.when(var == v, F.col(value_col)), True).alias(f"{v}_mode"))
    order = F.struct(F.col("timestamp_parsed"), vn)
    for v in cnt_vars:
        hit = (var == v) & vn.isNotNull()
        aggs.append(F.min_by(F.when(hit, vn), F.when(hit, order)).alias(f"{v}_first"))
        aggs.append(F.max_by(F.when(hit, vn), F.when(hit, order)).alias(f"{v}_last"))
        aggs.append(F.nullif(F.count(F.when(hit, vn)), F.lit(0)).alias(f"{v}_count"))
    cols = [_q(f"{v}_{s}") for s in numeric for v in num_vars]
    cols += [_q(f"{v}_mode") for v in cat_vars]
    for stat in ("first", "last", "delta", "count"):
        for v in cnt_vars:
            if stat == "delta":
                cols.append((_q(f"{v}_last") - _q(f"{v}_first")).alias(f"{v}_delta"))
            else:
                cols.append(_q(f"{v}_{stat}"))
    return aggs, cols


def wide_numeric(readings: DataFrame, keys: Sequence[str], variable_col: str, value_col: str,
                 stats: Sequence[str], variables: Iterable[str] | None = None, present: Sequence[str] = ()) -> DataFrame:
    """Generic long->wide numeric statistics ``{var}_{stat}``, stat-major column order.

    Rows whose value is not a number are dropped, and rows with a NULL key
    (``present`` keys have none, which saves computing them twice).
    """
    p = readings.select(*keys, variable_col, to_number(value_col).alias("_v")).where(F.col("_v").isNotNull())
    for k in keys:
        if k not in present:
            p = p.where(F.col(k).isNotNull())
    names = discover_values(p, variable_col) if variables is None else sorted(set(variables))
    if variables is not None:
        p = p.where(F.col(variable_col).isin(names))
    var = F.col(variable_col)
    aggs = [STATS[s](F.when(var == v, F.col("_v"))).alias(f"{v}_{s}") for s in stats for v in names]
    return p.groupBy(*keys).agg(*aggs)


def long_features(readings: DataFrame, machine_col: str = "machine_def", timestamp_col: str = "timestamp",
                  variable_col: str = "variable_name", value_col: str = "value") -> DataFrame:
    """Daily statistics with one row per (machine, day, variable): the form
    for variable sets of any width, without a list of variables.

    ``mean``, ``max``, ``std`` and ``count`` of the numbers; ``first``, ``last``
    and ``delta`` for counters; ``mode`` for status texts (counted per text
    first, so no buffer grows with the number of texts).
    """
    p = prepare_readings(readings, machine_col, timestamp_col, variable_col, value_col)
    keys = [machine_col, "agg_date", variable_col]
    for k in keys:
        p = p.where(F.col(k).isNotNull())
    vn, counter = F.col("value_numeric"), F.col("var_class") == "counters"
    order = F.when(counter & vn.isNotNull(), F.struct("timestamp_parsed", vn))
    numbers = p.where(vn.isNotNull()).groupBy(*keys).agg(
        F.avg(vn).alias("mean"), F.max(vn).alias("max"), F.stddev_samp(vn).alias("std"), F.count(vn).alias("count"),
        F.min(order)["value_numeric"].alias("first"), F.max(order)["value_numeric"].alias("last"))
    numbers = numbers.withColumn("delta", F.col("last") - F.col("first")).withColumn("mode", F.lit(None).cast("string"))
    texts = p.where((F.col("var_class") == "categorical") & F.col(value_col).isNotNull()).groupBy(*keys, value_col).agg(F.count("*").alias("n"))
    modes = texts.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(value_col).alias("v")))["v"].alias("mode"))
    return numbers.unionByName(modes, allowMissingColumns=True)


def _dated(df: DataFrame, date_col: str, date_format: str | None, strict: bool) -> tuple[DataFrame, Column, bool]:
    """Rows, their date (by one format, or ISO and month-first texts), and whether every row is known to have one.

    Strict dates fail the job where a text is no date, so rows without a text
    are left out before they are parsed and the rest needs no second look.
    """
    c = F.col(date_col)
    if not isinstance(df.schema[date_col].dataType, StringType):
        return df, F.to_date(c), False
    parsed = parse_date(c, date_format) if date_format else parse_date_monthfirst(c)
    if not strict:
        return df, parsed, False
    return df.where(present_text(c).isNotNull()), or_fail(parsed, c, date_col), True


def vertical_features(readings: DataFrame, date_col: str = "date", machine_col: str = "machine_definition",
                      variable_col: str = "variable_name", value_col: str = "value", date_format: str | None = None,
                      stats: Sequence[str] = ("mean", "std", "min", "max"),
                      variables: Iterable[str] | None = None, strict_dates: bool = True) -> DataFrame:
    """Per (machine, date) statistics of every numeric variable, vertical layout.

    The machine is the row's own id normalised to ``M###`` (three digits),
    so all machine files are handled in one pass.  Dates are ISO or
    month-first texts, or follow ``date_format``; one that does not parse
    fails the job, or with ``strict_dates=False`` leaves its rows out.
    """
    rows, date, whole = _dated(readings, date_col, date_format, strict_dates)
    p = rows.select(machine_key(F.col(machine_col), "digits3").alias("machine_id"), date.alias("date"), F.col(variable_col), F.col(value_col))
    return wide_numeric(p, ["machine_id", "date"], variable_col, value_col, stats, variables, ["date"] if whole else ())


def sensor_means(readings: DataFrame, date_col: str = "date", machine_col: str = "machine_definition",
                 variable_col: str = "variable_name", value_col: str = "value", date_format: str | None = None,
                 variables: Iterable[str] | None = None, strict_dates: bool = True) -> DataFrame:
    """Daily mean of each sensor per (date, machine_id), columns named by variable.

    Machine ids are rewritten ``M231-11`` -> ``M-231`` to meet the scrap table.
    Dates as in ``vertical_features``.
    """
    rows, date, whole = _dated(readings, date_col, date_format, strict_dates)
    p = rows.select(date.alias("date"), machine_key(F.col(machine_col), "hyphen").alias("machine_id"), F.col(variable_col), F.col(value_col))
    wide = wide_numeric(p, ["date", "machine_id"], variable_col, value_col, ["mean"], variables, ["date"] if whole else ())
    return wide.select("date", "machine_id", *[_q(c).alias(c[: -len("_mean")]) for c in wide.columns[2:]])


# Raw production column -> daily scrap column.
DAILY_RENAME = {"machine_nr": "machine_id", "tool_number": "tool_id", "article": "part_number",
                "actual_scrap_qty": "scrap_quantity"}
DAILY_KEYS = ("date", "machine_id", "tool_id", "part_number")


def daily_scrap(raw: DataFrame, rename: dict | None = None, keys: Sequence[str] = DAILY_KEYS,
                value: str = "scrap_quantity", strict_dates: bool = True) -> DataFrame:
    """Daily scrap per (date, machine, tool, part): the MAX of the raw rows.

    The raw total repeats on every row of a day, so summing would multiply it.
    Rows with a NULL key are dropped (a group needs a key); NaN is a missing
    value; dates as in ``vertical_features``.
    """
    mapping = {k: v for k, v in (rename or DAILY_RENAME).items() if k in raw.columns}
    df = raw.withColumnsRenamed(mapping)
    df, date, whole = _dated(df, "date", None, strict_dates)
    df = df.withColumn("date", date)
    for k in keys:
        if k != "date" or not whole:
            df = df.where(F.col(k).isNotNull())
    return df.groupBy(*keys).agg(F.max(known(df, value)).alias(value))
