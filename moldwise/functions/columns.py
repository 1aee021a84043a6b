"""Scalar column expressions (all JVM-side, no Python UDFs).

Each function takes and returns a ``Column`` so it can be used inside any
projection and stays within whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's variable lists -------------
# Variables that never change on the machines profiled (dropped before aggregation).
ZERO_VARIANCE_VARIABLES = ["Cyl_tmp_z2", "Cyl_tmp_z6", "Cyl_tmp_z7", "Switch_position"]
# Variables needing special handling: duration strings and status codes.
SPECIAL_VARIABLES = {"Time_on_machine": "time_duration", "Machine_status": "categorical"}
# Cumulative counters: summarised by first / last / delta / count.
COUNTER_VARIABLES = ["Shot_counter", "Scrap_counter"]
# ------------------------------------------------------------------------------

VARIABLE_CLASSES = ("numeric", "time_duration", "categorical", "counters", "excluded")

# A plain decimal / scientific number, or inf/infinity, with optional sign.
# Spark's cast also accepts suffixes such as ``1.0d`` and ``5f``; a number
# parser for raw sensor strings must not, so casts are guarded by this pattern.
NUMBER_PATTERN = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c) -> Column:
    """Safe numeric parse: non-numbers, blanks and NaN become NULL."""
    s = F.trim(_col(c).cast("string"))
    x = F.when(s.rlike(NUMBER_PATTERN), s.try_cast("double"))
    return F.when(~F.isnan(x), x)


def known(df, name: str) -> Column:
    """A column with NaN as NULL: NaN is a missing number everywhere."""
    c = F.col("`" + name.replace("`", "``") + "`")
    return F.nanvl(c, F.lit(None)) if df.schema[name].dataType.typeName() in ("double", "float") else c


# Texts that stand for a missing value in delimited files (the
# public defaults of pandas.read_csv).
MISSING_TEXTS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
                 "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def present_text(c) -> Column:
    """A text, or NULL where it only marks a missing value."""
    c = _col(c)
    return F.when(~F.trim(c).isin(MISSING_TEXTS), c)


def or_fail(parsed: Column, c, what: str) -> Column:
    """``parsed``; where it is NULL although the source isn't, the job fails
    and names the value (no extra pass over the data)."""
    text = _col(c).cast("string")
    return F.coalesce(parsed, F.when(text.isNotNull(), F.raise_error(F.concat(F.lit(f"{what}: cannot parse '"), text, F.lit("'")))))


def duration_seconds(c) -> Column:
    """``H:M:S`` or ``M:S`` (decimals allowed, surrounding blanks trimmed) -> seconds.

    Anything else (one part, four parts, a non-numeric part) -> NULL.
    Example: ``"02:43:19"`` -> 9799.0, ``"00:01:30"`` -> 90.0.
    """
    parts = F.split(F.trim(_col(c).cast("string")), ":")
    n = F.size(parts)

    def part(i):
        p = F.trim(parts.getItem(i))
        return F.when(p.rlike(NUMBER_PATTERN), p.try_cast("double"))

    return (F.when(n == 3, part(0) * 3600 + part(1) * 60 + part(2))
             .when(n == 2, part(0) * 60 + part(1)))


def classify_variable(c) -> Column:
    """Class of a variable name; the first matching rule wins.

    excluded -> time_duration / categorical -> counters -> numeric.
    """
    v = _col(c)
    expr = F.when(v.isin(ZERO_VARIANCE_VARIABLES), F.lit("excluded"))
    for name, kind in SPECIAL_VARIABLES.items():
        expr = expr.when(v == name, F.lit(kind))
    return expr.when(v.isin(COUNTER_VARIABLES), F.lit("counters")).otherwise(F.lit("numeric"))


def classify_names(names) -> dict[str, list[str]]:
    """Driver-side classification of an explicit (small) list of variable names."""
    out = {k: [] for k in VARIABLE_CLASSES}
    for v in names:
        if v in ZERO_VARIANCE_VARIABLES:
            out["excluded"].append(v)
        elif v in SPECIAL_VARIABLES:
            out[SPECIAL_VARIABLES[v]].append(v)
        elif v in COUNTER_VARIABLES:
            out["counters"].append(v)
        else:
            out["numeric"].append(v)
    return out


def machine_key(c, style: str = "strip") -> Column:
    """Normalise a machine identifier.

    * ``strip``   remove ``-`` and blanks (``M-221`` -> ``M221``).
    * ``digits3`` first run of three digits -> ``M###`` else ``Unknown``
      (``M612-33`` -> ``M612``).
    * ``hyphen``  ``M231-11`` -> ``M-231``; values whose first two characters
      hold a ``-`` are kept.  Every ``M`` is expanded to ``M-`` before the
      split, as in the original rule.
    * ``core``    the bare machine number used for cross-source mapping:
      ``M-221`` -> ``221`` and ``M221-10`` -> ``221``.
    """
    v = _col(c).cast("string")
    if style == "strip":
        return F.regexp_replace(v, "[- ]", "")
    if style == "digits3":
        d = F.regexp_extract(v, r"(\d{3})", 1)
        return F.when(v.isNotNull() & (d != ""), F.concat(F.lit("M"), d)).otherwise(F.lit("Unknown"))
    if style == "hyphen":
        r = F.replace(v, F.lit("M"), F.lit("M-"))
        p = F.split(r, "-")
        rebuilt = F.concat(p.getItem(0), F.lit("-"), p.getItem(1))
        return F.when(v.startswith("M") & ~F.substring(v, 1, 2).contains("-"), rebuilt).otherwise(v)
    if style == "core":
        return production_core(v)
    raise ValueError(f"unknown machine key style: {style}")


def production_core(c) -> Column:
    """Core number of a production-side id: drop the ``M-`` / ``m-`` prefix text."""
    v = _col(c).cast("string")
    return F.replace(F.replace(v, F.lit("M-"), F.lit("")), F.lit("m-"), F.lit(""))


def sensor_core(c) -> Column:
    """Core number of a sensor-side id: part before the first ``-``, without ``M``/``m``."""
    v = _col(c).cast("string")
    head = F.split(v, "-").getItem(0)
    return F.replace(F.replace(head, F.lit("M"), F.lit("")), F.lit("m"), F.lit(""))


def machine_key_from_path(c, fallback_prefix: bool = False) -> Column:
    """Machine id found in a file name: ``M[-_ ]?ddd`` (any case) -> ``M-ddd``.

    Otherwise ``Unknown``, or with ``fallback_prefix`` the first five characters
    of the file name.
    """
    v = _col(c).cast("string")
    name = F.regexp_extract(v, r"([^/\\]*)$", 1)
    d = F.regexp_extract(name, r"(?i)M[-_\s]?(\d{3})", 1)
    other = F.substring(name, 1, 5) if fallback_prefix else F.lit("Unknown")
    return F.when(d != "", F.concat(F.lit("M-"), d)).otherwise(other)


ISO_PREFIX = r"^\d{4}-\d{2}-\d{2}"
DMY_PREFIX = r"^\d{2}-\d{2}-\d{4}"
# Formats tried, in order, when a date column is neither all-ISO nor all-DMY.
# Day-first wins for ambiguous numeric dates.
DAYFIRST_FORMATS = ["d-M-yyyy", "d/M/yyyy", "d.M.yyyy", "yyyy-M-d", "yyyy/M/d",
                    "d-M-yyyy H:m:s", "d/M/yyyy H:m:s", "yyyy-M-d H:m:s", "yyyy-M-d'T'H:m:s",
                    "d-M-yyyy H:m", "d/M/yyyy H:m", "yyyy-M-d H:m"]


def parse_date(c, fmt: str) -> Column:
    """Date from a string with one explicit pattern; unparseable -> NULL."""
    return F.to_date(F.try_to_timestamp(_col(c).cast("string"), F.lit(fmt)))


def parse_date_dayfirst(c) -> Column:
    """Day-first date parse over a list of common layouts; unparseable -> NULL."""
    s = F.trim(_col(c).cast("string"))
    return F.coalesce(*[F.to_date(F.try_to_timestamp(s, F.lit(f))) for f in DAYFIRST_FORMATS])


# Layouts of a month-first or ISO date column: what a text looks like says which one it is parsed by.
MONTHFIRST_LAYOUTS = [(r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"), (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"), (r"^\d{1,2}-\d{1,2}-\d{4}$", "M-d-yyyy"),
                      (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"), (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$", "yyyy-M-d H:m:s"),
                      (r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}$", "yyyy-M-d'T'H:m:s"),
                      (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2}$", "M/d/yyyy H:m:s"),
                      (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}$", "M/d/yyyy H:m")]


def parse_date_monthfirst(c) -> Column:
    """ISO or month-first date; a text of another layout, or no date of its layout -> NULL.  One parse a value."""
    s = F.trim(_col(c).cast("string"))
    chosen = F.lit(None).cast("timestamp")
    for pattern, layout in reversed(MONTHFIRST_LAYOUTS):
        chosen = F.when(s.rlike(pattern), F.try_to_timestamp(s, F.lit(layout))).otherwise(chosen)
    return F.to_date(chosen)


def date_key(c) -> Column:
    """``yyyy-MM-dd`` string of a date/timestamp column (the join key format)."""
    return F.date_format(_col(c), "yyyy-MM-dd")


def risk_status(c, threshold: float) -> Column:
    """``HIGH RISK`` when the prediction is strictly above ``threshold``."""
    return F.when(_col(c) > F.lit(threshold), F.lit("HIGH RISK")).otherwise(F.lit("NORMAL"))


def clean_column_name(name: str, lower: bool = True) -> str:
    """Column name trimmed; with ``lower`` also lower case with inner blanks
    as underscores."""
    import re

    name = name.strip()
    return re.sub(r"\s+", "_", name).lower() if lower else name
