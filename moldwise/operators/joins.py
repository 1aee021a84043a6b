"""Key standardisation and joins between production records and features.

Join strategy is left to Catalyst + AQE: the feature side (machine x day) is
usually far smaller than the production side and AQE turns the sort-merge
join into a broadcast join at runtime when the *measured* size is under the
broadcast threshold; otherwise a shuffle join runs and AQE splits skewed
partitions (a machine-day holding a large share of production rows).
No hint forces a broadcast of data whose size is not known to be bounded.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from moldwise.functions.columns import (
    DMY_PREFIX,
    ISO_PREFIX,
    date_key as date_key_expr,
    machine_key,
    parse_date,
    parse_date_dayfirst,
    production_core,
    sensor_core,
)
from moldwise.operators.features import daily_features
from moldwise.session import reliable_checkpoint, store_bucketed, stored


# ---------------------------------------------------------------- dates -----
def detect_date_format(df: DataFrame, col: str) -> str:
    """``iso``, ``dmy`` or ``mixed`` for a text date column.

    One aggregate over all non-null values (order-free): a format is chosen
    only if every value starts with it.
    """
    s = F.col(col).cast("string")
    r = df.where(F.col(col).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.bool_and(s.rlike(ISO_PREFIX)).alias("iso"),
        F.bool_and(s.rlike(DMY_PREFIX)).alias("dmy"),
    ).first()
    if not r["n"]:
        return "mixed"
    if r["iso"]:
        return "iso"
    if r["dmy"]:
        return "dmy"
    return "mixed"


def standardize_date(df: DataFrame, col: str, fmt: str | None = None, out: str = "date_key") -> DataFrame:
    """Add ``out`` = the date in ``col`` as ``yyyy-MM-dd`` text (NULL if unparseable).

    Date/timestamp columns are formatted directly.  For text, an explicit
    ``fmt`` is used as given; otherwise one small aggregate job decides
    between ISO, day-month-year, or a day-first list of layouts.
    """
    dt = df.schema[col].dataType
    if isinstance(dt, (DateType, TimestampType, TimestampNTZType)):
        return df.withColumn(out, date_key_expr(F.col(col)))
    if fmt is None:
        kind = detect_date_format(df, col)
        parsed = {"iso": parse_date(col, "yyyy-MM-dd"), "dmy": parse_date(col, "dd-MM-yyyy")}.get(
            kind, parse_date_dayfirst(col))
    else:
        parsed = parse_date(col, fmt)
    return df.withColumn(out, date_key_expr(parsed))


# ------------------------------------------------------------- machines -----
def map_machines(production: DataFrame, features: DataFrame, prod_col: str = "machine_id",
                 feat_col: str = "machine_def") -> DataFrame:
    """Mapping ``production_id -> feature_id`` on equal core machine number.

    ``M-221`` (production) meets ``M221-10`` (sensors).  When several sensor
    ids share a core number the smallest wins (a deterministic stand-in for
    "first found").  Both inputs are reduced to distinct ids before the join,
    so the join works on machine counts, not row counts.
    """
    p = production.select(F.col(prod_col).alias("production_id")).where(F.col("production_id").isNotNull()) \
        .distinct().withColumn("core", production_core("production_id"))
    f = features.select(F.col(feat_col).alias("feature_id")).where(F.col("feature_id").isNotNull()) \
        .withColumn("core", sensor_core("feature_id")).groupBy("core").agg(F.min("feature_id").alias("feature_id"))
    return p.join(f, "core", "inner").select("production_id", "feature_id")


def dedupe_keys(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per key: the one with the smallest ``order_by`` tuple
    (all non-key columns when not given).

    Implemented as ``min_by`` over a struct, which aggregates map-side, so a
    key repeated on a third of the rows is collapsed before the shuffle.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    order = list(order_by) if order_by else rest
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    ordering = F.struct(*[F.col(f"`{c}`") for c in order])
    picked = df.groupBy(*keys).agg(F.min_by(row, ordering).alias("_row"))
    return picked.select(*keys, *[F.col("_row").getField(c).alias(c) for c in rest])


def _suffix_overlaps(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    common = (set(left.columns) & set(right.columns)) - set(keys)
    if common:
        left = left.withColumnsRenamed({c: f"{c}_x" for c in common})
        right = right.withColumnsRenamed({c: f"{c}_y" for c in common})
    return left, right


def prepare_production(production: DataFrame, features: DataFrame, prod_date: str = "date",
                       prod_machine: str = "machine_id", feat_machine: str = "machine_def",
                       date_format: str | None = None, mapping: DataFrame | None = None) -> DataFrame:
    """Production rows with ``date_key`` and ``machine_key`` (NULL when unmapped)."""
    p = standardize_date(production, prod_date, date_format, "date_key")
    if mapping is None:
        mapping = map_machines(production, features, prod_machine, feat_machine)
    mapping = mapping.withColumnsRenamed({"production_id": prod_machine, "feature_id": "machine_key"})
    return p.join(mapping, prod_machine, "left")


def prepare_features(features: DataFrame, feat_date: str = "agg_date", feat_machine: str = "machine_def",
                     dedupe: bool = True) -> DataFrame:
    """Feature rows keyed by (machine_key, date_key), one row per key."""
    f = features.withColumn("machine_key", F.col(feat_machine)).withColumn("date_key", F.col(feat_date).cast("string"))
    f = f.drop(feat_machine, feat_date)
    if dedupe:
        f = dedupe_keys(f, ["machine_key", "date_key"])
    return f


def join_production_features(production: DataFrame, features: DataFrame, prod_date: str = "date",
                             prod_machine: str = "machine_id", feat_date: str = "agg_date",
                             feat_machine: str = "machine_def", keep_unmatched: bool = True,
                             date_format: str | None = None, indicator: bool = False,
                             materialize_features: bool = True) -> DataFrame:
    """Production rows enriched with the daily features of their machine and day.

    Left join (all production rows kept) or inner join; many production rows
    share one feature row.  With ``indicator`` a boolean ``_matched`` column
    tells which rows found features.

    The feature table has two uses: its machine ids make the mapping, and its
    rows are joined.  With ``materialize_features`` the mapping (machine ids
    alone, so no statistic is computed for it) is stored once and the wide rows
    stay lazy, so unused columns are never computed; pass False for a table
    that is stored already.
    """
    p, f = _join_sides(production, features, prod_date, prod_machine, feat_date, feat_machine, date_format, materialize_features)
    return _joined(p, f, keep_unmatched, indicator)


JOIN_KEYS = ("machine_key", "date_key")


def _join_sides(production: DataFrame, features: DataFrame, prod_date: str, prod_machine: str, feat_date: str, feat_machine: str,
                date_format: str | None, materialize: bool) -> tuple[DataFrame, DataFrame]:
    """Both sides of the join, keyed by ``JOIN_KEYS``, clashing names told apart."""
    mapping = map_machines(production, features, prod_machine, feat_machine)
    p = prepare_production(production, features, prod_date, prod_machine, feat_machine, date_format, stored(mapping) if materialize else mapping)
    f = prepare_features(features, feat_date, feat_machine).withColumn("_matched", F.lit(True))
    return _suffix_overlaps(p, f, JOIN_KEYS)


def _joined(p: DataFrame, f: DataFrame, keep_unmatched: bool, indicator: bool) -> DataFrame:
    j = p.join(f, list(JOIN_KEYS), "left" if keep_unmatched else "inner")
    j = j.withColumn("_matched", F.coalesce(F.col("_matched"), F.lit(False)))
    ordered = [c for c in p.columns if c not in JOIN_KEYS] + [*JOIN_KEYS] + \
              [c for c in f.columns if c not in (*JOIN_KEYS, "_matched")]
    if indicator:
        ordered.append("_matched")
    return j.select(*[F.col(f"`{c}`") for c in ordered])


def store_join_sides(production: DataFrame, features: DataFrame, buckets: int | None = None, prod_date: str = "date",
                     prod_machine: str = "machine_id", feat_date: str = "agg_date", feat_machine: str = "machine_def",
                     date_format: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Production and features stored as tables bucketed and sorted by
    (machine_key, date_key): each is shuffled once, when it is stored, and any
    later join of the two on those keys needs no shuffle.

    ``buckets`` is the number of shuffle partitions by default: as many tasks
    as a join would have.  A key that holds much of the rows makes its bucket
    large; such tables are better joined by ``join_production_features``,
    where AQE splits it.
    """
    p, f = _join_sides(production, features, prod_date, prod_machine, feat_date, feat_machine, date_format, True)
    return store_bucketed(p, JOIN_KEYS, buckets), store_bucketed(f, JOIN_KEYS, buckets)


def join_stored_sides(production: DataFrame, features: DataFrame, keep_unmatched: bool = True, indicator: bool = False) -> DataFrame:
    """``join_production_features`` of tables that ``store_join_sides`` stored."""
    return _joined(production, features, keep_unmatched, indicator)


def _metric_rows(df: DataFrame, metrics: dict) -> DataFrame:
    """One aggregate pass -> long (metric, value) rows."""
    agg = df.agg(*[e.cast("double").alias(k) for k, e in metrics.items()])
    stack = ", ".join(f"'{k}', `{k}`" for k in metrics)
    return agg.selectExpr(f"stack({len(metrics)}, {stack}) AS (metric, value)")


def join_report(production: DataFrame, features: DataFrame, target: str = "actual_scrap_qty",
                prod_date: str = "date", prod_machine: str = "machine_id", feat_date: str = "agg_date",
                feat_machine: str = "machine_def", keep_unmatched: bool = True,
                materialize_features: bool = True) -> DataFrame:
    """Join statistics as (metric, value) rows.

    rows before (both sides), distinct dates (both sides), output rows,
    matched/unmatched production rows, match rate, overlapping dates, feature
    keys used more than once, target non-null before/after.

    Feature keys are unique after dedupe, so the left join keeps every
    production row exactly once and "matched" is a property of the key: one
    keyed aggregate of the join (partial aggregation before its shuffle)
    yields every production-side metric, and the feature-side dates are
    joined onto those keys for the date overlap.
    """
    if materialize_features:
        features = reliable_checkpoint(features)
    f = prepare_features(features, feat_date, feat_machine, dedupe=False)
    left = join_production_features(production, features, prod_date, prod_machine, feat_date, feat_machine,
                                    True, indicator=True, materialize_features=False)
    by_key = left.groupBy("machine_key", "date_key").agg(
        F.count(F.lit(1)).alias("n"), F.count(target).alias("t"), F.count_if("_matched").alias("m"))
    f_dates = f.select("date_key").where(F.col("date_key").isNotNull()).distinct().withColumn("_in_f", F.lit(True))
    keyed = by_key.join(f_dates, "date_key", "left")
    n, t, m = F.sum("n"), F.sum("t"), F.sum("m")
    matched_t = F.sum(F.when(F.col("m") > 0, F.col("t")))
    parts = [
        _metric_rows(keyed, {"hydra_rows_before": n,
                             "target_non_null_before": t,
                             "joined_rows": n if keep_unmatched else m,
                             "matched_hydra_rows": m,
                             "unmatched_hydra_rows": (n - m) if keep_unmatched else F.lit(0),
                             "match_rate": F.try_divide(m, n),
                             "target_non_null_after": t if keep_unmatched else F.coalesce(matched_t, F.lit(0)),
                             "hydra_unique_dates": F.count_distinct("date_key"),
                             "duplicate_joins": F.count_if(F.col("m") > 1),
                             "overlapping_dates": F.count_distinct(F.when(F.col("_in_f"), F.col("date_key")))}),
        _metric_rows(f, {"param_rows_before": F.count(F.lit(1)),
                         "param_unique_dates": F.count_distinct("date_key")}),
    ]
    return reduce(DataFrame.unionByName, parts)


def date_overlap(production: DataFrame, features: DataFrame, col: str = "date_key") -> DataFrame:
    """Every distinct date of either side with ``status``: ``matched`` (both),
    ``unmatched`` (production only) or ``features_only``."""
    a = production.select(F.col(col).alias("date_key")).where(F.col("date_key").isNotNull()).distinct() \
        .withColumn("_p", F.lit(True))
    b = features.select(F.col(col).alias("date_key")).where(F.col("date_key").isNotNull()).distinct() \
        .withColumn("_f", F.lit(True))
    j = a.join(b, "date_key", "full")
    status = (F.when(F.col("_p") & F.col("_f"), "matched").when(F.col("_p"), "unmatched").otherwise("features_only"))
    return j.select("date_key", status.alias("status"))


def key_diagnostics(production: DataFrame, features: DataFrame, prod_machine: str = "machine_id",
                    feat_machine: str = "machine_def") -> DataFrame:
    """Per distinct machine id of each side: its core number, its row count and
    whether the other side has the same core (side, machine, core, rows, matched)."""
    p = production.groupBy(F.col(prod_machine).alias("machine")).agg(F.count(F.lit(1)).alias("rows")) \
        .withColumn("core", production_core("machine")).withColumn("side", F.lit("production"))
    f = features.groupBy(F.col(feat_machine).alias("machine")).agg(F.count(F.lit(1)).alias("rows")) \
        .withColumn("core", sensor_core("machine")).withColumn("side", F.lit("features"))
    pc = p.select("core").distinct().withColumn("_in_p", F.lit(True))
    fc = f.select("core").distinct().withColumn("_in_f", F.lit(True))
    p = p.join(fc, "core", "left").withColumn("matched", F.coalesce("_in_f", F.lit(False))).drop("_in_f")
    f = f.join(pc, "core", "left").withColumn("matched", F.coalesce("_in_p", F.lit(False))).drop("_in_p")
    cols = ["side", "machine", "core", "rows", "matched"]
    return p.select(*cols).unionByName(f.select(*cols))


def rows_per_date(df: DataFrame, date_col: str) -> DataFrame:
    """Rows per date (one row per distinct date)."""
    return df.groupBy(date_col).agg(F.count(F.lit(1)).alias("rows"))


def join_vertical(production: DataFrame, features: DataFrame, prod_machine: str = "machine_nr",
                  start_col: str = "order_start") -> DataFrame:
    """Production rows joined to vertical features on (machine ``M###``, day of order start).

    Inner join; the machine is taken from each row's own id.
    """
    p = production.withColumn("machine_id", machine_key(F.col(prod_machine), "digits3")) \
                  .withColumn("date", F.to_date(start_col))
    p, f = _suffix_overlaps(p, features, ["machine_id", "date"])
    return p.join(f, ["machine_id", "date"], "inner")


def sensor_training_set(daily: DataFrame, means: DataFrame, keys: Sequence[str] = ("date", "machine_id")) -> DataFrame:
    """Daily scrap joined to daily sensor means (inner), missing numbers -> 0."""
    d, m = _suffix_overlaps(daily, means, keys)
    return d.join(m, list(keys), "inner").na.fill(0)


def union_datasets(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns missing on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def build_ml_dataset(readings: DataFrame, production: DataFrame, variables=None, keep_unmatched: bool = True,
                     materialize_features: bool = True) -> DataFrame:
    """ML dataset for all machines at once: daily features of the readings
    joined to the production rows (one plan; no per-machine loop)."""
    feats = daily_features(readings, variables=variables)
    return join_production_features(production, feats, keep_unmatched=keep_unmatched,
                                    materialize_features=materialize_features)
