"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the shared tables through the fixture views and runs the
operator over the whole table.  Doubles are rounded exactly as in the SQL
oracle (``moldwise.plans.oracle``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from moldwise.functions import columns as fn
from moldwise.operators import features as feat
from moldwise.operators import frequent as fq
from moldwise.operators import joins as jn
from moldwise.operators import metrics as mt
from moldwise.operators import models as md
from moldwise.operators import quality as ql
from moldwise.operators import selection as se
from moldwise.operators import splits as sp
from moldwise.operators import summaries as sm
from moldwise.operators import windows as wn
from moldwise.plans.oracle import DIGITS, FIXTURE_VARIABLES, VERT_VARS
from moldwise.session import stored
from moldwise.sources import fixtures as fx
from moldwise.sources import isolation as iso
from moldwise.sources import readers as rd
from moldwise.sources.manifest import file_manifest
from moldwise.streaming import live


def round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.round(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def q_daily_features(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(feat.daily_features(fx.readings(spark, sf), variables=FIXTURE_VARIABLES))


QUERIES = {
    "daily_features": q_daily_features,
}


# ---------------------------------------------------------------- functions --


def q_parse_values(spark, sf):
    r = fx.readings(spark, sf)
    return round_doubles(r.select(
        "machine_def", "timestamp", "variable_name", "value",
        fn.to_number("value").alias("value_number"),
        fn.duration_seconds("value").alias("value_seconds"),
        fn.classify_variable("variable_name").alias("var_class")))


def q_machine_keys(spark, sf):
    v = fx.vertical_readings(spark, sf)
    mdef = F.col("machine_definition")
    path = F.concat(F.lit("/data/raw_param/"), mdef, F.lit("_Jan.csv"))
    return v.select(
        mdef,
        fn.machine_key(mdef, "strip").alias("key_strip"),
        fn.machine_key(mdef, "digits3").alias("key_digits3"),
        fn.machine_key(mdef, "hyphen").alias("key_hyphen"),
        fn.sensor_core(mdef).alias("key_core"),
        fn.machine_key_from_path(path).alias("key_from_path"))


def q_standardize_date(spark, sf):
    p = fx.production(spark, sf)
    return jn.standardize_date(p, "date").select("order_id", "date", "date_key")


def q_classify_variables(spark, sf):
    r = fx.readings(spark, sf)
    return r.select("variable_name").where(F.col("variable_name").isNotNull()).distinct() \
            .withColumn("var_class", fn.classify_variable("variable_name"))


def _features(spark, sf):
    return feat.daily_features(fx.readings(spark, sf), variables=FIXTURE_VARIABLES)


def q_map_machines(spark, sf):
    return jn.map_machines(fx.production(spark, sf), _features(spark, sf))


def q_dedupe_keys(spark, sf):
    o = fx.table(spark, sf, "orders")
    return jn.dedupe_keys(o, ["o_custkey", "o_orderdate"])


def q_join_left(spark, sf):
    return round_doubles(jn.join_production_features(fx.production(spark, sf), _features(spark, sf),
                                                     keep_unmatched=True))


def q_join_inner(spark, sf):
    return round_doubles(jn.join_production_features(fx.production(spark, sf), _features(spark, sf),
                                                     keep_unmatched=False))


def q_join_report(spark, sf):
    return round_doubles(jn.join_report(fx.production(spark, sf), _features(spark, sf)))


def q_date_overlap(spark, sf):
    p = jn.standardize_date(fx.production(spark, sf), "date")
    f = _features(spark, sf).withColumnRenamed("agg_date", "date_key")
    return jn.date_overlap(p, f)


def q_key_diagnostics(spark, sf):
    return jn.key_diagnostics(fx.production(spark, sf), _features(spark, sf))


def _vertical(spark, sf):
    return feat.vertical_features(fx.vertical_readings(spark, sf), variables=VERT_VARS)


def q_vertical_features(spark, sf):
    return round_doubles(_vertical(spark, sf))


def q_join_vertical(spark, sf):
    return round_doubles(jn.join_vertical(fx.production(spark, sf), _vertical(spark, sf)))


def _sensor_means(spark, sf):
    return feat.sensor_means(fx.vertical_readings(spark, sf), variables=VERT_VARS)


def q_sensor_means(spark, sf):
    return round_doubles(_sensor_means(spark, sf))


def _training_set(spark, sf):
    daily = feat.daily_scrap(fx.hydra_january(spark, sf))
    return jn.sensor_training_set(daily, _sensor_means(spark, sf))


def q_sensor_training_set(spark, sf):
    return round_doubles(_training_set(spark, sf))


def q_union_datasets(spark, sf):
    a = feat.daily_scrap(fx.hydra_raw(spark, sf)).withColumn("source", F.lit("lineitem"))
    return round_doubles(jn.union_datasets([a, _training_set(spark, sf)]))


def q_daily_scrap(spark, sf):
    return round_doubles(feat.daily_scrap(fx.hydra_raw(spark, sf)))


QUERIES.update({
    "parse_values": q_parse_values,
    "machine_keys": q_machine_keys,
    "standardize_date": q_standardize_date,
    "classify_variables": q_classify_variables,
    "map_machines": q_map_machines,
    "dedupe_keys": q_dedupe_keys,
    "join_left": q_join_left,
    "join_inner": q_join_inner,
    "join_report": q_join_report,
    "date_overlap": q_date_overlap,
    "key_diagnostics": q_key_diagnostics,
    "vertical_features": q_vertical_features,
    "join_vertical": q_join_vertical,
    "sensor_means": q_sensor_means,
    "sensor_training_set": q_sensor_training_set,
    "union_datasets": q_union_datasets,
    "daily_scrap": q_daily_scrap,
})


# ------------------------------------------------------------------ windows --


def _daily(spark, sf):
    return feat.daily_scrap(fx.hydra_raw(spark, sf))


def _forecast_table(spark, sf):
    return wn.forecast_features(_daily(spark, sf))


def q_lag_features(spark, sf):
    return round_doubles(_forecast_table(spark, sf))


def q_time_split(spark, sf):
    return round_doubles(wn.forecast_split(_daily(spark, sf)))


def q_scoring_context(spark, sf):
    return round_doubles(wn.scoring_context(_daily(spark, sf)))


def q_most_active_job(spark, sf):
    return wn.most_active_job(_daily(spark, sf))


def q_planning_kpis(spark, sf):
    return round_doubles(wn.planning_kpis(_daily(spark, sf)))


def q_job_combinations(spark, sf):
    return wn.job_combinations(_daily(spark, sf))


def q_label_encode(spark, sf):
    current = feat.daily_scrap(fx.hydra_january(spark, sf))
    return round_doubles(wn.label_encode(current, {"machine_id": "machine_code"}, unseen=0,
                                         codes_from=_forecast_table(spark, sf)))


QUERIES.update({
    "lag_features": q_lag_features,
    "time_split": q_time_split,
    "scoring_context": q_scoring_context,
    "most_active_job": q_most_active_job,
    "planning_kpis": q_planning_kpis,
    "job_combinations": q_job_combinations,
    "label_encode": q_label_encode,
})


# ------------------------------------------------------------------ quality --

ISSUE_VIEW = [c for c in ql.ISSUE_COLUMNS if c != "details"]


def _issues(df):
    return round_doubles(df.select(*ISSUE_VIEW))


def q_check_missing(spark, sf):
    return _issues(ql.check_missing(fx.customers_with_gaps(spark, sf), "customer"))


def q_check_duplicates(spark, sf):
    return _issues(ql.check_duplicates(fx.order_facts(spark, sf), ["o_custkey", "o_orderdate"], "orders"))


def q_check_ranges(spark, sf):
    return _issues(ql.check_ranges(fx.table(spark, sf, "customer"), "c_acctbal", 0.0, 9000.0, "customer"))


def q_check_outliers_iqr(spark, sf):
    return _issues(ql.check_outliers_iqr(fx.table(spark, sf, "orders"), "o_totalprice", 1.5, "orders"))


def _validate_production(spark, sf):
    return ql.validate_production(fx.production(spark, sf), key_columns=["machine_id", "date"])


def q_validate_production(spark, sf):
    return _issues(_validate_production(spark, sf))


def q_validate_readings(spark, sf):
    return _issues(ql.validate_readings(fx.readings(spark, sf)))


def q_validation_report(spark, sf):
    return ql.validation_report(_validate_production(spark, sf), fx.production(spark, sf), "HydraData")


QUERIES.update({
    "check_missing": q_check_missing,
    "check_duplicates": q_check_duplicates,
    "check_ranges": q_check_ranges,
    "check_outliers_iqr": q_check_outliers_iqr,
    "validate_production": q_validate_production,
    "validate_readings": q_validate_readings,
    "validation_report": q_validation_report,
})


# ---------------------------------------------------------------- summaries --


def q_profile_readings(spark, sf):
    return round_doubles(sm.profile_readings(fx.readings(spark, sf)))


def q_column_missing(spark, sf):
    return round_doubles(sm.column_missing(fx.readings(spark, sf)))


def q_profile_variables(spark, sf):
    return round_doubles(sm.profile_variables(fx.readings(spark, sf)))


def q_top_values(spark, sf):
    return round_doubles(sm.top_values(fx.readings(spark, sf), "value", 10))


def q_value_type_profile(spark, sf):
    return sm.value_type_profile(fx.readings(spark, sf))


def q_machine_comparison(spark, sf):
    return round_doubles(sm.machine_comparison(fx.readings(spark, sf)))


def q_column_stats(spark, sf):
    return round_doubles(sm.column_stats(fx.production(spark, sf)))


def q_cumulative_verdict(spark, sf):
    return round_doubles(sm.cumulative_verdict(fx.production(spark, sf), ["actual_scrap_qty", "order_id"]))


def q_dataset_summary(spark, sf):
    ml = jn.join_production_features(fx.production(spark, sf), _features(spark, sf), keep_unmatched=True)
    return round_doubles(sm.dataset_summary(ml, "actual_scrap_qty", "machine_id", "date_key"))


def q_feature_summary(spark, sf):
    return round_doubles(sm.feature_summary(_features(spark, sf)))


def q_feature_ranges(spark, sf):
    return round_doubles(sm.feature_ranges(_features(spark, sf)))


QUERIES.update({
    "profile_readings": q_profile_readings,
    "column_missing": q_column_missing,
    "profile_variables": q_profile_variables,
    "top_values": q_top_values,
    "value_type_profile": q_value_type_profile,
    "machine_comparison": q_machine_comparison,
    "column_stats": q_column_stats,
    "cumulative_verdict": q_cumulative_verdict,
    "dataset_summary": q_dataset_summary,
    "feature_summary": q_feature_summary,
    "feature_ranges": q_feature_ranges,
})


# ------------------------------------------- selection, splits and metrics --


def _ml_dataset(spark, sf):
    return jn.join_production_features(fx.production(spark, sf), _features(spark, sf), keep_unmatched=True)


def q_label_high_risk(spark, sf):
    p = fx.production(spark, sf)
    return se.label_high_risk(p, "actual_scrap_qty", 0.75).select("order_id", "actual_scrap_qty", "high_scrap_risk")


def q_coerce_numeric_frame(spark, sf):
    ml = se.label_high_risk(_ml_dataset(spark, sf), "actual_scrap_qty", 0.75, "target")
    return round_doubles(se.final_model_frame(ml, "target"))


def q_fill_median(spark, sf):
    ml = _ml_dataset(spark, sf)
    feats = se.baseline_features(ml)
    return round_doubles(se.fill_median(stored(ml.select(*feats)), feats, materialize=False))


def q_group_split(spark, sf):
    ml = _ml_dataset(spark, sf)
    return sp.group_split(ml, ["machine_id", "date_key"]).select("order_id", "machine_id", "date_key", "split")


def q_row_split(spark, sf):
    return sp.row_split(fx.production(spark, sf), ["order_id"]).select("order_id", "split")


def q_stratified_folds(spark, sf):
    p = se.label_high_risk(fx.production(spark, sf), "actual_scrap_qty", 0.75)
    return sp.stratified_folds(p, "high_scrap_risk", ["order_id"], 5).select("order_id", "high_scrap_risk", "fold")


def _ml_split(spark, sf):
    return sp.group_split(_ml_dataset(spark, sf), ["machine_id", "date_key"])


def q_split_report(spark, sf):
    return round_doubles(sp.split_report(_ml_split(spark, sf), "actual_scrap_qty", ["machine_id", "date_key"]))


def q_matrix_summary(spark, sf):
    ml = _ml_dataset(spark, sf)
    return round_doubles(sp.matrix_summary(ml, se.baseline_features(ml), "actual_scrap_qty"))


def q_naive_baseline(spark, sf):
    s = _ml_split(spark, sf)
    return round_doubles(mt.naive_baseline(s.where("split = 'train'"), s.where("split = 'test'"), "actual_scrap_qty"))


def _persistence(spark, sf):
    """Test rows of the lag table with the previous day as the forecast
    (the label codes of the forecast table are not needed here)."""
    return wn.time_split(wn.lag_features(_daily(spark, sf))).where("split = 'test'")


def q_regression_metrics(spark, sf):
    return round_doubles(mt.regression_metrics(_persistence(spark, sf), "scrap_quantity", "scrap_lag_1"))


def _persistence_classes(spark, sf):
    t = _persistence(spark, sf)
    cut = se.high_risk_threshold(t, "scrap_quantity", 0.75)
    return t.select((F.col("scrap_quantity") > cut).cast("int").alias("actual_high"),
                    (F.col("scrap_lag_1") > cut).cast("int").alias("predicted_high"))


def q_confusion_matrix(spark, sf):
    return mt.confusion_matrix(_persistence_classes(spark, sf), "actual_high", "predicted_high")


def q_classification_metrics(spark, sf):
    return round_doubles(mt.classification_metrics(_persistence_classes(spark, sf), "actual_high", "predicted_high"))


QUERIES.update({
    "label_high_risk": q_label_high_risk,
    "coerce_numeric_frame": q_coerce_numeric_frame,
    "fill_median": q_fill_median,
    "group_split": q_group_split,
    "row_split": q_row_split,
    "stratified_folds": q_stratified_folds,
    "split_report": q_split_report,
    "matrix_summary": q_matrix_summary,
    "naive_baseline": q_naive_baseline,
    "regression_metrics": q_regression_metrics,
    "confusion_matrix": q_confusion_matrix,
    "classification_metrics": q_classification_metrics,
})


# ------------------------------------------------------- sources and sinks --


def q_file_roundtrip(spark, sf):
    """Readings written as CSV files, read back through the glob reader,
    aggregated, written as Parquet partitioned by day and read back."""
    base = rd.scratch_path(spark, f"roundtrip-{uuid.uuid4().hex}")
    rd.write_dataset(fx.readings(spark, sf), f"{base}/raw", fmt="csv")
    raw = rd.read_readings(spark, f"{base}/raw", glob="*.csv")
    feats = feat.daily_features(raw, variables=FIXTURE_VARIABLES)
    rd.write_dataset(feats, f"{base}/features", partition_by=["agg_date"])
    back = spark.read.parquet(f"{base}/features")
    return round_doubles(back.withColumn("agg_date", F.col("agg_date").cast("string")))


def q_machine_filter(spark, sf):
    """Production rows of one machine (ids compared without '-' and spaces)."""
    return rd.filter_machine(fx.production(spark, sf), "M 105", "machine_nr")


def _machine_features(spark, sf):
    base = rd.scratch_path(spark, f"machines-{uuid.uuid4().hex}")
    fx.write_machine_files(spark, sf, base)
    return iso.machine_features(spark, base, variables=FIXTURE_VARIABLES)


def q_isolated_features(spark, sf):
    """Daily features of 20 machine files, two of which are broken and left out."""
    return round_doubles(_machine_features(spark, sf)[0])


def q_quarantine(spark, sf):
    """What was wrong with the broken files, by line and column."""
    unit = F.regexp_extract("source_file", "grp=([0-9]+)", 1).cast("int").alias("grp")
    return _machine_features(spark, sf)[1].select(unit, "line", "column", "reason", "text")


def q_file_manifest(spark, sf):
    """Headers of the machine files, found by one job, and how many files have each."""
    base = rd.scratch_path(spark, f"machines-{uuid.uuid4().hex}")
    fx.write_machine_files(spark, sf, base)
    return file_manifest(spark, base, "*.csv").groupBy(F.concat_ws(",", "header").alias("header")).agg(F.count("*").alias("files"))


QUERIES.update({
    "file_roundtrip": q_file_roundtrip,
    "machine_filter": q_machine_filter,
    "isolated_features": q_isolated_features,
    "quarantine": q_quarantine,
    "file_manifest": q_file_manifest,
})


# ---------------------------------------------------- missing numbers, dates --


def q_nan_missing(spark, sf):
    return _issues(ql.check_missing(fx.customers_with_nan(spark, sf), "customer"))


def q_nan_ranges(spark, sf):
    return _issues(ql.check_ranges(fx.customers_with_nan(spark, sf), "balance", 0.0, 9000.0, "customer"))


def q_nan_outliers(spark, sf):
    return _issues(ql.check_outliers_iqr(fx.customers_with_nan(spark, sf), "balance", 1.5, "customer"))


def q_nan_high_risk(spark, sf):
    return se.label_high_risk(fx.customers_with_nan(spark, sf), "balance", 0.75).select("c_custkey", "high_scrap_risk")


def q_nan_column_stats(spark, sf):
    return round_doubles(sm.column_stats(fx.customers_with_nan(spark, sf)))


def q_nan_dataset_summary(spark, sf):
    data = fx.customers_with_nan(spark, sf).withColumn("balance_mean", F.col("balance"))
    return round_doubles(sm.dataset_summary(data, "balance", "c_mktsegment", "c_mktsegment"))


def q_nan_daily_scrap(spark, sf):
    """NaN is no value, and text dates of two layouts meet."""
    return round_doubles(feat.daily_scrap(fx.hydra_with_nan(spark, sf)))


def q_standardize_date_iso(spark, sf):
    """ISO dates; one with a time behind it isn't a date (NULL)."""
    text = F.when(F.col("order_id") % 5 == 0, F.date_format("order_start", "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format("order_start", "yyyy-MM-dd"))
    p = fx.production(spark, sf).select("order_id", text.alias("date"))
    return jn.standardize_date(p, "date").select("order_id", "date", "date_key")


def q_standardize_date_mixed(spark, sf):
    day = F.col("order_start")
    text = F.when(F.col("order_id") % 2 == 0, F.date_format(day, "yyyy-MM-dd")).otherwise(F.date_format(day, "dd/MM/yyyy"))
    return jn.standardize_date(fx.production(spark, sf).select("order_id", text.alias("date")), "date").select("order_id", "date", "date_key")


def q_read_by_name(spark, sf):
    """CSV files whose headers differ in order and columns, with rare decimals
    and marks for missing numbers, read back without a schema."""
    base = rd.scratch_path(spark, f"by-name-{uuid.uuid4().hex}")
    k = F.col("order_id")
    quantity = F.when(k % 13 == 0, F.lit("NaN")).when(k % 997 == 0, F.concat(F.col("actual_scrap_qty").cast("string"), F.lit(".5"))) \
        .otherwise(F.col("actual_scrap_qty").cast("string"))
    p = fx.production(spark, sf).select("order_id", "machine_id", quantity.alias("actual_scrap_qty"))
    rd.write_dataset(p.where(k % 2 == 0), f"{base}/a", fmt="csv")
    rd.write_dataset(p.where(k % 2 == 1).select("actual_scrap_qty", "order_id"), f"{base}/b", fmt="csv")
    return round_doubles(rd.read_production(spark, f"{base}/*"))


def q_long_features(spark, sf):
    return round_doubles(feat.long_features(fx.readings(spark, sf)))


def q_build_ml_dataset(spark, sf):
    return round_doubles(jn.build_ml_dataset(fx.readings(spark, sf), fx.production(spark, sf), variables=FIXTURE_VARIABLES))


def q_rows_per_date(spark, sf):
    return jn.rows_per_date(fx.production(spark, sf), "date")


def q_check_columns(spark, sf):
    return _issues(ql.check_columns(fx.production(spark, sf), ["order_id", "cavity"], ["shift", "remark"], "HydraData"))


def q_check_types(spark, sf):
    expected = {"order_id": "numeric", "date": "datetime", "article": "string", "shift": "categorical"}
    return _issues(ql.check_types(fx.production(spark, sf), expected, "HydraData"))


def q_validate_dispatch(spark, sf):
    return _issues(ql.validate(fx.production(spark, sf), "hydra", key_columns=["machine_id", "date"])
                   .unionByName(ql.validate(fx.readings(spark, sf), "param")))


def q_variable_summary(spark, sf):
    return ql.variable_summary(fx.readings(spark, sf))


def q_issue_details(spark, sf):
    """What the range, duplicate and missing-value issues carry besides their message."""
    issues = ql.check_ranges(fx.customers_with_nan(spark, sf), "balance", 0.0, 9000.0, "customer") \
        .unionByName(ql.check_missing(fx.customers_with_nan(spark, sf), "customer")) \
        .unionByName(ql.check_duplicates(fx.order_facts(spark, sf), ["o_custkey", "o_orderdate"], "orders"))
    get = lambda key: F.get_json_object("details", f"$.{key}").cast("double").alias(key)
    return round_doubles(issues.select("column", "issue_type", *map(get, (
        "violation_count", "actual_min", "actual_max", "missing_count", "missing_pct", "duplicate_count"))))


QUERIES.update({
    "nan_missing": q_nan_missing,
    "nan_ranges": q_nan_ranges,
    "nan_outliers": q_nan_outliers,
    "nan_high_risk": q_nan_high_risk,
    "nan_column_stats": q_nan_column_stats,
    "nan_dataset_summary": q_nan_dataset_summary,
    "nan_daily_scrap": q_nan_daily_scrap,
    "standardize_date_iso": q_standardize_date_iso,
    "standardize_date_mixed": q_standardize_date_mixed,
    "read_by_name": q_read_by_name,
    "long_features": q_long_features,
    "build_ml_dataset": q_build_ml_dataset,
    "rows_per_date": q_rows_per_date,
    "check_columns": q_check_columns,
    "check_types": q_check_types,
    "validate_dispatch": q_validate_dispatch,
    "variable_summary": q_variable_summary,
    "issue_details": q_issue_details,
})


# ------------------------------------------------------------------ models --
# What a model was trained to predict has no SQL form.  These queries return
# everything around it that has (rows scored, targets, baselines, keys, dates)
# and the trained figures as checks that hold for any rightly fitted model.


# The fixtures are small and the deep default is slow on them.
FIXTURE_TREE_DEPTH = 12


def _model_dataset(spark, sf):
    """The ML dataset for fits, which read it several times: daily features are computed once."""
    return jn.join_production_features(fx.production(spark, sf), stored(_features(spark, sf)), keep_unmatched=True, materialize_features=False)


def _baseline_matrix(spark, sf):
    """ML dataset -> sorted numeric features (median-filled) + group split."""
    ml = _model_dataset(spark, sf)
    feats = se.baseline_features(ml)
    filled = se.fill_median(stored(ml.select("machine_id", "date_key", "actual_scrap_qty", *feats)), feats, materialize=False)
    return sp.group_split(filled, ["machine_id", "date_key"]), feats


def _rf_regressor(spark, sf):
    s, feats = _baseline_matrix(spark, sf)
    train, test = s.where("split = 'train'"), s.where("split = 'test'")
    return md.train_rf_regressor(train, feats, "actual_scrap_qty", max_depth=FIXTURE_TREE_DEPTH), feats, train, test


def q_rf_regressor(spark, sf):
    model, feats, train, test = _rf_regressor(spark, sf)
    report = md.regression_report(model, train, test, "actual_scrap_qty")
    checks = md.regression_checks(model, train, test, "actual_scrap_qty")
    return round_doubles(report.select("n", "y_mean", "y_std", "y_range", "mean_prediction", "baseline_mae", "baseline_rmse",
                                       checks.select("fits").scalar().alias("fits"), checks.select("in_range").scalar().alias("in_range")))


def q_feature_importance(spark, sf):
    model, feats, _train, _test = _rf_regressor(spark, sf)
    all_ = md.feature_importance(model, feats, None)
    w = Window.orderBy("rank")  # a row a feature
    before, share = F.lag("importance").over(w), F.col("importance")
    adds_up = F.abs(F.max("cumulative_importance").over(Window.partitionBy()) - 1) < 1e-6
    top = F.lit(md.feature_importance(model, feats, 15).count())
    return all_.select("feature", (share.between(0, 1) & (F.coalesce(before, share) >= share)).alias("in_order"), adds_up.alias("adds_up"), top.alias("top"))


def _risk_dataset(spark, sf):
    return se.label_high_risk(_model_dataset(spark, sf), "actual_scrap_qty", 0.75, "high_scrap_risk")


def q_risk_classifier(spark, sf):
    df = _risk_dataset(spark, sf)
    feats = se.risk_features(df)
    data = stored(df.select("date", "high_scrap_risk", *feats).na.fill(0.0, subset=feats))  # a fit reads it several times
    s = sp.group_split(data, ["date"])
    train = s.where("split = 'train'")
    model = md.train_rf_classifier(train, feats, "high_scrap_risk", num_trees=200, max_depth=FIXTURE_TREE_DEPTH)
    return _checked_classes(md.risk_classifier_report(model, s.where("split = 'test'"), "high_scrap_risk"), model, train, "high_scrap_risk")


def _checked_classes(report, model, train, label):
    """Supports of a class report; whether its figures are shares, and whether the model tells its training rows apart."""
    shares = F.coalesce(F.col("precision").between(0, 1), F.lit(True)) & F.coalesce(F.col("recall").between(0, 1), F.lit(True)) & F.col("f1").between(0, 1)
    fits = md.balanced_accuracy(md.scored(model, train), label) > 0.5
    return report.select("class", "support", shares.alias("shares"), F.lit(fits).alias("fits"))


def _final_frame(spark, sf):
    ml = se.label_high_risk(_model_dataset(spark, sf), "actual_scrap_qty", 0.75, "target")
    frame = se.final_model_frame(ml, "target")
    return frame, [c for c in frame.columns if c != "target"]


def q_cross_validate(spark, sf):
    frame, feats = _final_frame(spark, sf)
    scores = md.cross_validate(frame, feats, "target", ["order_id"], 5, max_depth=FIXTURE_TREE_DEPTH)
    mean = F.avg(F.when(F.col("fold") != "mean", F.col("accuracy"))).over(Window.partitionBy())
    fine = F.col("accuracy").between(0, 1) & F.col("f1").between(0, 1) & ((F.col("fold") != "mean") | (F.abs(F.col("accuracy") - mean) < 1e-9))
    return scores.select("fold", "rows", "positives", fine.alias("fine"), F.col("verdict").isNotNull().alias("verdict_given"))


def q_compare_models(spark, sf):
    frame, feats = _final_frame(spark, sf)
    scores = md.compare_models(frame, feats, "target", ["order_id"], 5, max_depth=FIXTURE_TREE_DEPTH)
    every = Window.partitionBy()
    best = (F.sum(F.col("best").cast("int")).over(every) == 1) & (F.max("mean_accuracy").over(every) == F.max(F.when(F.col("best"), F.col("mean_accuracy"))).over(every))
    return scores.select("model", (F.col("mean_accuracy").between(0, 1) & (F.col("std_accuracy") >= 0)).alias("fine"), best.alias("one_best"))


def q_forecaster(spark, sf):
    s = wn.time_split(stored(wn.lag_features(_daily(spark, sf))))
    train = s.where("split = 'train'")
    model = md.train_forecaster(train)
    test = model.encode(s.where("split = 'test'"), unseen=0)
    metrics = md.regression_metrics(model.model.transform(test), "scrap_quantity", "prediction")
    checks = md.regression_checks(model.model, model.encode(train, unseen=0), test, "scrap_quantity")
    return round_doubles(metrics.select("n", "y_mean", "y_std", "y_range", checks.select("fits").scalar().alias("fits")))


def q_forecast_next_day(spark, sf):
    daily = _daily(spark, sf)
    model = md.train_forecaster(wn.lag_features(daily))
    f = md.forecast_next_day(model, daily, threshold=100.0)
    delta = F.abs(F.col("expected_scrap") - F.col("yesterday") - F.col("delta")) < 1e-6
    status = F.col("status") == F.when(F.col("expected_scrap") > 100.0, "HIGH RISK").otherwise("NORMAL")
    return round_doubles(f.select(*wn.JOB_KEYS, "last_date", "forecast_date", "yesterday", delta.alias("delta_fits"), status.alias("status_fits")))


def q_sensor_model(spark, sf):
    _model, metrics = md.train_sensor_model(_training_set(spark, sf))
    return round_doubles(metrics.select("n", "y_mean", "y_std", "y_range", (F.col("mae") <= F.col("y_range")).alias("error_in_range")))


QUERIES.update({
    "rf_regressor": q_rf_regressor,
    "feature_importance": q_feature_importance,
    "risk_classifier": q_risk_classifier,
    "cross_validate": q_cross_validate,
    "compare_models": q_compare_models,
    "forecaster": q_forecaster,
    "forecast_next_day": q_forecast_next_day,
    "sensor_model": q_sensor_model,
})


# --------------------------------------------------------------- streaming --


def _events_stream(spark, sf):
    schema = fx.table(spark, sf, "events").schema
    return live.file_stream(spark, sf, schema, "parquet", glob="events.parquet")


def q_stream_daily_features(spark, sf):
    """Events replayed as a file stream -> daily features per closed day."""
    base = rd.scratch_path(spark, f"stream-features-{uuid.uuid4().hex}")
    feats = live.stream_daily_features(fx.readings_from_events(_events_stream(spark, sf)), FIXTURE_VARIABLES)
    live.run_available_now(feats, f"{base}/out", f"{base}/checkpoint")
    return round_doubles(spark.read.parquet(f"{base}/out"))


# The operator's default alert level (2000 a day) is set for real plant
# totals; the fixture's daily scrap is about ten times smaller, so the
# registered streams use a level inside its range.
FIXTURE_ALERT_LEVEL = 300.0


def _fed_model(spark, sf):
    base = rd.scratch_path(spark, f"stream-score-{uuid.uuid4().hex}")
    training = _training_set(spark, sf)
    model, _metrics = md.train_sensor_model(training)
    rd.write_dataset(training, f"{base}/feed")
    return base, model


def _scored_stream(spark, sf):
    base, model = _fed_model(spark, sf)
    feed = live.file_stream(spark, f"{base}/feed", spark.read.parquet(f"{base}/feed").schema)
    return base, live.stream_score(feed, model, threshold=FIXTURE_ALERT_LEVEL)


def q_stream_score(spark, sf):
    base, scored = _scored_stream(spark, sf)
    live.run_available_now(scored, f"{base}/out", f"{base}/checkpoint")
    out = spark.read.parquet(f"{base}/out")
    half = F.abs(F.col("pred_12h") * 2 - F.col("pred_24h")) < 1e-9
    status = F.col("status") == F.when(F.col("pred_24h") > FIXTURE_ALERT_LEVEL, "HIGH RISK").otherwise("NORMAL")
    rows = [c for c in out.columns if c not in ("pred_24h", "pred_12h", "status")]
    return round_doubles(out.select(*rows, half.alias("half_fits"), status.alias("status_fits")))


def q_stream_alerts(spark, sf):
    """Alerts of the stream, held against those of the same rows scored at once."""
    base, model = _fed_model(spark, sf)
    feed = live.file_stream(spark, f"{base}/feed", spark.read.parquet(f"{base}/feed").schema)
    scored = live.stream_score(feed, model, threshold=FIXTURE_ALERT_LEVEL)
    live.run_available_now(live.stream_alerts(scored, FIXTURE_ALERT_LEVEL), f"{base}/out", f"{base}/checkpoint")
    alerts = spark.read.parquet(f"{base}/out")
    batch = live.stream_alerts(live.stream_score(spark.read.parquet(f"{base}/feed"), model, threshold=FIXTURE_ALERT_LEVEL), FIXTURE_ALERT_LEVEL)
    differ = alerts.exceptAll(batch).count() + batch.exceptAll(alerts).count()
    above = F.coalesce(F.bool_and(F.col("pred_24h") > FIXTURE_ALERT_LEVEL), F.lit(True))
    return alerts.agg(F.lit(differ == 0).alias("agree"), above.alias("all_above"))


QUERIES.update({
    "stream_daily_features": q_stream_daily_features,
    "stream_score": q_stream_score,
    "stream_alerts": q_stream_alerts,
})


# ------------------------------------------------------------ small extras --
def q_risk_status(spark, sf):
    """Risk status of a naive forecast (mean of the last three days)."""
    ctx = wn.scoring_context(_daily(spark, sf))
    scored = wn.with_risk_status(ctx.withColumn("prediction", F.col("rolling_avg_3")), "prediction", 40.0)
    return round_doubles(scored.select(*wn.JOB_KEYS, "prediction", "status"))


def q_standardize_columns(spark, sf):
    """Production read with messy header names, cleaned."""
    p = fx.production(spark, sf)
    messy = p.toDF(*[f"  {c.upper().replace('_', ' ')} " for c in p.columns])
    return se.standardize_columns(messy, lower=True)


QUERIES.update({
    "risk_status": q_risk_status,
    "standardize_columns": q_standardize_columns,
})


def q_check_outliers_sensor(spark, sf):
    """1.5-IQR outliers of the raw sensor value column of ``events``."""
    return _issues(ql.check_outliers_iqr(fx.table(spark, sf, "events"), "value", 1.5, "events"))


QUERIES["check_outliers_sensor"] = q_check_outliers_sensor


def q_final_risk_model(spark, sf):
    """Final risk model: leak-filtered numeric frame, 80/20 row split,
    balanced 200-tree forest, class report; the model is saved and reloaded."""
    ml = se.label_high_risk(_model_dataset(spark, sf), "actual_scrap_qty", 0.75, "target")
    frame = stored(se.final_model_frame(ml.withColumn("_row", F.col("order_id")), "target"))
    feats = [c for c in frame.columns if c not in ("target", "_row")]
    s = sp.row_split(frame, ["_row"])
    train, test = s.where("split = 'train'"), s.where("split = 'test'")
    model = md.train_rf_classifier(train, feats, "target", num_trees=200, max_depth=FIXTURE_TREE_DEPTH)
    path = rd.scratch_path(spark, f"final-model-{uuid.uuid4().hex}")
    model.write().overwrite().save(path)
    back = md.PipelineModel.load(path)
    both = md.scored(back, md.scored(model, test).withColumnRenamed("prediction", "_saved"))
    same = both.where(F.col("prediction") != F.col("_saved")).isEmpty()
    return _checked_classes(md.risk_classifier_report(back, test, "target"), back, train, "target").withColumn("reloaded_equal", F.lit(same))


QUERIES["final_risk_model"] = q_final_risk_model


def q_validation_json(spark, sf):
    """Serialised production validation report with column statistics."""
    p = fx.production(spark, sf)
    issues = _validate_production(spark, sf)
    doc = ql.report_json(ql.validation_report(issues, p, "HydraData"), issues, sm.column_stats(p))
    get = lambda key: F.get_json_object("json", f"$.{key}")
    messages = F.from_json(get("issues"), "array<struct<message string>>")
    return doc.select("dataset", get("row_count").cast("bigint").alias("row_count"), get("issue_count").cast("bigint").alias("issue_count"),
                      get("is_valid").cast("boolean").alias("is_valid"), F.concat_ws("; ", F.array_sort(messages["message"])).alias("messages"),
                      F.json_array_length(get("column_stats")).alias("columns"))


QUERIES["validation_json"] = q_validation_json


def q_variable_counts(spark, sf):
    """Every variable with its reading count, share and rank (full list)."""
    return round_doubles(sm.top_values(fx.readings(spark, sf), "variable_name", None))


QUERIES["variable_counts"] = q_variable_counts


# ------------------------------------------- stored layouts, summaries, gates --


def q_repeated_rows(spark, sf):
    """Rows that occur again, found by fingerprint and compared in full."""
    return ql.repeated_rows(fx.order_facts(spark, sf))


def q_top_order_keys(spark, sf):
    """The most frequent of very many values that hardly differ in frequency."""
    return round_doubles(sm.top_values(fx.table(spark, sf, "lineitem"), "l_orderkey", 10))


def q_column_stats_sketched(spark, sf):
    return round_doubles(sm.column_stats(fx.production(spark, sf), approx_distinct=True))


def q_distinct_by_machine(spark, sf):
    """Distinct counts a machine and day, stored as sketches and united over the days."""
    r = fx.readings(spark, sf).withColumn("day", F.to_date("timestamp"))
    daily = stored(fq.distinct_sketches(r, ["variable_name", "day"], ["machine_def", "day"]))
    return fq.distinct_estimates(fq.unite_sketches(daily, ["machine_def"]))


def q_bucketed_join(spark, sf):
    """The left join of stored, bucketed sides."""
    return round_doubles(jn.join_stored_sides(*jn.store_join_sides(fx.production(spark, sf), _features(spark, sf))))


def q_partition_overwrite(spark, sf):
    """Features laid out by day; two days are replaced by some of their machines, the others stay."""
    path = rd.scratch_path(spark, f"by-day-{uuid.uuid4().hex}")
    rd.write_dataset(_features(spark, sf), path, partition_by=["agg_date"])
    days = spark.read.parquet(path)
    new = stored(days.where(F.col("agg_date").cast("string").isin("2024-01-05", "2024-01-06") & (F.col("machine_def") < "M00050")))
    rd.write_dataset(new, path, partition_by=["agg_date"], mode="overwrite_partitions")
    return round_doubles(spark.read.parquet(path).withColumn("agg_date", F.col("agg_date").cast("string")))


def q_validate_on_write(spark, sf):
    """Issues gathered while a table is written."""
    path = rd.scratch_path(spark, f"validated-{uuid.uuid4().hex}")
    return _issues(ql.write_validated(fx.customers_with_nan(spark, sf), path, "customer", {"balance": (0.0, 9000.0)}))


def q_stream_history(spark, sf):
    """Readings of a stream kept by key; the stream runs again from the start with its checkpoint lost."""
    base = rd.scratch_path(spark, f"history-{uuid.uuid4().hex}")
    rows = fx.readings_from_events(_events_stream(spark, sf)).drop("variable_attribute")
    keys = ["machine_def", "timestamp", "variable_name"]
    for run in ("first", "again"):
        live.append_history(rows, f"{base}/table", f"{base}/checkpoint-{run}", keys)
    return live.history(spark, f"{base}/table")


def q_sample_file(spark, sf):
    """The first rows of a sorted table as a sample file, read back."""
    path = rd.scratch_path(spark, f"sample-{uuid.uuid4().hex}")
    rd.write_sample(fx.production(spark, sf).select("order_id", "machine_id", "shift").orderBy("order_id"), path, 100)
    return rd.read_csv(spark, path, "order_id long, machine_id string, shift int")


def q_input_gates(spark, sf):
    """Rows that pass a gate on required columns (none, if a column is missing)."""
    p = fx.production(spark, sf)
    gates = {"target and machine": ["actual_scrap_qty", "machine_id"], "cavity": ["actual_scrap_qty", "cavity"]}
    rows = [p.where(F.lit(rd.require_columns(p, needed))).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("gate"), "rows")
            for name, needed in gates.items()]
    return rows[0].unionByName(rows[1])


def q_feature_rules(spark, sf):
    """The features that each rule selects, with their numbers of values."""
    ml, training = _ml_dataset(spark, sf), _training_set(spark, sf)
    chosen = {"baseline": (ml, se.baseline_features(ml)), "risk": (ml, se.risk_features(ml)),
              "sensor": (training, [c for c in md.sensor_features(training) if c != "machine_code"])}
    out = []
    for rule, (df, names) in chosen.items():
        counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(names)])
        out.append(counts.selectExpr(f"stack({len(names)}, " + ", ".join(f"'{c}', n{i}" for i, c in enumerate(names)) + ") AS (feature, `values`)")
                   .select(F.lit(rule).alias("rule"), "feature", "values"))
    return out[0].unionByName(out[1]).unionByName(out[2])


QUERIES.update({
    "repeated_rows": q_repeated_rows,
    "top_order_keys": q_top_order_keys,
    "column_stats_sketched": q_column_stats_sketched,
    "distinct_by_machine": q_distinct_by_machine,
    "bucketed_join": q_bucketed_join,
    "partition_overwrite": q_partition_overwrite,
    "validate_on_write": q_validate_on_write,
    "stream_history": q_stream_history,
    "sample_file": q_sample_file,
    "input_gates": q_input_gates,
    "feature_rules": q_feature_rules,
})
