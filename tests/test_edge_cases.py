"""Edge cases listed for the fixtures: counter reset, duplicate feature keys,
empty inputs, blank values, and the small inline validation samples."""

import datetime as dt

from moldwise.operators import features as feat
from moldwise.operators import joins as jn
from moldwise.operators import quality as ql
from moldwise.operators import summaries as sm

READ = "machine_def string, timestamp string, variable_name string, value string, variable_attribute string"


def test_counter_reset_gives_negative_delta(spark):
    rows = [("M1-10", "2024-01-05 01:00:00", "Scrap_counter", "500", None),
            ("M1-10", "2024-01-05 02:00:00", "Scrap_counter", "20", None)]
    r = feat.daily_features(spark.createDataFrame(rows, READ)).first()
    assert r["Scrap_counter_delta"] == -480.0


def test_blank_values_are_not_numbers(spark):
    rows = [("M1-10", "2024-01-05 01:00:00", "Cushion", "", None),
            ("M1-10", "2024-01-05 02:00:00", "Cushion", "  ", None),
            ("M1-10", "2024-01-05 03:00:00", "Cushion", "7", None)]
    r = feat.daily_features(spark.createDataFrame(rows, READ)).first()
    assert r["Cushion_count"] == 1 and r["Cushion_mean"] == 7.0


def test_duplicate_feature_key_keeps_production_rows(spark):
    prod = spark.createDataFrame([(1, "M-221", "2024-01-05", 3.0), (2, "M-221", "2024-01-05", 4.0)],
                                 "order_id long, machine_id string, date string, actual_scrap_qty double")
    feats = spark.createDataFrame([("M221-10", "2024-01-05", 1.0), ("M221-10", "2024-01-05", 2.0)],
                                  "machine_def string, agg_date string, Cushion_mean double")
    out = jn.join_production_features(prod, feats).collect()
    assert len(out) == 2 and {r["Cushion_mean"] for r in out} == {1.0}   # one feature row per key (smallest)
    rep = {r["metric"]: r["value"] for r in jn.join_report(prod, feats).collect()}
    assert rep["param_rows_before"] == 2 and rep["duplicate_joins"] == 1


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], READ)
    assert feat.daily_features(empty, variables=["Cushion"]).count() == 0
    assert ql.check_missing(empty).count() == 0
    assert ql.check_duplicates(empty).count() == 0
    rep = ql.validation_report(ql.validate_readings(empty), empty, "ParamData").first()
    assert rep["row_count"] == 0 and rep["critical_count"] == 1
    assert sm.profile_readings(empty).first()["rows"] == 0


def test_inline_validation_samples(spark):
    prod = spark.createDataFrame([(f"job-{i}", "M-7", i % 2 + 1, 40 + i, float(2 * i)) for i in range(7)],
                                 "order_id string, machine_id string, shift int, production_qty int, actual_scrap_qty double")
    issues = {(r["issue_type"], r["severity"]) for r in ql.validate_production(prod).collect()}
    assert ("insufficient_data", "critical") in issues
    assert not any(t == "outliers" for t, _ in issues)
    start = dt.datetime(2031, 5, 4)
    vals = [float(i % 9) for i in range(40)]
    readings = spark.createDataFrame(
        [("M7-10", start + dt.timedelta(hours=i), "heat" if i % 2 == 0 else "load", str(v), None)
         for i, v in enumerate(vals)], "machine_def string, timestamp timestamp, variable_name string, value string, "
                                       "variable_attribute string")
    got = {(r["issue_type"], r["column"]) for r in ql.validate_readings(readings).collect()}
    assert ("insufficient_data", None) in got and ("missing_values", "variable_attribute") in got
    rep = ql.validation_report(ql.validate_readings(readings), readings, "ParamData").first()
    assert not rep["is_valid"]
