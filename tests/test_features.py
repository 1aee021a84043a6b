import datetime as dt

import pytest
from pyspark.sql import functions as F

from moldwise.operators import features as feat

SCHEMA = "machine_def string, timestamp string, variable_name string, value string, variable_attribute string"


def _rows():
    d = "2024-01-05"
    return [
        ("M221-10", f"{d} 01:00:00", "Cushion", "1.0", None),
        ("M221-10", f"{d} 02:00:00", "Cushion", "3.0", None),
        ("M221-10", f"{d} 03:00:00", "Cushion", "bad", None),
        ("M221-10", f"{d} 01:00:00", "Time_on_machine", "00:01:30", None),
        ("M221-10", f"{d} 01:00:00", "Machine_status", "B", None),
        ("M221-10", f"{d} 02:00:00", "Machine_status", "A", None),
        ("M221-10", f"{d} 05:00:00", "Shot_counter", "110", None),
        ("M221-10", f"{d} 01:00:00", "Shot_counter", "100", None),
        ("M221-10", f"{d} 03:00:00", "Shot_counter", "105", None),
        ("M221-10", f"{d} 01:00:00", "Cyl_tmp_z2", "0", None),
        ("M221-10", "2024-01-06 01:00:00", "Cushion", "7.0", None),
        ("M221-10", "not a time", "Cushion", "9.0", None),
    ]


def test_daily_features_values(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    out = {r["agg_date"]: r for r in feat.daily_features(df).collect()}
    assert set(out) == {"2024-01-05", "2024-01-06"}
    a = out["2024-01-05"]
    assert a["Cushion_mean"] == 2.0 and a["Cushion_max"] == 3.0 and a["Cushion_count"] == 2
    assert a["Cushion_std"] == pytest.approx(2 ** 0.5)
    assert a["Time_on_machine_mean"] == 90.0
    assert a["Machine_status_mode"] == "A"          # tie -> smallest
    assert a["Shot_counter_first"] == 100.0 and a["Shot_counter_last"] == 110.0
    assert a["Shot_counter_delta"] == 10.0 and a["Shot_counter_count"] == 3
    b = out["2024-01-06"]
    assert b["Cushion_std"] is None                  # one reading
    assert b["Time_on_machine_count"] is None        # no reading of it that day: no statistics at all
    assert b["Shot_counter_count"] is None
    assert "Cyl_tmp_z2_mean" not in a.asDict()       # excluded variable


def test_daily_features_fixed_variables_and_no_date(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    out = feat.daily_features(df, by_date=False, variables=["Cushion"]).collect()
    # without the day key the row with an unparseable timestamp still counts
    assert len(out) == 1 and out[0]["Cushion_count"] == 4
    assert out[0].asDict().keys() == {"machine_def", "Cushion_mean", "Cushion_max", "Cushion_std", "Cushion_count"}


def test_counter_tie_uses_value(spark):
    rows = [("M1-10", "2024-01-05 01:00:00", "Shot_counter", "7", None),
            ("M1-10", "2024-01-05 01:00:00", "Shot_counter", "5", None)]
    r = feat.daily_features(spark.createDataFrame(rows, SCHEMA)).first()
    assert (r["Shot_counter_first"], r["Shot_counter_last"]) == (5.0, 7.0)


def test_daily_scrap_takes_max(spark):
    raw = spark.createDataFrame([
        (dt.date(2024, 1, 1), "M-1", "T", "P", 10.0), (dt.date(2024, 1, 1), "M-1", "T", "P", 30.0),
        (dt.date(2024, 1, 1), None, "T", "P", 99.0)],
        "date date, machine_nr string, tool_number string, article string, actual_scrap_qty double")
    out = feat.daily_scrap(raw).collect()
    assert len(out) == 1 and out[0]["scrap_quantity"] == 30.0


def test_sensor_means_and_vertical(spark):
    rows = [("1/5/2024", "M231-11", "Cushion", "2"), ("1/5/2024", "M231-11", "Cushion", "4"),
            ("1/5/2024", "M231-11", "Cushion", "x")]
    df = spark.createDataFrame(rows, "date string, machine_definition string, variable_name string, value string")
    m = feat.sensor_means(df).first()
    assert m["machine_id"] == "M-231" and m["Cushion"] == 3.0 and m["date"] == dt.date(2024, 1, 5)
    v = feat.vertical_features(df).first()
    assert v["machine_id"] == "M231" and v["Cushion_min"] == 2.0 and v["Cushion_max"] == 4.0


def test_split_blocks_same_result(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    one = {r["agg_date"]: r.asDict() for r in feat.daily_features(df).collect()}
    blocks = {r["agg_date"]: r.asDict() for r in feat.daily_features(df, split_blocks=True).collect()}
    assert one.keys() == blocks.keys()
    for k in one:
        for c, v in one[k].items():
            w = blocks[k][c]
            assert (v is None and w is None) or v == pytest.approx(w), (k, c)


def test_variable_names_with_dots_and_blanks(spark):
    rows = [("M1-10", "2024-01-05 01:00:00", "Temp.zone 1", "2.0", None),
            ("M1-10", "2024-01-05 02:00:00", "Temp.zone 1", "4.0", None)]
    out = feat.daily_features(spark.createDataFrame(rows, SCHEMA)).first().asDict()
    assert out["Temp.zone 1_mean"] == 3.0 and out["Temp.zone 1_count"] == 2
    both = feat.daily_features(spark.createDataFrame(rows, SCHEMA), split_blocks=True).first().asDict()
    assert both["Temp.zone 1_max"] == 4.0


def test_dates_of_either_layout_and_bad_ones(spark):
    rows = [("1/5/2024", "M231-11", "Cushion", "2"), ("2024-01-05", "M231-11", "Cushion", "4")]
    schema = "date string, machine_definition string, variable_name string, value string"
    df = spark.createDataFrame(rows, schema)
    assert feat.vertical_features(df).first()["Cushion_mean"] == 3.0
    assert feat.sensor_means(df, date_format="M/d/yyyy", strict_dates=False).count() == 1  # the ISO row is left out
    bad = spark.createDataFrame([*rows, ("5 Jan", "M231-11", "Cushion", "4")], schema)
    for job in (lambda: feat.vertical_features(bad).collect(), lambda: feat.sensor_means(bad, variables=["Cushion"]).collect()):
        with pytest.raises(Exception, match="cannot parse '5 Jan'"):
            job()
    raw = spark.createDataFrame([("nope", "M-1", "T", "A", 1.0)], "date string, machine_nr string, tool_number string, article string, actual_scrap_qty double")
    with pytest.raises(Exception, match="cannot parse 'nope'"):
        feat.daily_scrap(raw).collect()
    assert feat.daily_scrap(raw, strict_dates=False).count() == 0


def test_nan_is_missing(spark):
    nan = float("nan")
    raw = spark.createDataFrame([("2024-01-05", "M-1", "T", "A", x) for x in (5.0, nan)] + [("2024-01-06", "M-1", "T", "A", nan)],
                                "date string, machine_nr string, tool_number string, article string, actual_scrap_qty double")
    assert sorted((str(r["date"]), r["scrap_quantity"]) for r in feat.daily_scrap(raw).collect()) == [("2024-01-05", 5.0), ("2024-01-06", None)]


def test_variable_sets_without_a_bound(spark):
    rows = [("M1-10", "2024-01-05 01:00:00", f"v{i}", str(i), None) for i in range(2500)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert len(feat.discover_values(df, "variable_name")) == 2500
    with pytest.raises(ValueError):
        feat.discover_values(df, "variable_name", limit=2000)
    assert feat.long_features(df).count() == 2500
