import pytest
from pyspark.sql import functions as F

from moldwise.operators import metrics as mt
from moldwise.operators import selection as se
from moldwise.operators import summaries as sm


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 2.0)], "y double, p double")
    r = mt.regression_metrics(df, "y", "p").first()
    assert r["mae"] == pytest.approx(4 / 3) and r["rmse"] == pytest.approx((10 / 3) ** 0.5)
    assert r["y_std"] == pytest.approx((8 / 3) ** 0.5) and r["y_range"] == 4.0
    b = mt.naive_baseline(df.where("y < 4"), df, "y").first()
    assert b["mean_prediction"] == 2.0 and b["mae"] == pytest.approx(5 / 3)


def test_classification_metrics(spark):
    rows = [(1, 1), (1, 0), (0, 0), (0, 0), (0, 1)]
    df = spark.createDataFrame(rows, "y int, p int")
    cm = {(r["actual"], r["predicted"]): r["count"] for r in mt.confusion_matrix(df, "y", "p").collect()}
    assert cm == {(0, 0): 2, (0, 1): 1, (1, 0): 1, (1, 1): 1}
    m = {r["class"]: r for r in mt.classification_metrics(df, "y", "p").collect()}
    assert m["1"]["precision"] == 0.5 and m["1"]["recall"] == 0.5 and m["1"]["support"] == 2
    assert m["0"]["recall"] == pytest.approx(2 / 3)
    assert m["accuracy"]["f1"] == pytest.approx(0.6)


def test_feature_selection_rules(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, "x", 4, 5.0, 6.0)],
                               "shift int, Cushion_mean double, actual_scrap_qty double, article string, "
                               "order_id long, Scrap_counter_max double, Pressure double")
    assert se.baseline_features(df) == ["Cushion_mean", "Pressure", "order_id", "shift"]
    assert se.risk_features(df) == ["shift", "Cushion_mean", "order_id", "Pressure"]
    assert se.select_features(df, drop_substrings=["actual", "shift"]) == ["Cushion_mean", "Pressure", "Scrap_counter_max", "order_id"]
    assert se.select_features(df, ignore=["shift"], first="Pressure", sort=False)[0] == "Pressure"


def test_coerce_and_fill(spark):
    df = spark.createDataFrame([("1.5", "a", None, True), ("x", "b", 2.0, False), (None, "c", 4.0, True),
                                ("3", "d", None, None)], "s string, t string, v double, flag boolean")
    c = se.coerce_numeric_frame(df)
    assert c.columns == ["s", "v"]                        # t has no number at all; booleans are not numbers
    assert [r["s"] for r in c.collect()] == [1.5, 0.0, 0.0, 3.0]
    f = se.fill_median(df.select("v"), ["v"]).collect()  # median of 2 and 4
    assert [r["v"] for r in f] == [3.0, 2.0, 4.0, 3.0]


def test_label_high_risk(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 3.0, 4.0, None]], "q double")
    got = [r["high_scrap_risk"] for r in se.label_high_risk(df, "q").collect()]
    assert got == [0, 0, 0, 1, 0]                                     # q75 = 3.25, strict, NULL -> 0


def test_summaries(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "v string")
    top = sm.top_values(df, "v", 1).collect()
    assert len(top) == 1 and top[0]["value"] == "a" and top[0]["pct"] == 50.0
    full = {r["value"]: r["rank"] for r in sm.top_values(df, "v", None).collect()}
    assert full == {"a": 1, "b": 2}
    miss = {r["column"]: r["missing_pct"] for r in sm.column_missing(df, 2).collect()}
    assert miss == {"v": 25.0}
    assert sm.rounded_pct is not None
    v = spark.createDataFrame([(1, 7)], "p long, w long").select(sm.rounded_pct(F.col("p"), F.col("w"), 2).alias("x"))
    assert v.first()["x"] == 14.29
