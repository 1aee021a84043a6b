from pyspark.sql import functions as F

from moldwise.operators import joins as jn

PROD = "order_id long, machine_id string, date string, actual_scrap_qty double"
FEAT = "machine_def string, agg_date string, Cushion_mean double"


def _data(spark):
    prod = spark.createDataFrame([
        (1, "M-221", "05-01-2024", 10.0), (2, "M-221", "05-01-2024", 20.0), (3, "M-221", "06-01-2024", None),
        (4, "M-999", "05-01-2024", 5.0), (5, "M-221", "bad", 1.0)], PROD)
    feats = spark.createDataFrame([
        ("M221-10", "2024-01-05", 1.5), ("M221-11", "2024-01-05", 9.9), ("M221-10", "2024-01-07", 2.5)], FEAT)
    return prod, feats


def test_standardize_date_detects_dmy(spark):
    prod, _ = _data(spark)
    got = {r["order_id"]: r["date_key"] for r in jn.standardize_date(prod, "date").collect()}
    assert got[1] == "2024-01-05" and got[3] == "2024-01-06" and got[5] is None


def test_standardize_date_iso_rejects_trailing_time(spark):
    df = spark.createDataFrame([("2024-01-05",), ("2024-01-06 10:00",)], "d string")
    got = [r["date_key"] for r in jn.standardize_date(df, "d").collect()]
    assert got == ["2024-01-05", None]


def test_map_machines_core_and_smallest(spark):
    prod, feats = _data(spark)
    m = {r["production_id"]: r["feature_id"] for r in jn.map_machines(prod, feats).collect()}
    assert m == {"M-221": "M221-10"}


def test_left_and_inner_join(spark):
    prod, feats = _data(spark)
    left = jn.join_production_features(prod, feats, keep_unmatched=True, indicator=True)
    rows = {r["order_id"]: r for r in left.collect()}
    assert len(rows) == 5
    assert rows[1]["Cushion_mean"] == 1.5 and rows[1]["_matched"]
    assert rows[4]["machine_key"] is None and not rows[4]["_matched"]
    inner = jn.join_production_features(prod, feats, keep_unmatched=False)
    assert sorted(r["order_id"] for r in inner.collect()) == [1, 2]


def test_join_report_invariants(spark):
    prod, feats = _data(spark)
    rep = {r["metric"]: r["value"] for r in jn.join_report(prod, feats).collect()}
    assert rep["hydra_rows_before"] == 5 and rep["joined_rows"] == 5
    assert rep["matched_hydra_rows"] == 2 and rep["unmatched_hydra_rows"] == 3
    assert rep["target_non_null_before"] == rep["target_non_null_after"] == 4
    assert rep["overlapping_dates"] == 1


def test_dedupe_keys_keeps_smallest(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k string, v int, w string")
    got = {r["k"]: (r["v"], r["w"]) for r in jn.dedupe_keys(df, ["k"]).collect()}
    assert got == {"a": (1, "y"), "b": (5, "z")}


def test_date_overlap_and_union(spark):
    a = spark.createDataFrame([("2024-01-01",), ("2024-01-02",)], "date_key string")
    b = spark.createDataFrame([("2024-01-02",), ("2024-01-03",)], "date_key string")
    got = {r["date_key"]: r["status"] for r in jn.date_overlap(a, b).collect()}
    assert got == {"2024-01-01": "unmatched", "2024-01-02": "matched", "2024-01-03": "features_only"}
    u = jn.union_datasets([a.withColumn("x", F.lit(1)), b])
    assert u.count() == 4 and u.where("x IS NULL").count() == 2
