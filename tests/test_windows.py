import datetime as dt

from moldwise.operators import windows as wn

SCHEMA = "date date, machine_id string, tool_id string, part_number string, scrap_quantity double"


def _daily(spark):
    d = dt.date(2024, 1, 1)
    rows = [(d + dt.timedelta(days=i), "M-1", "T", "P", float(v)) for i, v in zip([0, 1, 3, 4, 9], [10, 20, 30, 40, 50])]
    rows += [(d, "M-2", "T", "P", 5.0), (d + dt.timedelta(days=1), "M-2", "T", "P", 6.0)]
    return spark.createDataFrame(rows, SCHEMA)


def test_lags_are_previous_rows(spark):
    out = wn.lag_features(_daily(spark), drop_incomplete=False).where("machine_id = 'M-1'").orderBy("date").collect()
    assert [r["scrap_lag_1"] for r in out] == [None, 10.0, 20.0, 30.0, 40.0]
    assert [r["scrap_lag_2"] for r in out] == [None, None, 10.0, 20.0, 30.0]
    assert [r["rolling_avg_3"] for r in out] == [None, None, 20.0, 30.0, 40.0]
    clean = wn.lag_features(_daily(spark))
    assert clean.count() == 3  # warm-up rows dropped; M-2 has only two rows


def test_scoring_context_needs_three_rows(spark):
    ctx = wn.scoring_context(_daily(spark)).collect()
    assert len(ctx) == 1
    r = ctx[0]
    assert (r["scrap_lag_1"], r["scrap_lag_2"], r["rolling_avg_3"]) == (50.0, 40.0, 40.0)
    assert r["forecast_date"] == dt.date(2024, 1, 11)
    assert wn.scoring_context(_daily(spark), min_history=5).count() == 1
    assert wn.scoring_context(_daily(spark), min_history=6).count() == 0


def test_time_split_cut(spark):
    out = wn.time_split(_daily(spark))
    dates = sorted({r["date"] for r in out.collect()})          # 5 distinct dates -> cut at index 4
    test_dates = {r["date"] for r in out.where("split = 'test'").collect()}
    assert test_dates == {dates[4]}


def test_label_encode_unseen_zero(spark):
    daily = _daily(spark)
    live = spark.createDataFrame([("M-2",), ("M-9",)], "machine_id string")
    got = {r["machine_id"]: r["machine_code"]
           for r in wn.label_encode(live, {"machine_id": "machine_code"}, unseen=0, codes_from=daily).collect()}
    assert got == {"M-2": 1, "M-9": 0}


def test_planning_and_most_active(spark):
    daily = _daily(spark)
    k = {r["machine_id"]: r for r in wn.planning_kpis(daily).collect()}
    assert k["M-1"]["avg_scrap_24h"] == 30.0 and k["M-1"]["avg_scrap_12h"] == 15.0 and k["M-1"]["max_scrap"] == 50.0
    top = wn.most_active_job(daily).first()
    assert top["machine_id"] == "M-1" and top["rows"] == 5


def test_forecast_split_equals_two_step(spark):
    daily = _daily(spark)
    a = {(r["date"], r["machine_id"]): (r["split"], r["machine_code"])
         for r in wn.time_split(wn.forecast_features(daily)).collect()}
    b = {(r["date"], r["machine_id"]): (r["split"], r["machine_code"]) for r in wn.forecast_split(daily).collect()}
    assert a == b and a
