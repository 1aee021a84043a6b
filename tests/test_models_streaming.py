import datetime as dt

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Observation
from pyspark.sql import functions as F

from moldwise.operators import models as md
from moldwise.operators import windows as wn
from moldwise.streaming import live


def _signal(spark, n=400):
    # y depends on x1 only; x2 is noise
    return spark.range(0, n).select(
        F.col("id"), (F.col("id") % 10).cast("double").alias("x1"), ((F.col("id") * 7) % 13).cast("double").alias("x2"),
    ).withColumn("y", F.col("x1") * 10.0)


def test_rf_beats_naive_and_importance(spark):
    df = _signal(spark)
    train, test = df.where("id % 5 != 0"), df.where("id % 5 = 0")
    model = md.train_rf_regressor(train, ["x1", "x2"], "y", num_trees=10, max_depth=5)
    rep = md.regression_report(model, train, test, "y").first()
    assert rep["mae"] < rep["baseline_mae"]
    imp = md.feature_importance(model, ["x1", "x2"]).collect()
    assert imp[0]["feature"] == "x1" and abs(imp[-1]["cumulative_importance"] - 1.0) < 1e-9


def test_classifier_cv_and_compare(spark):
    df = _signal(spark, 300).withColumn("label", (F.col("x1") > 6).cast("int"))
    cv = {r["fold"]: r for r in md.cross_validate(
        df, ["x1", "x2"], "label", ["id"], 3,
        make=lambda t: md.train_rf_classifier(t, ["x1", "x2"], "label", num_trees=5, max_depth=4)).collect()}
    assert cv["mean"]["accuracy"] > 0.9 and cv["mean"]["verdict"] in ("signal", "strong")


def _daily(spark):
    d = dt.date(2024, 1, 1)
    rows = [(d + dt.timedelta(days=i), m, "T", "P", float(10 * i + (5 if m == "M-2" else 0)))
            for i in range(12) for m in ("M-1", "M-2")]
    return spark.createDataFrame(rows, "date date, machine_id string, tool_id string, part_number string, "
                                       "scrap_quantity double")


def test_forecaster_save_load_and_unseen(spark, tmp_path):
    daily = _daily(spark)
    model = md.train_forecaster(wn.lag_features(daily), max_iter=5)
    model.save(str(tmp_path / "fc"))
    back = md.CodedModel.load(spark, str(tmp_path / "fc"))
    fc = md.forecast_next_day(back, daily).collect()
    assert len(fc) == 2 and all(r["forecast_date"] == dt.date(2024, 1, 13) for r in fc)
    unseen = daily.withColumn("machine_id", F.concat(F.col("machine_id"), F.lit("x")))
    enc = back.encode(wn.scoring_context(unseen), unseen=0).collect()
    assert {r["machine_code"] for r in enc} == {0}


def test_stream_features_equal_batch_for_closed_days(spark, tmp_path):
    from moldwise.operators import features as feat

    rows = [("M1-10", dt.datetime(2024, 1, d, h), "Cushion", str(float(d + h))) for d in range(1, 6) for h in (1, 5)]
    schema = "machine_def string, timestamp timestamp, variable_name string, value string"
    src = tmp_path / "feed"
    spark.createDataFrame(rows, schema).write.parquet(str(src))
    stream = live.file_stream(spark, str(src), spark.read.parquet(str(src)).schema)
    out = live.stream_daily_features(stream, ["Cushion"])
    live.run_available_now(out, str(tmp_path / "out"), str(tmp_path / "ck"))
    got = {r["agg_date"]: r["Cushion_mean"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = {r["agg_date"]: r["Cushion_mean"]
             for r in feat.daily_features(spark.createDataFrame(rows, schema), variables=["Cushion"]).collect()}
    # watermark = last event (Jan 5 05:00) - 1 day: days ending by Jan 4 05:00 are closed
    assert set(got) == {"2024-01-01", "2024-01-02", "2024-01-03"}
    assert all(batch[k] == v for k, v in got.items())


def test_stream_score_and_alerts(spark, tmp_path):
    df = _signal(spark, 200).withColumn("machine_id", F.lit("M-1"))
    codes = md.code_tables(df, {"machine_id": "machine_code"})
    cm = md.CodedModel(None, codes, ["machine_code", "x1", "x2"])
    cm.model = md.train_gbt_regressor(cm.encode(df, None), cm.features, "y", max_iter=3)
    src = tmp_path / "rows"
    df.drop("y").withColumn("machine_id", F.lit("M-new")).write.parquet(str(src))
    feed = live.file_stream(spark, str(src), spark.read.parquet(str(src)).schema)
    scored = live.stream_score(feed, cm, threshold=40.0)
    live.run_available_now(scored, str(tmp_path / "o"), str(tmp_path / "c"))
    res = spark.read.parquet(str(tmp_path / "o"))
    assert res.count() == 200
    r = res.first()
    assert abs(r["pred_12h"] * 2 - r["pred_24h"]) < 1e-9
    assert res.where("status = 'HIGH RISK'").count() == live.stream_alerts(res, 40.0).count()


def test_stream_restart_and_late_rows(spark, tmp_path):
    schema = "machine_def string, timestamp timestamp, variable_name string, value string"
    src, out, ck = tmp_path / "feed", tmp_path / "out", tmp_path / "ck"
    first = [("M1-10", dt.datetime(2024, 1, d, 12), "Cushion", str(float(d))) for d in range(1, 6)]
    spark.createDataFrame(first, schema).coalesce(1).write.mode("append").parquet(str(src))

    def run():
        stream = live.file_stream(spark, str(src), spark.read.parquet(str(src)).schema)
        live.run_available_now(live.stream_daily_features(stream, ["Cushion"]), str(out), str(ck))
        return {r["agg_date"]: r["Cushion_count"] for r in spark.read.parquet(str(out)).collect()}

    got1 = run()
    assert set(got1) == {"2024-01-01", "2024-01-02", "2024-01-03"}      # watermark Jan 4 12:00
    # second batch: a row for Jan 1 (behind the watermark: dropped) and new days
    late = [("M1-10", dt.datetime(2024, 1, 1, 13), "Cushion", "9.0"),
            ("M1-10", dt.datetime(2024, 1, 9, 12), "Cushion", "9.0")]
    spark.createDataFrame(late, schema).coalesce(1).write.mode("append").parquet(str(src))
    got2 = run()                                                         # resumes from the checkpoint
    assert got2["2024-01-01"] == 1                                       # late row not counted, day emitted once
    assert set(got2) == {"2024-01-0%d" % d for d in range(1, 6)}         # watermark now Jan 8 12:00


def test_model_parameters(spark):
    rows = spark.createDataFrame([(float(i % 7), float(i % 3), float(i % 2)) for i in range(60)], "a double, b double, y double")
    forest = md.train_rf_regressor(rows, ["a", "b"], "y", num_trees=2).stages[-1]
    assert forest.getOrDefault("featureSubsetStrategy") == "all" and forest.getOrDefault("maxDepth") == 30
    assert md.train_rf_classifier(rows, ["a", "b"], "y", num_trees=2).stages[-1].getOrDefault("maxDepth") == 30
    assert md.train_gbt_classifier(rows, ["a", "b"], "y", max_iter=1).stages[-1].getOrDefault("maxDepth") == 3
    boosted = md.train_gbt_regressor(rows, ["a", "b"], "y", max_iter=1).stages[-1]
    assert boosted.getOrDefault("maxDepth") == 6 and boosted.getOrDefault("stepSize") == 0.1
    assert md.train_logistic(rows, ["a", "b"], "y").stages[-1].getOrDefault("regParam") == pytest.approx(1 / 60)


def test_balanced_weights_of_many_classes(spark):
    rows = spark.range(3000).select((F.col("id") % 1500).alias("y"))
    got = md.balanced_weights(rows, "y").agg(F.min("weight").alias("a"), F.max("weight").alias("b"), F.count("*").alias("n")).first()
    assert (got["a"], got["b"], got["n"]) == (1.0, 1.0, 3000)


def test_an_unfinished_stream_is_an_error(spark, tmp_path):
    spark.range(1000).repartition(50).write.parquet(str(tmp_path / "in"))
    feed = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    with pytest.raises(TimeoutError):
        live.run_available_now(feed, str(tmp_path / "out"), str(tmp_path / "ckpt"), timeout_s=1)


def test_classifiers_score_after_an_observation(spark):
    df = _signal(spark, 200).withColumn("label", (F.col("x1") > 6).cast("int"))
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).collect()
    assert seen.get["rows"] == 200  # from here on the session itself can't be sent to tasks
    for model in (md.train_rf_classifier(df, ["x1", "x2"], "label", num_trees=3, max_depth=4), md.train_logistic(df, ["x1", "x2"], "label")):
        assert md.balanced_accuracy(model.transform(df), "label") > 0.9


def test_boosting_over_binned_means_is_that_of_all_rows(spark):
    rows = [(float(i % 40), float(i * 7 % 5), 1.0, float(i * i % 23 + i % 40)) for i in range(600)]
    df = spark.createDataFrame(rows, "a double, b double, same double, y double")
    cutter, means = md.binned_means(df, ["a", "b", "same"], "y")
    assert means.count() < 600 and means.agg(F.sum("weight")).first()[0] == 600
    model = md.train_gbt_regressor(df, ["a", "b", "same"], "y", max_iter=5)
    plain = GBTRegressor(labelCol="y", maxIter=5, stepSize=0.1, maxDepth=6, maxBins=md.BINS + 2, seed=42)
    cut = cutter.transform(df).select("a", "b", "same", "y", *[F.col(c).alias(c, metadata={}) for c in cutter.getOutputCols()])
    every = md._assembler(cutter.getOutputCols()).transform(cut)
    want = plain.fit(every).transform(every).withColumnRenamed("prediction", "want")
    got = model.transform(want.drop("features", *cutter.getOutputCols()))
    assert got.where(F.abs(F.col("prediction") - F.col("want")) > 1e-6).isEmpty()


def test_a_fit_uses_every_core(spark):
    cores = spark.sparkContext.defaultParallelism
    assert md.dealt(_signal(spark, cores * md.ROWS_WORTH).coalesce(1)).rdd.getNumPartitions() == cores
    assert md.dealt(_signal(spark, 100)).rdd.getNumPartitions() == 1  # not worth more


def _many_to_a_cell(spark, n=4000):
    """Rows of few combinations of features, one of them missing at times; labels differ within a combination."""
    rows = [(i, float(i % 12), None if i % 8 == 7 else float(i * 7 % 5), float(i % 12 * 3 + i * 7 % 5 + i * i % 4), int(i % 12 > 7) if i % 50 else 1) for i in range(n)]
    return spark.createDataFrame(rows, "id long, a double, b double, y double, label int")


def test_forests_over_cells_do_as_those_over_rows(spark, monkeypatch):
    df = _many_to_a_cell(spark)
    assert md.cells(df, ["a", "b"], "label") is None  # few rows go as they are
    monkeypatch.setattr(md, "CELLS_FROM", 100)
    assert md.cells(df, ["id"], "label", by_label=False) is not None and md.cells(df.where("id < 400"), ["id"], "label") is None
    for train, label, score in ((md.train_rf_classifier, "label", lambda p: md.balanced_accuracy(p, "label")),
                                (md.train_rf_regressor, "y", lambda p: -p.agg(F.avg(F.abs(F.col("prediction") - F.col("y")))).first()[0])):
        scores, models = [], []
        for least in (100, 1 << 60):
            monkeypatch.setattr(md, "CELLS_FROM", least)
            model = train(df.where("b is not null"), ["a", "b"], label, num_trees=8, max_depth=6)
            pred = md.scored(model, df)
            assert pred.columns == [*df.columns, "prediction"] and pred.count() == df.count()
            same = pred.withColumnRenamed("prediction", "joined").join(model.transform(df).select("id", "prediction"), "id")
            assert same.where("joined = prediction").count() == df.count()
            scores.append(score(pred))
            models.append(model)
        by_cells, by_rows = (m.stages[-1] for m in models)
        assert abs(scores[0] - scores[1]) < 0.05 and type(by_cells) is type(by_rows)
        assert by_cells.getNumTrees == 8 and len({t.toDebugString for t in by_cells.trees}) > 1
        assert abs(by_cells.featureImportances[0] - by_rows.featureImportances[0]) < 0.1


def test_a_cells_rows_are_drawn_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(md, "CELLS_FROM", 100)
    df = _many_to_a_cell(spark, 6000).na.fill(0.0)
    by_class = md._class_bags(md.cells(df, ["a", "b"], "label"), 30, 1)
    row = by_class.agg(F.sum("rows"), *[F.sum(f"drawn{t}") for t in range(30)]).first()
    assert row[0] == 6000 and all(abs(n - 6000) < 6 * 6000**0.5 for n in row[1:]) and len(set(row[1:])) > 20
    found = md.cells(df, ["a", "b"], "y", by_label=False)
    drawn = np.array(md._value_bags(found, 30, 1).select(*[f"drawn{t}" for t in range(30)]).collect())
    assert abs(drawn.sum() - 180000) < 6 * 180000**0.5
    assert 3000 < drawn.var(axis=1).sum() < 12000  # of rows drawn one by one 6000, of whole cells some hundred times that
    total = md._value_bags(found, 30, 1).select(F.sum(F.col("drawn0") * F.col("mean0"))).first()[0]
    assert abs(total / df.agg(F.sum("y")).first()[0] - 1) < 0.1


def test_boosted_classes_over_cells_are_those_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(md, "CELLS_FROM", 100)
    df = _many_to_a_cell(spark).na.fill(0.0)
    model = md.train_gbt_classifier(df, ["a", "b"], "label", max_iter=5)
    monkeypatch.setattr(md, "CELLS_FROM", 1 << 60)
    cut = model.stages[0].transform(df).select("id", "label", *[F.col(c).alias(c, metadata={}) for c in model.stages[0].getOutputCols()])
    want = md.train_gbt_classifier(cut, model.stages[0].getOutputCols(), "label", max_iter=5).transform(cut).select("id", F.col("prediction").alias("want"))
    assert md.scored(model, df).join(want, "id").where("prediction != want").isEmpty()
