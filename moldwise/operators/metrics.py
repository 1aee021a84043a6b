"""Model evaluation metrics computed with aggregates over prediction tables.

Inputs are DataFrames holding a label column and a prediction column, so a
metric is one aggregate pass whatever the table size; class-level metrics
come from the confusion counts (one row per (label, prediction) pair).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moldwise.session import reliable_checkpoint


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def naive_baseline(train: DataFrame, test: DataFrame, target: str) -> DataFrame:
    """Predict the training mean for every test row: MAE and RMSE."""
    m = train.select(F.avg(_q(target))).scalar()
    e = _q(target) - m
    return test.agg(F.first(m).alias("mean_prediction"), F.avg(F.abs(e)).alias("mae"),
                    F.sqrt(F.avg(e * e)).alias("rmse"))


def regression_metrics(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """MAE, RMSE, MAE as % of the label mean, and the label's mean,
    population std and range (rows where both values are present)."""
    y, p = _q(label), _q(prediction)
    d = pred.where(y.isNotNull() & p.isNotNull())
    e = p - y
    a = d.agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(y).alias("y_mean"),
              F.stddev_pop(y).alias("y_std"), (F.max(y) - F.min(y)).cast("double").alias("y_range"),
              F.count(F.lit(1)).alias("n"))
    return a.select("n", "mae", "rmse", (F.try_divide(F.col("mae"), F.col("y_mean")) * 100).alias("mae_pct_of_mean"),
                    "y_mean", "y_std", "y_range")


def _pair_counts(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    """(actual, predicted, count): the one pass over the predictions, kept for
    everything that is derived from it."""
    return reliable_checkpoint(pred.groupBy(_q(label).alias("actual"), _q(prediction).alias("predicted")).agg(
        F.count(F.lit(1)).alias("count")))


def _classes(counts: DataFrame) -> DataFrame:
    both = counts.select(F.col("actual").alias("cls")).union(counts.select(F.col("predicted").alias("cls")))
    return both.where(F.col("cls").isNotNull()).distinct()


def confusion_matrix(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """(actual, predicted, count) for every pair of classes seen in either
    column, zero cells included (the matrix itself is classes squared)."""
    counts = _pair_counts(pred, label, prediction)
    every = _classes(counts).agg(F.array_sort(F.collect_list("cls")).alias("all"))
    grid = every.select(F.explode("all").alias("actual"), "all").select("actual", F.explode("all").alias("predicted"))
    return grid.join(counts, ["actual", "predicted"], "left") \
        .select("actual", "predicted", F.coalesce("count", F.lit(0)).alias("count"))


def classification_metrics(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Per class: precision, recall, F1 and support (0 when undefined), plus
    ``accuracy``, ``macro avg`` and ``weighted avg`` rows (as in a
    classification report; accuracy is in the f1 column)."""
    cm = _pair_counts(pred, label, prediction).where("actual is not null and predicted is not null")
    per = cm.groupBy(F.col("actual").alias("cls")).agg(
        F.sum("count").alias("support"), F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("count"))).alias("tp"))
    pcount = cm.groupBy(F.col("predicted").alias("cls")).agg(F.sum("count").alias("predicted_n"))
    m = _classes(cm).join(per, "cls", "left").join(pcount, "cls", "left").na.fill(0, ["support", "tp", "predicted_n"])
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("predicted_n")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    m = m.select(F.col("cls").cast("string").alias("class"), prec.alias("precision"), rec.alias("recall"),
                 F.col("support").cast("bigint").alias("support"), F.col("tp"))
    m = m.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                   F.col("precision") + F.col("recall")), F.lit(0.0)))
    tot = m.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"), F.avg("precision").alias("mp"),
                F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                F.try_divide(F.sum(F.col("precision") * F.col("support")), F.sum("support")).alias("wp"),
                F.try_divide(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("wr"),
                F.try_divide(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("wf"))
    acc = tot.select(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), F.col("n").cast("bigint").alias("support"),
                     F.try_divide(F.col("tp"), F.col("n")).alias("f1"))
    macro = tot.select(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                       F.col("n").cast("bigint").alias("support"), F.col("mf").alias("f1"))
    weighted = tot.select(F.lit("weighted avg").alias("class"), F.col("wp").alias("precision"),
                          F.col("wr").alias("recall"), F.col("n").cast("bigint").alias("support"),
                          F.col("wf").alias("f1"))
    cols = ["class", "precision", "recall", "f1", "support"]
    return m.select(*cols).unionByName(acc.select(*cols)).unionByName(macro.select(*cols)) \
        .unionByName(weighted.select(*cols))
