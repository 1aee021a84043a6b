"""Model training, evaluation and scoring with Spark ML.

Training data stay distributed: features are assembled with a
``VectorAssembler`` inside a ``Pipeline`` and the estimators are Spark ML's
tree ensembles and logistic regression.  The driver only holds small
things: class counts (for balanced weights), feature importances (one value
per feature) and per-fold scores.  Label codes are stored as code tables
next to the model, so values unseen at training time can be mapped to a
fixed code (0) with a left join instead of failing.
"""

from __future__ import annotations

import json
import statistics
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moldwise.functions.columns import risk_status
from moldwise.operators.metrics import classification_metrics, naive_baseline, regression_metrics
from moldwise.operators.ranking import CodeTable, dense_codes_multi, join_codes
from moldwise.operators.selection import SENSOR_IGNORE
from moldwise.operators.splits import row_split, stratified_folds
from moldwise.operators.windows import JOB_KEYS, scoring_context
from moldwise.session import checkpoint_dir, reliable_checkpoint, stored

# Inputs of the next-day forecaster, in model order.
FORECAST_FEATURES = ["machine_code", "tool_code", "part_code", "scrap_lag_1", "scrap_lag_2", "rolling_avg_3"]
JOB_CODES = {"machine_id": "machine_code", "tool_id": "tool_code", "part_number": "part_code"}
# Default tree depth (a parameter): the original forests grow without a limit,
# and 30 is the most that Spark allows.  Each level is another pass over the
# data, so large inputs may want less.
MAX_TREE_DEPTH = 30


# Rows that one partition of a fit should hold, at least and at most.
ROWS_WORTH, ROWS_A_PART = 10_000, 2_000_000
# Bins of a feature that trees tell apart (Spark's have 32 too).
BINS = 32
# Classifiers and forests are fitted on combinations of bins (``Cells``) from
# so many rows on, where a combination stands for so many rows on average.
CELLS_FROM, ROWS_A_CELL = 100_000, 16


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def dealt(train: DataFrame, *keys: Column) -> DataFrame:
    """The rows of a fit dealt evenly (or by ``keys``), a partition a core or a multiple of that; few rows over fewer.

    In every pass a partition counts each node by itself, so counts grow with
    the partitions; with fewer than there are cores, cores have nothing to do.
    """
    cores, rows = max(train.sparkSession.sparkContext.defaultParallelism, 1), train.count()
    rounds = max(1, -(-rows // (cores * ROWS_A_PART)))
    return train.repartition(max(1, min(cores * rounds, -(-rows // ROWS_WORTH))), *keys)


def _assembler(features: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")


def _without_summary(model: PipelineModel, spark: SparkSession) -> PipelineModel:
    """The model without its training summary.  That holds the session, which
    can't be sent to tasks once it has observed a table (``DataFrame.observe``).
    A forest's copy has none; other models are read back from storage."""
    if isinstance(model.stages[-1], RandomForestClassificationModel):
        return PipelineModel([*model.stages[:-1], model.stages[-1].copy()])
    path = f"{checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    model.write().save(path)
    return PipelineModel.load(path)


def balanced_weights(df: DataFrame, label: str, out: str = "weight", rows: str | None = None) -> DataFrame:
    """``n / (classes * n_class)`` per row; the class counts are joined (a row
    for each class), so any number of classes works.  The column ``rows`` says
    how many rows one of ``df`` stands for."""
    counts = df.groupBy(_q(label).alias("_class")).agg((F.sum(_q(rows)) if rows else F.count(F.lit(1))).alias("_m"))
    every = counts.agg(F.sum("_m").alias("n"), F.count(F.lit(1)).alias("k"))
    weight = every.select(F.col("n") / F.col("k")).scalar() / F.col("_m")
    return df.join(counts, _q(label).eqNullSafe(F.col("_class"))).withColumn(out, weight).drop("_class", "_m")


def _cutter(train: DataFrame, features: Sequence[str]) -> Bucketizer:
    """Cuts of each feature at its quantiles."""
    cuts = train.approxQuantile(list(features), [i / BINS for i in range(1, BINS)], 0.1 / BINS)
    return Bucketizer(inputCols=list(features), outputCols=[f"{c}__bin" for c in features], handleInvalid="keep",
                      splitsArray=[[float("-inf"), *(sorted(set(c)) or [0.0]), float("inf")] for c in cuts])


@dataclass
class Cells:
    """Rows of a fit by the combination of bins that they fall in, a cell.

    Trees see a feature by its bins alone and rows of a cell stay together in
    every node, so a fit needs only how many rows (and with which labels) a
    cell has.  Bags are drawn by row: of a cell's n rows, each tree draws as
    many as n draws from Poisson(1) give.
    """

    cutter: Bucketizer
    rows: DataFrame  # bins and label of every row
    counts: DataFrame  # (bins, label, rows), stored

    @property
    def bins(self) -> list[str]:
        return self.cutter.getOutputCols()

    def labelled(self, classes: int) -> Column:
        return F.col("label").alias("label", metadata={"ml_attr": {"type": "nominal", "num_vals": classes}})

    def classes(self) -> int:
        return int(self.counts.agg(F.max("label")).first()[0]) + 1


def cells(train: DataFrame, features: Sequence[str], label: str, by_label: bool = True) -> Cells | None:
    """The rows by cells (with ``by_label``, by cell and class); None where
    rows are few or there aren't many to a cell, so that it wouldn't pay."""
    n = train.count()
    if n < max(CELLS_FROM, 1) or not features:
        return None
    cutter = _cutter(train, features)
    bins = cutter.getOutputCols()
    checked = cutter.copy({cutter.handleInvalid: "error"})  # a fit takes no missing values, scoring does
    # bins have an order, they are no categories
    rows = checked.transform(train.select(*map(_q, dict.fromkeys([*features, label])))) \
        .select(*[_q(b).alias(b, metadata={}) for b in bins], _q(label).cast("double").alias("label"))
    counts = stored(rows.groupBy(*map(_q, bins), *(["label"] if by_label else [])).agg(F.count(F.lit(1)).alias("rows")))
    return Cells(cutter, rows, counts) if counts.count() * ROWS_A_CELL <= n else None


def _class_bags(found: Cells, trees: int, seed: int) -> DataFrame:
    """The cells with the rows that each tree draws of them (``drawn0``, ...)."""
    names = [f"drawn{t}" for t in range(trees)]

    def run(batches):
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        for batch in batches:
            drawn = rng.poisson(batch.column(batch.schema.get_field_index("rows")).to_numpy()[:, None], (batch.num_rows, trees))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(drawn[:, t]) for t in range(trees))], names=[*batch.schema.names, *names])

    return found.counts.mapInArrow(run, T.StructType([*found.counts.schema.fields, *(T.StructField(c, T.LongType()) for c in names)]))


def _value_bags(found: Cells, trees: int, seed: int) -> DataFrame:
    """Cells with the number and the mean label of the rows that each tree draws of them
    (``drawn0``, ``mean0``, ...).  Rows meet by cell; one that spans several Arrow
    batches comes in as many rows, which trees keep together as well."""
    bins, names = found.bins, [*(f"drawn{t}" for t in range(trees)), *(f"mean{t}" for t in range(trees))]
    rows = dealt(found.rows, *map(_q, bins)).sortWithinPartitions(*map(_q, bins), "label")

    def run(batches):
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(i).to_numpy() for i in range(len(bins))]
            y = batch.column(len(bins)).to_numpy(zero_copy_only=False)
            new = np.ones(batch.num_rows, bool)
            new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
            first = np.flatnonzero(new)
            each = rng.poisson(1.0, (batch.num_rows, trees))
            drawn = np.add.reduceat(each, first, axis=0)
            mean = np.add.reduceat(each * y[:, None], first, axis=0) / np.maximum(drawn, 1)
            columns = [*(k[first] for k in keys), *drawn.T, *mean.T]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=[*bins, *names])

    kinds = [T.LongType()] * trees + [T.DoubleType()] * trees
    return rows.mapInArrow(run, T.StructType([*found.rows.select(*map(_q, bins)).schema.fields, *(T.StructField(c, k) for c, k in zip(names, kinds))]))


def _forest_of(found: Cells, bags: DataFrame, forest, label: Column | None = None, weight: str | None = None) -> PipelineModel:
    """``forest`` grown tree by tree, each on the rows drawn for it; trees are
    concurrent Spark jobs.  The trees make one model of Spark's."""
    spark, trees = bags.sparkSession, forest.getNumTrees()
    kept = [c for c in bags.columns if c not in found.bins]
    bags = stored(_assembler(found.bins).transform(bags).select("features", *kept)
                  .repartition(max(1, -(-found.counts.count() // (10 * ROWS_WORTH)))))

    def grow(t: int):
        one = forest.copy({forest.numTrees: 1, forest.bootstrap: False, forest.seed: forest.getSeed() + t, forest.weightCol: "_weight"})
        rows = bags.where(F.col(f"drawn{t}") > 0)
        y = F.col(f"mean{t}").alias("label") if label is None else label
        return one.fit(rows.select("features", y, (F.col(f"drawn{t}") * (F.col(weight) if weight else 1.0)).alias("_weight")))

    with ThreadPoolExecutor(max_workers=max(1, min(trees, spark.sparkContext.defaultParallelism))) as pool:
        grown = list(pool.map(grow, range(trees)))
    kind = "classification.{}Classification" if label is not None else "regression.{}Regression"
    jvm, name = spark._jvm.org.apache.spark.ml, kind.split(".")
    models = getattr(jvm, name[0])
    every = spark.sparkContext._gateway.new_array(getattr(models, name[1].format("DecisionTree") + "Model"), trees)
    for t, model in enumerate(grown):
        every[t] = model._java_obj.trees()[0]
    sizes = [grown[0].numFeatures, *([grown[0].numClasses] if label is not None else [])]
    joined = getattr(models, name[1].format("RandomForest") + "Model")(forest.uid, every, *sizes)
    forest._transfer_params_to_java()
    forest._java_obj.copyValues(joined, spark._jvm.org.apache.spark.ml.param.ParamMap.empty())
    return PipelineModel([found.cutter, _assembler(found.bins), forest._copyValues(forest._create_model(joined))])


# A table of cells is broadcast up to this many rows (some MB).
CELLS_TO_SEND = 100_000


def scored(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with the model's ``prediction``.  Where the model tells rows apart
    by bins, each combination of bins is scored once, with all trees, and joined."""
    if not isinstance(model.stages[0], Bucketizer):
        return model.transform(df).select(*map(_q, df.columns), "prediction")
    cutter, rest = model.stages[0], PipelineModel(model.stages[1:])
    bins = cutter.getOutputCols()
    cut = cutter.transform(df).withColumns({b: F.coalesce(_q(b), F.lit(float("nan"))) for b in bins})  # NaN joins NaN
    found = stored(rest.transform(cut.select(*map(_q, bins)).distinct()).select(*map(_q, bins), "prediction"))
    return cut.join(F.broadcast(found) if found.count() <= CELLS_TO_SEND else found, bins).select(*map(_q, df.columns), "prediction")


def train_rf_regressor(train: DataFrame, features: Sequence[str], label: str, num_trees: int = 100,
                       max_depth: int = MAX_TREE_DEPTH, seed: int = 42) -> PipelineModel:
    found = cells(train, features, label, by_label=False)
    rf = RandomForestRegressor(featuresCol="features", labelCol="label" if found else label, numTrees=num_trees, maxDepth=max_depth,
                               featureSubsetStrategy="all", maxBins=BINS + 2 if found else BINS, seed=seed)
    if found:
        return _forest_of(found, _value_bags(found, num_trees, seed), rf)
    return Pipeline(stages=[_assembler(features), rf]).fit(dealt(train.select(*map(_q, [*features, label]))))


def train_rf_classifier(train: DataFrame, features: Sequence[str], label: str, num_trees: int = 200,
                        balanced: bool = True, max_depth: int = MAX_TREE_DEPTH, seed: int = 42) -> PipelineModel:
    """Random-forest classifier; ``balanced`` weights classes inversely to
    their frequency in the training rows."""
    found = cells(train, features, label)
    if found:
        rf = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=num_trees, maxDepth=max_depth,
                                    featureSubsetStrategy="sqrt" if num_trees > 1 else "all", maxBins=BINS + 2, seed=seed)
        bags = _class_bags(found, num_trees, seed)
        if not balanced:
            return _forest_of(found, bags, rf, found.labelled(found.classes()))
        return _forest_of(found, balanced_weights(bags, "label", rows="rows"), rf, found.labelled(found.classes()), "weight")
    kw = {}
    train = dealt(train.select(*map(_q, [*features, label])))
    if balanced:
        train = balanced_weights(train, label)
        kw["weightCol"] = "weight"
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=num_trees, maxDepth=max_depth,
                                seed=seed, **kw)
    return _without_summary(Pipeline(stages=[_assembler(features), rf]).fit(train), train.sparkSession)


def train_logistic(train: DataFrame, features: Sequence[str], label: str, max_iter: int = 1000) -> PipelineModel:
    """Logistic regression on standardised features (scaler fitted on the
    training rows only), with an L2 penalty of strength one over the rows."""
    n = train.count()
    train = dealt(train.select(*map(_q, [*features, label])))
    stages = [_assembler(features, "raw"), StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
              LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter, regParam=1.0 / max(n, 1), standardization=False)]
    return _without_summary(Pipeline(stages=stages).fit(train), train.sparkSession)


def train_gbt_classifier(train: DataFrame, features: Sequence[str], label: str, max_iter: int = 100,
                         max_depth: int = 3, seed: int = 42) -> PipelineModel:
    found = cells(train, features, label)
    if found:  # nothing is drawn, so rows of a cell and class are one row of their weight
        boosted = GBTClassifier(featuresCol="features", labelCol="label", weightCol="rows", maxIter=max_iter, maxDepth=max_depth,
                                maxBins=BINS + 2, seed=seed)
        model = Pipeline(stages=[_assembler(found.bins), boosted]).fit(dealt(
            found.counts.select(*map(_q, found.bins), found.labelled(found.classes()), F.col("rows").cast("double").alias("rows"))))
        return PipelineModel([found.cutter, *model.stages])
    return Pipeline(stages=[_assembler(features),
                            GBTClassifier(featuresCol="features", labelCol=label, maxIter=max_iter, maxDepth=max_depth,
                                          seed=seed)]).fit(dealt(train.select(*map(_q, [*features, label]))))


def binned_means(train: DataFrame, features: Sequence[str], label: str) -> tuple[Bucketizer, DataFrame]:
    """Cuts of each feature at its quantiles, and the rows in one row for each
    combination of bins: mean label and number of rows (``weight``).

    Trees see a feature by its bins alone, and rows of equal bins stay together
    in every node.  With squared loss a split's gain and a leaf's mean depend
    only on such rows' mean and number, so the fit is that of all rows, over at
    most as many rows as bins combine to.
    """
    cutter = _cutter(train, features)
    bins, y = cutter.getOutputCols(), _q(label)
    checked = cutter.copy({cutter.handleInvalid: "error"})  # a fit takes no missing values, scoring does
    binned = checked.transform(train.select(*map(_q, [*features, label])))
    means = binned.groupBy(*[_q(b).alias(b, metadata={}) for b in bins]).agg(  # bins have an order, they are no categories
        F.when(F.count(y) == F.count(F.lit(1)), F.avg(y)).alias(label), F.count(F.lit(1)).cast("double").alias("weight"))
    return cutter, means


def train_gbt_regressor(train: DataFrame, features: Sequence[str], label: str, max_iter: int = 100,
                        step: float = 0.1, max_depth: int = 6, seed: int = 42) -> PipelineModel:
    """Boosted regression trees (no L2 penalty on leaves: Spark has none) on binned features."""
    cutter, means = binned_means(train, features, label)
    means = stored(means)
    boosted = GBTRegressor(featuresCol="features", labelCol=label, weightCol="weight", maxIter=max_iter, stepSize=step,
                           maxDepth=max_depth, maxBins=BINS + 2, seed=seed)
    model = Pipeline(stages=[_assembler(cutter.getOutputCols()), boosted]).fit(dealt(means))
    return PipelineModel([cutter, *model.stages])


def feature_importance(model: PipelineModel, features: Sequence[str], top_n: int | None = 15) -> DataFrame:
    """Importances ranked (ties by name), with cumulative importance and rank.

    The importance vector has one entry per feature, so it is a small
    driver-side list turned into a DataFrame.
    """
    spark = SparkSession.getActiveSession()
    imp = model.stages[-1].featureImportances.toArray().tolist()
    ranked = sorted(zip(features, imp), key=lambda t: (-t[1], t[0]))
    out, cum = [], 0.0
    for i, (f, v) in enumerate(ranked, start=1):
        cum += v
        out.append((f, float(v), float(cum), i))
    if top_n is not None:
        out = out[:top_n]
    return spark.createDataFrame(out, "feature string, importance double, cumulative_importance double, rank int")


def regression_report(model: PipelineModel, train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Model metrics on the test rows next to the mean-prediction baseline,
    with the improvement in percent."""
    pred = scored(model, test)
    m = regression_metrics(pred, label, "prediction")
    b = naive_baseline(train, test, label)
    bm, br = b.select("mae").scalar(), b.select("rmse").scalar()
    return m.select("*", b.select("mean_prediction").scalar().alias("mean_prediction"),
                    bm.alias("baseline_mae"), br.alias("baseline_rmse"),
                    ((bm - F.col("mae")) / bm * 100).alias("mae_improvement_pct"),
                    ((br - F.col("rmse")) / br * 100).alias("rmse_improvement_pct"))


def regression_checks(model: PipelineModel, train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """One row: ``fits`` (on its training rows the model errs less than their
    mean does) and ``in_range`` (its test predictions lie within the training
    target's range, as averages of it must)."""
    y = _q(label)
    seen = scored(model, train).agg(F.avg(F.abs(F.col("prediction") - y)).alias("mae"), F.min(y).alias("low"), F.max(y).alias("high"))
    base = naive_baseline(train, train, label).select("mae").scalar()
    new = scored(model, test).agg(F.min("prediction").alias("low"), F.max("prediction").alias("high")).select(F.struct("low", "high")).scalar()
    return seen.select((F.col("mae") < base).alias("fits"), ((new["low"] >= F.col("low") - 1e-6) & (new["high"] <= F.col("high") + 1e-6)).alias("in_range"))


def balanced_accuracy(pred: DataFrame, label: str) -> float:
    """Mean recall of the classes."""
    per = pred.groupBy(_q(label)).agg(F.avg((_q(label).cast("double") == F.col("prediction")).cast("double")).alias("recall"))
    return per.agg(F.avg("recall")).first()[0]


def _fold_scores(pred: DataFrame, label: str) -> tuple[float, float, int, int]:
    """Accuracy and F1 of the positive class (1), rows and positives, in one aggregate."""
    y, p = _q(label).cast("double"), F.col("prediction")
    r = pred.agg(F.count(F.lit(1)).alias("n"), F.count_if(y == 1).alias("positives"), F.avg((y == p).cast("double")).alias("acc"),
                 F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y != 1) & (p == 1)).alias("fp"),
                 F.count_if((y == 1) & (p != 1)).alias("fn")).first()
    tp, fp, fn = r["tp"], r["fp"], r["fn"]
    f1 = 2 * tp / (2 * tp + fp + fn) if (2 * tp + fp + fn) else 0.0
    return float(r["acc"] or 0.0), float(f1), r["n"], r["positives"]


def _run_folds(folds: DataFrame, label: str, k: int, make: Callable[[DataFrame], PipelineModel],
               parallelism: int) -> list[tuple[float, float, int, int]]:
    """Fit and score every fold; up to ``parallelism`` folds run as
    concurrent Spark jobs (each fit is itself distributed)."""
    def one(i: int) -> tuple[float, float, int, int]:
        model = make(folds.where(F.col("fold") != i))
        return _fold_scores(scored(model, folds.where(F.col("fold") == i)), label)

    if parallelism <= 1:
        return [one(i) for i in range(k)]
    with ThreadPoolExecutor(max_workers=min(parallelism, k)) as pool:
        return list(pool.map(one, range(k)))


def cross_validate(df: DataFrame, features: Sequence[str], label: str, key_cols: Sequence[str], k: int = 5,
                   make: Callable[[DataFrame], PipelineModel] | None = None, seed: int = 42,
                   parallelism: int = 5, max_depth: int = MAX_TREE_DEPTH) -> DataFrame:
    """Stratified k-fold scores: one row per fold (accuracy, F1, rows and
    positives scored) plus a ``mean`` row (of all rows) carrying the verdict (signal > 0.98, strong > 0.85, else
    overfitting)."""
    make = make or (lambda t: train_rf_classifier(t, features, label, num_trees=100, balanced=True, max_depth=max_depth))
    # every fold reads the same rows 2k times: materialise them once
    folds = reliable_checkpoint(stratified_folds(df, label, key_cols, k, seed).select(*features, label, "fold"))
    scores = _run_folds(folds, label, k, make, parallelism)
    rows = [(str(i + 1), acc, f1, None, n, positives) for i, (acc, f1, n, positives) in enumerate(scores)]
    mean_acc = sum(r[1] for r in rows) / k
    verdict = "signal" if mean_acc > 0.98 else "strong" if mean_acc > 0.85 else "overfitting"
    rows.append(("mean", mean_acc, sum(r[2] for r in rows) / k, verdict, sum(r[4] for r in rows), sum(r[5] for r in rows)))
    return SparkSession.getActiveSession().createDataFrame(rows, "fold string, accuracy double, f1 double, verdict string, rows long, positives long")


def compare_models(df: DataFrame, features: Sequence[str], label: str, key_cols: Sequence[str], k: int = 5,
                   seed: int = 42, parallelism: int = 5, max_depth: int = MAX_TREE_DEPTH) -> DataFrame:
    """Logistic regression, random forest (100) and gradient boosting (100)
    on the same stratified folds: mean and population std of accuracy, and
    the best model."""
    makers = {
        "Logistic Regression": lambda t: train_logistic(t, features, label),
        "Random Forest": lambda t: train_rf_classifier(t, features, label, num_trees=100, balanced=False, max_depth=max_depth),
        "Gradient Boosting": lambda t: train_gbt_classifier(t, features, label),
    }
    folds = reliable_checkpoint(stratified_folds(df, label, key_cols, k, seed).select(*features, label, "fold"))
    res = []
    for name, make in makers.items():
        accs = [score[0] for score in _run_folds(folds, label, k, make, parallelism)]
        res.append((name, sum(accs) / k, statistics.pstdev(accs)))
    best = max(res, key=lambda r: r[1])[0]
    return SparkSession.getActiveSession().createDataFrame(
        [(n, m, s, n == best) for n, m, s in res], "model string, mean_accuracy double, std_accuracy double, best boolean")


def risk_classifier_report(model: PipelineModel, test: DataFrame, label: str) -> DataFrame:
    return classification_metrics(scored(model, test).withColumn("prediction", F.col("prediction").cast("int")),
                                  label, "prediction")


# ----------------------------------------------------------- forecasting --
@dataclass
class CodedModel:
    """A fitted pipeline plus the label-code tables its inputs need."""

    model: PipelineModel
    codes: dict = field(default_factory=dict)  # source column -> (code column, CodeTable)
    features: list = field(default_factory=list)

    def encode(self, df: DataFrame, unseen: int | None = 0) -> DataFrame:
        """Add the code columns; values without a code get ``unseen``."""
        out = df
        for col, (code_col, codes) in self.codes.items():
            out = join_codes(out, col, codes)
            if unseen is not None:
                out = out.withColumn(code_col, F.coalesce(F.col(code_col), F.lit(unseen)))
        return out

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        for col, (code_col, codes) in self.codes.items():
            codes.table.write.mode("overwrite").parquet(f"{path}/codes/{col}")
        spark = SparkSession.getActiveSession()
        meta = json.dumps({"codes": {c: [cc, t.rows] for c, (cc, t) in self.codes.items()},
                           "features": self.features})
        spark.createDataFrame([(meta,)], "meta string").write.mode("overwrite").json(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "CodedModel":
        meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
        codes = {c: (cc, CodeTable(spark.read.parquet(f"{path}/codes/{c}"), rows)) for c, (cc, rows) in meta["codes"].items()}
        return CodedModel(PipelineModel.load(f"{path}/model"), codes, meta["features"])


def code_tables(df: DataFrame, cols: dict) -> dict:
    """``{col: (code col, CodeTable)}``: sorted-position codes of each column."""
    tables = dense_codes_multi(df, cols)
    return {c: (o, tables[c]._replace(table=tables[c].table.withColumn(o, F.col(o).cast("int")))) for c, o in cols.items()}


def train_forecaster(table: DataFrame, label: str = "scrap_quantity", features: Sequence[str] = FORECAST_FEATURES,
                     max_iter: int = 100, step: float = 0.1, seed: int = 42) -> CodedModel:
    """Boosted next-day scrap model on job codes, two lags and the 3-row
    mean.  ``table`` is the cleaned lag table; codes are learnt from it."""
    codes = code_tables(table, JOB_CODES)
    cm = CodedModel(None, codes, list(features))
    enc = cm.encode(table.drop(*[c for c in JOB_CODES.values() if c in table.columns]), unseen=None)
    cm.model = train_gbt_regressor(enc, features, label, max_iter, step, seed=seed)
    return cm


def forecast_next_day(model: CodedModel, daily: DataFrame, threshold: float = 100.0,
                      keys: Sequence[str] = JOB_KEYS, value: str = "scrap_quantity") -> DataFrame:
    """Next-day forecast for every job with at least three days of history:
    expected scrap, change against yesterday, risk status (unseen labels get
    code 0)."""
    ctx = scoring_context(daily, keys, "date", value)
    pred = model.model.transform(model.encode(ctx, unseen=0))
    return pred.select(*keys, "last_date", "forecast_date", F.col("scrap_lag_1").alias("yesterday"),
                       F.col("prediction").alias("expected_scrap"),
                       (F.col("prediction") - F.col("scrap_lag_1")).alias("delta"),
                       risk_status(F.col("prediction"), threshold).alias("status"))


def sensor_features(df: DataFrame, ignore: Sequence[str] = SENSOR_IGNORE) -> list[str]:
    """``machine_code`` first, then every column not ignored (schema order)."""
    return ["machine_code"] + [c for c in df.columns if c not in ignore and c != "machine_code"]


def train_sensor_model(training: DataFrame, label: str = "scrap_quantity", key_cols: Sequence[str] = ("date", "machine_id"),
                       max_iter: int = 100, step: float = 0.05, seed: int = 42,
                       test_size: float = 0.2) -> tuple[CodedModel, DataFrame]:
    """Boosted model of daily scrap from the machine code and all sensor
    means; returns the model and its test-row metrics."""
    codes = code_tables(training, {"machine_id": "machine_code"})
    cm = CodedModel(None, codes)
    enc = cm.encode(training, unseen=None)
    feats = sensor_features(enc)
    cm.features = feats
    split = row_split(enc, list(key_cols), test_size, seed)
    train = split.where("split = 'train'")
    cm.model = train_gbt_regressor(train, feats, label, max_iter, step, seed=seed)
    metrics = regression_metrics(cm.model.transform(split.where("split = 'test'")), label, "prediction")
    return cm, metrics
