import numpy as np
import pytest
from pyspark.sql import functions as F

from moldwise.operators import splits as sp
from moldwise.operators.quantiles import exact_quantiles, exact_quantiles_multi
from moldwise.operators.ranking import global_row_number


def test_exact_quantiles_match_linear_interpolation(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(size=3000), np.full(1500, 0.25), rng.integers(0, 20, 500).astype(float)])
    df = spark.createDataFrame([(float(v),) for v in vals], "v double").repartition(6)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(df, "v", probs, local_limit=50, grid=8)   # force several narrowing rounds
    assert got == pytest.approx(list(np.quantile(vals, probs)), abs=1e-12)


def test_exact_quantiles_multi_and_empty(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (10.0, None)], "a double, b double")
    q = exact_quantiles_multi(df, ["a", "b"], [0.25, 0.75])
    assert q["a"] == [1.75, 4.75] and q["b"] == [None, None]


def test_global_row_number_is_a_permutation(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).alias("x")).repartition(7)
    out = global_row_number(df, ["x"], "i", num_partitions=5).collect()
    assert sorted(r["i"] for r in out) == list(range(5000))
    assert all(r["i"] == r["x"] for r in out)


def test_group_split_disjoint(spark):
    df = spark.range(0, 2000).select((F.col("id") % 97).alias("g"), F.col("id"))
    s = sp.group_split(df, ["g"], 0.2)
    sides = s.groupBy("g").agg(F.countDistinct("split").alias("n")).where("n > 1").count()
    assert sides == 0
    test_groups = s.where("split = 'test'").select("g").distinct().count()
    assert test_groups == 20                                        # ceil(0.2 * 97)
    rep = {r["side"]: r for r in sp.split_report(s, "id", ["g"]).collect()}
    assert rep["test"]["group_overlap"] == 0 and rep["test"]["groups"] == 20


@pytest.mark.parametrize("limit", [10_000, 1])
def test_group_split_cut_by_any_number_of_rounds(spark, monkeypatch, limit):
    monkeypatch.setattr(sp, "HASHES_TO_FETCH", limit)
    df = spark.range(0, 3000).select((F.col("id") % 1000).alias("g"), F.col("id"))
    for share, groups in ((0.2, 200), (0.0, 0), (1.0, 1000), (0.0004, 1)):
        assert sp.group_split(df, ["g"], share).where("split = 'test'").select("g").distinct().count() == groups
    assert sp.group_split(df.where("false"), ["g"], 0.2).count() == 0


def test_stratified_folds_balance(spark):
    df = spark.range(0, 1003).select("id", (F.col("id") % 4 == 0).cast("int").alias("y"))
    f = sp.stratified_folds(df, "y", ["id"], 5)
    counts = {(r["y"], r["fold"]): r["count"] for r in f.groupBy("y", "fold").count().collect()}
    for y in (0, 1):
        c = [counts[(y, k)] for k in range(5)]
        assert max(c) - min(c) <= 1
    assert f.count() == 1003


def test_approximate_quantiles_opt_in(spark):
    from moldwise.operators.quantiles import quantiles_multi

    df = spark.range(0, 1001).selectExpr("cast(id as double) as v")
    exact = quantiles_multi(df, ["v"], [0.5], exact=True)["v"][0]
    approx = quantiles_multi(df, ["v"], [0.5], exact=False)["v"][0]
    assert exact == 500.0 and abs(approx - 500.0) <= 1.0


def test_exact_quantiles_many_rounds_with_a_hot_value(spark):
    rng = np.random.default_rng(11)
    vals = np.concatenate([np.full(700, 3.0), rng.exponential(5.0, 1300).round(2)])
    df = spark.createDataFrame([(float(v),) for v in vals], "v double").repartition(5)
    probs = [0.01, 0.33, 0.5, 0.9, 0.999]
    got = exact_quantiles(df, "v", probs, local_limit=5, grid=3)
    assert got == pytest.approx(list(np.quantile(vals, probs)), abs=1e-12)


def test_quantiles_by_brackets_and_missed_brackets(spark):
    from moldwise.operators import quantiles as qt

    rng = np.random.default_rng(11)
    vals = np.concatenate([rng.normal(size=20_000), np.full(9_000, 0.5), [np.nan] * 50])
    df = spark.createDataFrame([(float(v), float(-v), None if i % 3 else float(i)) for i, v in enumerate(vals)], "a double, b double, c double").repartition(5)
    probs = [0.0, 0.001, 0.25, 0.5, 0.75, 1.0]
    want = {"a": np.quantile(vals[:-50], probs), "b": np.quantile(-vals[:-50], probs), "c": np.quantile(np.arange(0, len(vals), 3.0), probs)}
    sketch = qt.sketch_quantiles(df, ["a", "b", "c"], probs, accuracy=200)
    assert sketch.rows == len(vals) and sketch.counts == {"a": 29_000, "b": 29_000, "c": -(-len(vals) // 3)}
    assert sketch.brackets["a", 0.5][0] is not None and sketch.brackets["a", 0.0][0] is None
    for limit in (100_000, 20):
        got = qt.exact_quantiles_multi(df, ["a", "b", "c"], probs, local_limit=limit, grid=8, sketch=sketch)
        assert all(got[c] == pytest.approx(list(want[c]), abs=1e-12) for c in want)
    # brackets that hold no wanted rank are opened, never trusted
    wrong = sketch._replace(brackets={k: (5.0, 6.0) if k[1] < 0.6 else (-6.0, -5.0) for k in sketch.brackets})
    got = qt.exact_quantiles_multi(df, ["a", "b", "c"], probs, sketch=wrong)
    assert all(got[c] == pytest.approx(list(want[c]), abs=1e-12) for c in want)


def test_quantiles_read_the_data_twice(spark, tmp_path):
    from moldwise.operators import selection as se

    spark.range(30_000).select(*[F.when(F.col("id") % (i + 2) != 0, (F.col("id") * (7 + i)) % 1009).cast("double").alias(f"x{i}") for i in range(12)]).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    probe = spark.sparkContext.accumulator(0)

    def seen(batches):
        probe.add(1)
        yield from batches

    med = se.column_medians(df.coalesce(1).mapInArrow(seen, df.schema), df.columns)
    rows = df.toPandas()
    assert med == pytest.approx({c: rows[c].median() for c in df.columns}) and probe.value == 2
