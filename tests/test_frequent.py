import collections
import random

import pytest
from pyspark.sql import functions as F

from moldwise.operators import frequent as fq
from moldwise.operators import quality as ql
from moldwise.operators import summaries as sm


def table(spark, values, parts=5):
    return spark.createDataFrame([(v,) for v in values], "v string").repartition(parts)


def skewed(n=30_000, seed=1):
    rng = random.Random(seed)
    return [f"hot{rng.randrange(4)}" if rng.random() < 0.4 else f"cold{rng.randrange(9000)}" if rng.random() < 0.97 else None for _ in range(n)]


def plain_top(values, n):
    counts = collections.Counter(v for v in values if v is not None)
    return [(v, c, i + 1) for i, (v, c) in enumerate(sorted(counts.items(), key=lambda t: (-t[1], t[0]))[:n])]


@pytest.mark.parametrize("counters, n", [(4096, 10), (50, 4), (50, 10), (3, 4)])
def test_top_values_are_exact(spark, monkeypatch, counters, n):
    values = skewed()
    monkeypatch.setattr(fq.frequent_values, "__defaults__", (10, counters))
    got = sm.top_values(table(spark, values), "v", n).collect()
    assert [(r["value"], r["count"], r["rank"]) for r in sorted(got, key=lambda r: r["rank"])] == plain_top(values, n)


def test_summaries_bound_every_count(spark):
    values = skewed()
    rows = fq.value_summaries(table(spark, values), "v", 40).collect()
    error = sum(r["error"] for r in rows)
    held = {r["value"]: r["n"] for r in rows if r["value"] is not None}
    true = collections.Counter(v for v in values if v is not None)
    assert 0 < error < len(values) / 40 + 5 and len(held) < 5 * 40 + 1
    assert all(held.get(v, 0) <= c <= held.get(v, 0) + error for v, c in true.items())
    few = fq.value_summaries(table(spark, ["a", "b", "a", None]), "v", 40).collect()
    assert {r["value"]: r["n"] for r in few if r["value"]} == {"a": 2, "b": 1} and sum(r["error"] for r in few) == 0


def test_candidates_are_recounted_only_where_the_bound_separates(spark, monkeypatch):
    calls = []
    real = fq.value_counts
    monkeypatch.setattr(fq, "value_counts", lambda df, col: calls.append(col) or real(df, col))
    values = skewed()
    few = fq.frequent_values(table(spark, values), "v", 4, 200).collect()
    assert len(calls) == 1 and len(few) < 50  # the hot ones and little else
    every = fq.frequent_values(table(spark, values), "v", 10, 10).collect()
    assert len(every) == len({v for v in values if v is not None})  # cold ones can't be told apart: all are counted
    calls.clear()
    assert fq.frequent_values(table(spark, ["a", "b", "a"]), "v").count() == 2 and not calls


def test_other_types_and_no_rows(spark):
    df = spark.createDataFrame([(1, 1.5), (1, None), (2, 2.5), (None, 1.5)], "k long, x double")
    assert [tuple(r) for r in sm.top_values(df, "k", 5).select("value", "count").collect()] == [(1, 2), (2, 1)]
    assert [tuple(r) for r in sm.top_values(df, "x", 1).select("value", "count").collect()] == [(1.5, 2)]
    assert sm.top_values(df.where("false"), "k", 5).count() == 0


def test_sketches_unite_without_the_rows(spark, tmp_path):
    df = spark.range(20_000).select((F.col("id") % 7).alias("g"), (F.col("id") % 50).alias("day"), (F.col("id") % 3000).alias("a"), F.lit(None).cast("string").alias("b"))
    fq.distinct_sketches(df, ["a", "b"], ["g", "day"]).write.parquet(str(tmp_path / "states"))
    states = spark.read.parquet(str(tmp_path / "states"))
    by_g = {r["g"]: r for r in fq.distinct_estimates(fq.unite_sketches(states, ["g"])).collect()}
    exact = {r["g"]: r["n"] for r in df.groupBy("g").agg(F.count_distinct("a").alias("n")).collect()}
    assert all(abs(by_g[g]["a_distinct"] - n) <= 0.06 * n and by_g[g]["b_distinct"] == 0 for g, n in exact.items())
    everything = fq.distinct_estimates(fq.unite_sketches(states)).first()
    assert everything["rows"] == 20_000 and abs(everything["a_distinct"] - 3000) < 180


def test_approximate_summaries(spark):
    df = spark.range(3000).select((F.col("id") % 40).cast("string").alias("machine_id"), (F.col("id") % 9).cast("string").alias("date_key"), F.col("id").cast("double").alias("actual_scrap_qty"))
    row = sm.dataset_summary(df, approx_distinct=0.05).first()
    assert abs(row["unique_machines"] - 40) <= 4 and abs(row["unique_dates"] - 9) <= 1
    exact = sorted(map(tuple, sm.column_stats(df).collect()), key=str)
    assert sorted(map(tuple, sm.column_stats(df, approx_distinct=True).collect()), key=str) == exact


def test_repeated_rows(spark):
    rows = [("a", None, 1.0), ("a", None, 1.0), (None, "a", 1.0), (None, "a", 1.0), ("", "a", 1.0), (None, None, None), ("x", "y", -0.0), ("x", "y", 0.0), ("n", "n", float("nan")), ("n", "n", float("nan")), ("one", "row", 2.0)]
    df = spark.createDataFrame(rows, "a string, b string, c double").repartition(3)
    got = {(r["a"], r["b"]): r["count"] for r in ql.repeated_rows(df).collect()}
    assert got == {("a", None): 2, (None, "a"): 2, ("x", "y"): 2, ("n", "n"): 2}
    assert ql.repeated_rows(df.where("a = 'one'")).count() == 0 and ql.repeated_rows(df.where("false")).count() == 0


def test_rows_that_share_a_fingerprint_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(ql, "fingerprint", lambda df: [F.lit(1).cast("long").alias("__fp1"), F.lit(1).cast("long").alias("__fp2")])
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x"), (2, "y")], "a int, b string")
    assert [tuple(r) for r in ql.repeated_rows(df).collect()] == [(1, "x", 2)]
    issue = ql.check_duplicates(df, None, "t", 50.0).first()
    assert issue["count"] == 1 and issue["severity"] == "warning"


def test_duplicates_shuffle_fingerprints(spark):
    df = spark.createDataFrame([(1, "x" * 100)], "a int, b string")
    marks = df.select(*ql.fingerprint(df)).groupBy("__fp1", "__fp2").count()
    shuffle = [line for line in marks._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line]
    assert len(shuffle) == 1 and "__fp1" in shuffle[0] and "b#" not in shuffle[0]
