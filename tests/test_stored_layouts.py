import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from moldwise.operators import joins as jn
from moldwise.operators import quality as ql
from moldwise.session import store_bucketed
from moldwise.sources import readers as rd
from moldwise.streaming import live


def sides(spark):
    production = spark.range(600).select(F.col("id").alias("order_id"), F.concat(F.lit("M-"), (F.col("id") % 5).cast("string")).alias("machine_id"),
                                         F.date_format(F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 9).cast("int")), "dd-MM-yyyy").alias("date"))
    features = spark.range(32).select(F.concat(F.lit("M"), (F.col("id") % 4).cast("string"), F.lit("-10")).alias("machine_def"),
                                      F.date_format(F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") / 4).cast("int")), "yyyy-MM-dd").alias("agg_date"),
                                      F.col("id").cast("double").alias("x_mean"))
    return production, features


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_bucketed_sides_join_without_a_shuffle(spark, monkeypatch):
    production, features = sides(spark)
    p, f = jn.store_join_sides(production, features, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for keep in (True, False):
            stored = jn.join_stored_sides(p, f, keep)
            assert exchanges(stored) == 0
            plain = jn.join_production_features(production, features, keep_unmatched=keep)
            assert exchanges(plain) > 0 and stored.columns == plain.columns
            assert sorted(map(str, stored.collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_aggregates_on_the_bucket_keys_need_no_shuffle(spark):
    t = store_bucketed(spark.range(100).select((F.col("id") % 7).alias("k"), "id"), ["k"], 3)
    per = t.groupBy("k").agg(F.sum("id").alias("s"))
    assert exchanges(per) == 0 and per.count() == 7


def test_unused_features_are_not_computed(spark):
    production, features = sides(spark)
    wide = features.groupBy("machine_def", "agg_date").agg(F.max("x_mean").alias("x_mean"), F.stddev_samp("x_mean").alias("x_std"))
    joined = jn.join_production_features(production, wide).select("order_id", "date_key")
    assert "stddev" not in joined._jdf.queryExecution().optimizedPlan().toString()


def test_partitions_are_replaced_and_have_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).select("id", (F.col("id") % 3).cast("int").alias("day")).repartition(8)
    rd.write_dataset(df, path, partition_by=["day"])
    assert all(len(glob.glob(f"{path}/day={d}/*.parquet")) <= 2 for d in range(3))  # not one a task
    rd.write_dataset(df.where("day = 1 and id < 10"), path, partition_by=["day"], mode="overwrite_partitions")
    got = {r["day"]: r["count"] for r in spark.read.parquet(path).groupBy("day").count().collect()}
    assert got == {0: 334, 1: 3, 2: 333}
    rd.write_dataset(df.where("day = 1"), path, partition_by=["day"])
    assert {r["day"] for r in spark.read.parquet(path).select("day").distinct().collect()} == {1}
    with pytest.raises(ValueError):
        rd.write_dataset(df, path, mode="overwrite_partitions")


def test_issues_of_a_written_table_are_those_of_a_scan(spark, tmp_path):
    df = spark.createDataFrame([(i, None if i % 3 else float(i), float("nan") if i % 4 else -1.0, "t") for i in range(300)], "k int, a double, b double, c string").repartition(5)
    path = str(tmp_path / "t")
    got = ql.write_validated(df, path, "d", {"b": (0.0, 5.0), "k": (10, None), "c": (0, 1), "none": (0, 1)}, min_rows=1000)
    want = [ql.check_missing(df, "d"), ql.check_ranges(df, "b", 0.0, 5.0, "d"), ql.check_ranges(df, "k", 10, None, "d"), ql.check_ranges(df, "c", 0, 1, "d")]
    rows = sorted(map(str, got.where("issue_type <> 'insufficient_data'").collect()))
    assert rows == sorted(str(r) for w in want for r in w.collect()) and len(rows) == 5
    assert got.where("issue_type = 'insufficient_data'").first()["count"] == 300 and spark.read.parquet(path).count() == 300
    none = ql.write_validated(df.where("false"), str(tmp_path / "none"), "d", {"b": (0.0, 5.0)})
    assert [r["issue_type"] for r in none.collect()] == ["insufficient_data"]


def readings(rows):
    return [(m, dt.datetime(2024, 1, d, h), v, x) for m, d, h, v, x in rows]


SCHEMA = "machine_id string, timestamp timestamp, variable string, value string"


def test_history_survives_a_replay(spark, tmp_path):
    feed, table = str(tmp_path / "feed"), str(tmp_path / "table")
    first = readings([("M1", 1, 1, "a", "1"), ("M1", 1, 1, "b", "2"), ("M2", 2, 1, "a", "3"), ("M2", 2, 1, "a", "3"), (None, 2, 1, "a", "4")])
    spark.createDataFrame(first, SCHEMA).coalesce(1).write.mode("append").parquet(feed)
    stream = live.file_stream(spark, feed, spark.read.parquet(feed).schema)
    live.append_history(stream, table, str(tmp_path / "ck"))
    once = sorted(map(str, live.history(spark, table).collect()))
    assert len(once) == 2
    live.append_history(stream, table, str(tmp_path / "ck"))  # nothing new
    live.append_history(stream, table, str(tmp_path / "lost"))  # all of it again
    assert sorted(map(str, live.history(spark, table).collect())) == once
    more = readings([("M1", 1, 2, "a", "9"), ("M1", 3, 1, "a", "8"), ("M1", 1, 1, "a", "0")])  # the last has a key that is there
    spark.createDataFrame(more, SCHEMA).coalesce(1).write.mode("append").parquet(feed)
    live.append_history(stream, table, str(tmp_path / "ck"))
    rows = live.history(spark, table, "M1").orderBy("timestamp").collect()
    assert [(r["timestamp"].day, r["timestamp"].hour, r["value"]) for r in rows] == [(1, 1, "1"), (1, 2, "9"), (3, 1, "8")]
    assert [r["value"] for r in live.history(spark, table, last=1).orderBy("machine_id").collect()] == ["8", "3"]


def test_a_run_that_broke_off_before_its_merge(spark, tmp_path, monkeypatch):
    feed, table, checkpoint = str(tmp_path / "feed"), str(tmp_path / "table"), str(tmp_path / "ck")
    spark.createDataFrame(readings([("M1", 1, 1, "a", "1")]), SCHEMA).write.mode("append").parquet(feed)
    stream = live.file_stream(spark, feed, spark.read.parquet(feed).schema)
    with monkeypatch.context() as broken, pytest.raises(RuntimeError):
        broken.setattr(live, "merge_history", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        live.append_history(stream, table, checkpoint)
    spark.createDataFrame(readings([("M1", 2, 1, "a", "2")]), SCHEMA).write.mode("append").parquet(feed)
    live.append_history(stream, table, checkpoint)
    assert sorted(r["value"] for r in live.history(spark, table).collect()) == ["1", "2"]


def test_late_rows_are_counted(spark, tmp_path):
    schema = "machine_def string, timestamp timestamp, variable_name string, value string"
    feed = str(tmp_path / "feed")
    late = [("M1", 2, 1, "Cushion", "1"), ("M1", 2, 2, "Machine_status", "x"), ("M2", 2, 1, "Cushion", "1")]
    # rows are held against the watermark of the batch before: the late ones come in the third
    for part in ([("M1", d, h, "Cushion", str(d)) for d in (1, 9) for h in (1, 2)] + [("M1", 1, 1, "Machine_status", s) for s in "ba"], [("M2", 9, 3, "Cushion", "1")], late, [("M1", 12, 1, "Cushion", "5")]):
        spark.createDataFrame(readings(part), schema).coalesce(1).write.mode("append").parquet(feed)
    stream = live.file_stream(spark, feed, spark.read.parquet(feed).schema, max_files_per_trigger=1)
    feats = live.stream_daily_features(stream, ["Cushion", "Machine_status"])
    dropped = live.run_available_now(feats, str(tmp_path / "out"), str(tmp_path / "ck"), late_sink=str(tmp_path / "late"))
    batches = spark.read.parquet(str(tmp_path / "late"))
    assert dropped == 3 and batches.agg(F.sum("rows_late")).first()[0] == 3 and batches.agg(F.sum("rows_in")).first()[0] == 11
    rows = {r["agg_date"]: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert sorted(rows) == ["2024-01-01", "2024-01-09"] and rows["2024-01-01"]["Machine_status_mode"] == "a" and rows["2024-01-01"]["Cushion_count"] == 2


def test_stream_state_holds_no_map_of_texts(spark, tmp_path):
    schema = "machine_def string, timestamp timestamp, variable_name string, value string"
    spark.createDataFrame(readings([("M1", 1, 1, "Cushion", "1")]), schema).write.parquet(str(tmp_path / "feed"))
    stream = live.file_stream(spark, str(tmp_path / "feed"), spark.read.parquet(str(tmp_path / "feed")).schema)
    plan = live.stream_daily_features(stream, ["Cushion", "Machine_status"])._jdf.queryExecution().logical().toString()
    assert "mode(" not in plan and plan.count("Aggregate") == 2
