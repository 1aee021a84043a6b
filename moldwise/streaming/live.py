"""Structured Streaming: live daily features, live scoring and alerts.

* ``stream_daily_features`` — the batch daily feature table on a live feed:
  event-time watermark + tumbling one-day windows and two chained aggregates
  (statistics of each variable, status texts counted one by one; then one wide
  row a machine and day), so no state holds a map of texts; append mode emits a
  machine-day once the watermark has passed the end of the day.  Rows later
  than the watermark are dropped, and ``run_available_now`` counts them.
* ``stream_score`` — every arriving row is scored by a trained pipeline
  (24 h rate, 12 h = half of it); unseen machines get code 0 through a
  stream-static join with the code table; missing sensors are 0.
* ``stream_alerts`` — rows whose 24 h rate is above a threshold.
* ``append_history`` / ``history`` — scored rows kept by key, read back by
  machine: replayed rows, also after a lost checkpoint, change nothing.

Streams are started with ``run_available_now`` (process what is there, then
stop) or any trigger the caller chooses; state and progress live in the
checkpoint location, so a restarted query resumes exactly once.
"""

from __future__ import annotations

import uuid
from typing import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from moldwise.functions.columns import classify_names, risk_status
from moldwise.operators.features import STATS, feature_names, prepare_readings
from moldwise.operators.models import CodedModel
from moldwise.session import stored
from moldwise.sources.readers import write_dataset

ALERT_THRESHOLD = 2000.0


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", glob: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A file-source stream over a directory (new files are new data)."""
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        r = r.option("header", True)
    return r.load(path)


def stream_daily_features(readings: DataFrame, variables: Iterable[str], machine_col: str = "machine_def",
                          timestamp_col: str = "timestamp", variable_col: str = "variable_name",
                          value_col: str = "value", delay: str = "1 day",
                          numeric: Sequence[str] = ("mean", "max", "std", "count")) -> DataFrame:
    """Daily wide features of a readings stream (``variables`` is required:
    a stream's output schema must be fixed up front)."""
    names = sorted(set(variables))
    p = prepare_readings(readings, machine_col, timestamp_col, variable_col, value_col, True)
    usable = (F.col("var_class") == "categorical") | F.col("value_numeric").isNotNull()
    # event-time watermarks need TIMESTAMP (not TIMESTAMP_NTZ); the session runs in UTC
    p = p.where(usable & F.col(variable_col).isin(names) & F.col(machine_col).isNotNull()) \
         .withColumn("event_time", F.col("timestamp_parsed").cast("timestamp")) \
         .where(F.col("event_time").isNotNull()) \
         .withWatermark("event_time", delay)
    cls = classify_names(names)
    numbers, texts, counters = sorted(cls["numeric"] + cls["time_duration"]), sorted(cls["categorical"]), sorted(cls["counters"])
    vn, order = F.col("value_numeric"), F.struct(F.col("timestamp_parsed"), F.col("value_numeric"))
    is_text = F.col(variable_col).isin(texts)
    counted = F.col(variable_col).isin(counters) & vn.isNotNull()
    # one row a variable, and one a status text: a hot machine-day is spread over its variables
    each = p.groupBy(F.col(machine_col).alias("__machine"), F.window("event_time", "1 day").alias("__day"), F.col(variable_col).alias("__variable"),
                     F.when(is_text, F.col(value_col)).alias("__text")).agg(
        *[STATS[s](vn).alias(f"__{s}") for s in dict.fromkeys([*numeric, "count"])], F.count(F.lit(1)).alias("__rows"),
        F.min(F.when(counted, order))["value_numeric"].alias("__first"), F.max(F.when(counted, order))["value_numeric"].alias("__last"))

    def of(v: str, c: str) -> Column:
        return F.max(F.when(F.col("__variable") == v, F.col(c)))  # the one row of the variable

    cells = [of(v, f"__{s}").alias(f"{v}_{s}") for s in numeric for v in numbers]
    text = F.col("__text")
    for v in texts:  # most rows, then the smallest text
        best = F.when((F.col("__variable") == v) & text.isNotNull(), F.struct((-F.col("__rows")).alias("n"), text.alias("text")))
        cells.append(F.min(best)["text"].alias(f"{v}_mode"))
    cells += [of(v, f"__{s}").alias(f"{v}_{s}") for s in ("first", "last") for v in counters]
    cells += [(of(v, "__last") - of(v, "__first")).alias(f"{v}_delta") for v in counters]
    cells += [of(v, "__count").alias(f"{v}_count") for v in counters]
    wide = each.groupBy("__machine", F.window("__day", "1 day").alias("__window")).agg(*cells)
    return wide.select(F.col("__machine").alias(machine_col), F.date_format(F.col("__window.start"), "yyyy-MM-dd").alias("agg_date"),
                       *[F.col(f"`{c}`") for c in feature_names(names, numeric)])


def stream_score(rows: DataFrame, model: CodedModel, machine_col: str = "machine_id",
                 threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Score every arriving row: ``pred_24h``, ``pred_12h`` (= half) and a
    status against ``threshold``."""
    enc = model.encode(rows, unseen=0)
    feats = [f for f in model.features if f in enc.columns]
    for f in model.features:
        if f not in enc.columns:
            enc = enc.withColumn(f, F.lit(0.0))
    enc = enc.na.fill(0.0, subset=feats)
    scored = model.model.transform(enc)
    return scored.select(*[c for c in rows.columns], F.col("prediction").alias("pred_24h"),
                         (F.col("prediction") / 2).alias("pred_12h"),
                         risk_status(F.col("prediction"), threshold).alias("status"))


def stream_alerts(scored: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    return scored.where(F.col("pred_24h") > threshold)


# Progress reports kept of a run: more batches than these can't be summed up.
PROGRESS_KEPT = 100_000


def run_available_now(stream: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet",
                      mode: str = "append", timeout_s: int | None = None, late_sink: str | None = None) -> int:
    """Process all data available now into ``sink`` and stop; a run that isn't
    done after ``timeout_s`` is an error, as its sink is incomplete.

    Returns how many rows the stateful operators dropped as later than the
    watermark, and appends it to ``late_sink`` (batch, rows in, rows dropped,
    watermark) beside the result.  Rows that an aggregate drops are counted as
    they reach it: after the partial aggregate of a task and batch.
    """
    spark = stream.sparkSession
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", str(PROGRESS_KEPT))
    try:
        q = stream.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint) \
            .trigger(availableNow=True).start(sink)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    _finished(q, timeout_s, sink)
    reports = q.recentProgress
    if len(reports) >= PROGRESS_KEPT:
        raise RuntimeError("too many batches to count the late rows of")
    rows = [(int(r["batchId"]), int(r["numInputRows"]), sum(int(o["numRowsDroppedByWatermark"]) for o in r["stateOperators"]),
             dict(r["eventTime"]).get("watermark")) for r in reports]
    if late_sink is not None:
        spark.createDataFrame(rows, "batch_id long, rows_in long, rows_late long, watermark string").coalesce(1).write.mode("append").parquet(late_sink)
    return sum(r[2] for r in rows)


def _finished(q: StreamingQuery, timeout_s: int | None, sink: str) -> None:
    done = q.awaitTermination(timeout_s) if timeout_s is not None else q.awaitTermination() or True
    q.stop()
    if not done:
        raise TimeoutError(f"the stream was not done after {timeout_s} seconds; {sink} is incomplete")


HISTORY_KEYS = ("machine_id", "timestamp")


def append_history(stream: DataFrame, table: str, checkpoint: str, keys: Sequence[str] = HISTORY_KEYS, time: str = "timestamp",
                   timeout_s: int | None = None) -> None:
    """Process what a stream has now and merge it into the history at ``table``.

    Rows land in a folder of this run inside ``checkpoint``, so they are lost
    only together with the stream's progress.  Every run that landed and isn't
    noted as merged is merged, also one that broke off before.
    """
    spark, run = stream.sparkSession, uuid.uuid4().hex
    landing, notes = f"{checkpoint.rstrip('/')}/landing", f"{checkpoint.rstrip('/')}/merged"
    landed = stream.withColumn("__run", F.lit(run))
    q = landed.writeStream.format("parquet").partitionBy("__run").option("checkpointLocation", f"{checkpoint.rstrip('/')}/progress") \
        .trigger(availableNow=True).start(landing)
    _finished(q, timeout_s, landing)
    merged = {r["run"] for r in spark.read.parquet(notes).collect()} if _files(spark, notes) is not None else set()
    found = _files(spark, landing)
    runs = found.select(F.regexp_extract("path", "/__run=([0-9a-f]+)/", 1).alias("run")).where("run <> ''").distinct().collect() if found is not None else []
    todo = sorted({r["run"] for r in runs} - merged)  # a run's folder is read by itself: a task's leftovers repeat rows, which changes nothing
    if todo:
        merge_history(spark.read.schema(stream.schema).parquet(*[f"{landing}/__run={r}" for r in todo]), table, keys, time)
        spark.createDataFrame([(r,) for r in todo], "run string").coalesce(1).write.mode("append").parquet(notes)


def _files(spark: SparkSession, path: str) -> DataFrame | None:
    """Paths of the Parquet files below a folder, by Spark's own listing; None if there are none."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path).select("path")
    except AnalysisException:
        return None
    return None if files.isEmpty() else files


def merge_history(rows: DataFrame, table: str, keys: Sequence[str] = HISTORY_KEYS, time: str = "timestamp") -> None:
    """Add rows to the history: one row a key, those there already stay.

    Rows are laid out by day.  The days that ``rows`` touch are read, merged and
    replaced as whole partitions, so a merge that is repeated, or runs again
    after it broke off, gives the same table.  Of rows that share a key within
    ``rows``, the smallest stays; rows without a whole key have none to be kept by.
    """
    spark = rows.sparkSession
    keyed = rows
    for k in keys:
        keyed = keyed.where(F.col(k).isNotNull())
    keyed = keyed.withColumn("day", F.to_date(time)).withColumn("__new", F.lit(1))
    if _files(spark, table) is not None:
        days = keyed.select("day").distinct()
        old = spark.read.schema(keyed.drop("__new").schema).parquet(table)
        keyed = keyed.unionByName(old.join(days, "day", "left_semi").withColumn("__new", F.lit(0)))
    rest = [c for c in keyed.columns if c not in (*keys, "day", "__new")]
    order = F.struct(F.col("__new"), *[F.col(f"`{c}`") for c in rest])
    one = keyed.groupBy("day", *keys).agg(F.min(order).alias("row")).select(*keys, *[F.col("row").getField(c).alias(c) for c in rest], "day")
    merged = stored(one)  # the days read are those that are replaced
    write_dataset(merged.select(*rows.columns, "day"), table, partition_by=["day"], mode="overwrite_partitions")


def history(spark: SparkSession, table: str, machine: str | None = None, machine_col: str = "machine_id", time: str = "timestamp",
            last: int | None = None) -> DataFrame:
    """The kept rows, of one machine or all, or the ``last`` ones of each machine by time."""
    df = spark.read.parquet(table).drop("day")
    if machine is not None:
        df = df.where(F.col(machine_col) == F.lit(machine))
    if last is not None:
        latest = Window.partitionBy(machine_col).orderBy(F.desc(time), *[c for c in df.columns if c != time])
        df = df.withColumn("__n", F.row_number().over(latest)).where(F.col("__n") <= last).drop("__n")
    return df
