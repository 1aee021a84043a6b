"""Bounded, repeatable samples of labelled rows for fitting, and scoring of whole columns of texts."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moldwise.llm.textbytes import is_fold, slices, text_bytes

PIECES = 8  # of the excerpt of a long text
RANGES = 14  # leading bits of an id's hash: its range


def excerpt(text: Column, limit: Column) -> Column:
    """``text``, or PIECES runs of its words spread over all of it, about ``limit`` bytes together, if it has more bytes."""
    size = F.greatest(F.floor(F.length(text) * (limit / F.octet_length(text)) / PIECES), F.lit(1)).cast("int")

    def piece(i: Column) -> Column:
        run = F.substring(text, (F.floor((F.length(text) - size) * i / (PIECES - 1)) + 1).cast("int"), size)
        run = F.when(i > 0, F.substring(run, F.instr(run, " ") + 1, size)).otherwise(run)  # not from the middle of a word
        return F.when(i < PIECES - 1, F.substring(run, F.lit(1), F.length(run) - F.instr(F.reverse(run), " "))).otherwise(run)

    return F.when(F.octet_length(text) <= limit, text).otherwise(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), piece), "\n"))


def bounded_sample(docs: DataFrame, targets: DataFrame, folds: int, held_out: int, per_label: int, text_bytes: int, label_bytes: int) -> DataFrame:
    """(doc_id, text, label) of at most ``per_label`` documents for each label, outside the held-out fold.

    ``targets`` has ``doc_id`` and ``label``; several labels of one id count as
    the largest, a null label as none.  Of the documents with a text, those with
    the smallest hash of their id are taken, so the choice is the same in any
    order of rows; an id that occurs repeatedly gives its smallest text.  No
    length is left out: texts of over ``text_bytes``, and the longest ones of a
    label whose texts have over ``label_bytes`` together, give an excerpt.
    """
    known = targets.where("label is not null and doc_id is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull() & ~is_fold(F.col("doc_id"), folds, held_out))
    sizes = texts.groupBy("doc_id").agg(F.max(F.octet_length("text").cast("long")).alias("bytes"))
    chosen = smallest(sizes.join(known, "doc_id"), per_label)
    # at most per_label ids for each label are broadcast
    limited = texts.join(F.broadcast(_limits(chosen, text_bytes, label_bytes)), "doc_id")
    return limited.groupBy("doc_id", "label").agg(F.min(excerpt(F.col("text"), F.col("limit"))).alias("text"))


def smallest(rows: DataFrame, per_label: int) -> DataFrame:
    """The ``per_label`` rows of each label with the smallest hash of ``doc_id``; no task gets a whole label."""
    order = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
    return first_ranges(rows, per_label).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_label).drop("rank")


def first_ranges(rows: DataFrame, per_label: int) -> DataFrame:
    """The rows of each label in the first ranges of the hash of ``doc_id`` that have ``per_label`` rows together."""
    bucket = F.shiftright(F.xxhash64("doc_id"), 64 - RANGES)
    counts = rows.groupBy("label", bucket.alias("bucket")).agg(F.count("*").alias("rows"))
    before = Window.partitionBy("label").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    needed = counts.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0))).where(F.col("before") < per_label)
    last = needed.groupBy("label").agg(F.max("bucket").alias("last"))
    return rows.join(F.broadcast(last), "label").where(bucket <= F.col("last")).drop("last")


def _limits(chosen: DataFrame, text_bytes: int, label_bytes: int) -> DataFrame:
    """(doc_id, label, limit): as many bytes for each text of a label, ``text_bytes`` at most, as ``label_bytes`` has room for."""
    rows = chosen.withColumn("bytes", F.least("bytes", F.lit(text_bytes)))
    by_size = Window.partitionBy("label").orderBy("bytes", "doc_id")
    smaller = F.coalesce(F.sum("bytes").over(by_size.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.count("*").over(Window.partitionBy("label")) - F.row_number().over(by_size) + 1
    rows = rows.withColumn("room", F.floor((label_bytes - smaller) / rest))  # of each of the texts from here on
    limit = F.max(F.when(F.col("bytes") > F.col("room"), F.col("room"))).over(Window.partitionBy("label"))
    return rows.select("doc_id", "label", F.coalesce(limit, F.lit(text_bytes)).alias("limit"))


def fitted(sample: DataFrame, fit: Callable[[list[str], np.ndarray], Any]) -> Any:
    """``fit(texts, labels)`` over a bounded sample in order of ids, in one task of its own; the model comes back."""

    def run(batches):
        rows = [batch for batch in batches if batch.num_rows]
        if rows:
            table = pa.Table.from_batches(rows).sort_by("doc_id")
            model = fit(table.column("text").to_pylist(), np.array(table.column("label").to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    got = sample.select("doc_id", "text", "label").repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(got[0]["model"]) if got else fit([], np.empty(0))


def add_columns(docs: DataFrame, fields: list[T.StructField], fn: Callable[[np.ndarray, np.ndarray], list]) -> DataFrame:
    """``docs`` with ``fields`` behind its own columns; ``fn`` gets the bytes and offsets of some whole texts."""
    names = [*docs.columns, *(f.name for f in fields)]

    def run(batches):
        for batch in slices(batches):
            data, offsets = text_bytes(batch.column(batch.schema.get_field_index("text")))
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, fn(data, offsets))], names=names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))
