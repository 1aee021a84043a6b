"""Frequent values and distinct counts from mergeable summaries.

``frequent_values`` finds the top values of a column without shuffling its
distinct values: each task keeps a bounded summary (counters, and the error
that pruning them made), the summaries are merged by value, and only values
that can be among the top are counted exactly.  The errors are measured, not
estimated, so whether a value that no summary holds could be among the top is
known; if it could, all values are counted.

``distinct_sketches`` keeps distinct counts as HyperLogLog states, one row a
group, that can be stored and united later over any groups.
"""

from __future__ import annotations

from typing import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from moldwise.session import stored

COUNTERS = 4096
#: Candidates that are sent to all tasks for the exact recount; beyond it, all values are counted.
CANDIDATES = 4 * COUNTERS


def _q(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _pruned(table: pa.Table, counters: int) -> tuple[pa.Table, int]:
    """At most ``counters`` values; what is taken off each counter is the error that this makes at most to any value."""
    if table.num_rows <= counters:
        return table, 0
    n = table.column("n").combine_chunks()
    off = n[pc.array_sort_indices(n, order="descending")[counters].as_py()].as_py()
    table = table.set_column(table.schema.get_field_index("n"), "n", pc.subtract(n, off))
    return table.filter(pc.greater(table.column("n"), 0)), off


def value_summaries(df: DataFrame, col: str, counters: int = COUNTERS) -> DataFrame:
    """(value, n, error): how often each value was counted at least, by tasks that keep ``counters`` counters.

    A row without a value carries the error of its task: no value was missed
    more often there.  A task's summary is pruned whenever it has four times
    as many counters.
    """
    kind = df.schema[col].dataType

    def run(batches):
        held, error = None, 0
        for batch in batches:
            values = batch.column(0).drop_null()
            if len(values) == 0:
                continue
            seen = pc.value_counts(values)
            part = pa.table({"value": seen.field("values"), "n": seen.field("counts")})
            held = part if held is None else pa.concat_tables([held, part])
            if held.num_rows > 4 * counters:
                held = held.group_by("value").aggregate([("n", "sum")]).rename_columns(["value", "n"])
                held, off = _pruned(held, counters) if held.num_rows > 4 * counters else (held, 0)
                error += off
        if held is None:
            return
        held = held.group_by("value").aggregate([("n", "sum")]).rename_columns(["value", "n"])
        held, off = _pruned(held, counters)
        error += off
        held = held.select(["value", "n"]).append_column("error", pa.array([0] * held.num_rows, pa.int64()))
        yield from held.combine_chunks().to_batches()
        yield pa.RecordBatch.from_arrays([pa.nulls(1, held.schema.field("value").type), pa.array([0], pa.int64()), pa.array([error], pa.int64())], names=["value", "n", "error"])

    schema = StructType([StructField("value", kind), StructField("n", LongType()), StructField("error", LongType())])
    rows = df.select(_q(col)).mapInArrow(run, schema)
    return rows.groupBy("value").agg(F.sum("n").alias("n"), F.sum("error").alias("error"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, count) of every non-null value."""
    return df.where(_q(col).isNotNull()).groupBy(_q(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))


def frequent_values(df: DataFrame, col: str, n: int = 10, counters: int = COUNTERS) -> DataFrame:
    """(value, count) of a few values that hold the ``n`` most frequent non-null ones, with exact counts.

    The summaries are stored and looked at once.  If no value that they miss
    can reach the n-th best, the candidates that can are counted in one more
    pass (none if no counter was ever pruned); otherwise all values are.
    """
    summary = stored(value_summaries(df, col, max(counters, n)))
    error = summary.agg(F.sum("error")).first()[0] or 0
    kept = summary.where(F.col("value").isNotNull())
    if error == 0:
        return kept.select("value", F.col("n").alias("count"))
    nth = kept.orderBy(F.desc("n")).limit(n).agg(F.min("n"), F.count("n")).first()
    candidates = kept.where(F.col("n") >= nth[0] - error).select("value")
    if nth[1] < n or nth[0] <= error or candidates.count() > CANDIDATES:
        return value_counts(df, col)
    # at most CANDIDATES values are broadcast
    return value_counts(df.join(F.broadcast(candidates.withColumnRenamed("value", "__value")), _q(col) == F.col("__value"), "left_semi"), col)


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), lg_size: int = 12) -> DataFrame:
    """For each group of ``by``: the number of rows and a sketch of each column's distinct non-null values (``{column}_sketch``).

    A sketch has at most ``2**lg_size`` bytes and a relative error of about
    ``1.04 / sqrt(2**lg_size)``; rows of stored sketches can be united.
    """
    sketches = [F.hll_sketch_agg(_q(c).cast("string"), lg_size).alias(f"{c}_sketch") for c in columns]
    return df.groupBy(*[_q(k) for k in by]).agg(F.count(F.lit(1)).alias("rows"), *sketches)


def unite_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of coarser groups from those of finer ones, by a merge of states; the rows behind them aren't read again."""
    names = [c for c in sketches.columns if c.endswith("_sketch")]
    return sketches.groupBy(*[_q(k) for k in by]).agg(F.sum("rows").alias("rows"), *[F.hll_union_agg(_q(c)).alias(c) for c in names])


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """Sketches read off: ``{column}_distinct`` in place of ``{column}_sketch``."""
    return sketches.select(*[F.hll_sketch_estimate(_q(c)).alias(c[: -len("_sketch")] + "_distinct") if c.endswith("_sketch") else _q(c)
                             for c in sketches.columns])
