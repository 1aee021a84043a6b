"""Exact global ranks without funnelling rows through one task.

``Window.orderBy`` without ``partitionBy`` moves every row into a single
partition.  Here values are range-partitioned, numbered inside each
partition, and shifted by the row counts of the preceding partitions (a
table with one row per partition, so its size is bounded by the partition
count, not by the data).  The range-partitioned rows are checkpointed once so
numbering and counting see the same partition bounds.
"""

from __future__ import annotations

from typing import NamedTuple, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moldwise.session import reliable_checkpoint


# Rows that one range of a global ranking should hold at most.
ROWS_A_RANGE = 1_000_000


def global_row_number(df: DataFrame, order: Sequence[str], out: str = "row_idx",
                      num_partitions: int | None = None) -> DataFrame:
    """0-based position of each row in the total order ``order`` (ties broken
    by the order columns only, so give a unique order for a deterministic result).

    Ranges are sorted inside their partitions before they are stored, and a
    row's place is its position in the stored partition: no second shuffle.
    Without ``num_partitions`` there are as many ranges as the row count asks
    for, so a small table makes few files.
    """
    spark = df.sparkSession
    cols = [F.col(c) for c in order]
    if num_partitions is None:
        df = reliable_checkpoint(df)
        num_partitions = max(1, -(-df.count() // ROWS_A_RANGE))
    ranged = df.repartitionByRange(num_partitions, *cols).sortWithinPartitions(*cols)
    # two evaluations of a range partitioning may cut differently: both the
    # numbering and the counting read the one stored copy
    place = F.monotonically_increasing_id()  # partition in the upper bits, row position in the lower 33
    ranged = reliable_checkpoint(ranged.withColumn("_at", place))
    pid, rn = F.shiftright("_at", 33).alias("_pid"), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)).alias("_rn")
    local = ranged.select("*", pid, rn)
    counts = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a bounded table, safe to order globally and broadcast
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_pid", "_off")
    out_df = local.join(F.broadcast(offsets), "_pid").withColumn(out, F.col("_off") + F.col("_rn"))
    return out_df.drop("_pid", "_rn", "_off", "_at")


# A code table is broadcast up to this many rows (a few MB of labels).
LABELS_TO_SEND = 100_000


class CodeTable(NamedTuple):
    """A stored label-code table and its row count."""

    table: DataFrame
    rows: int


def dense_codes_multi(df: DataFrame, cols: dict) -> dict:
    """``{col: CodeTable}``: the position of each distinct non-null value in
    ascending order (what a sorted label encoder assigns).

    One distinct job over (column, value) pairs and one global ranking serve
    all columns of one type; a column's codes count from its first position.
    """
    out = {}
    for kind in dict.fromkeys(df.schema[c].dataType.simpleString() for c in cols):
        names = [c for c in cols if df.schema[c].dataType.simpleString() == kind]
        pairs = df.select(F.explode(F.array(*[
            F.struct(F.lit(i).alias("i"), F.col(c).alias("v")) for i, c in enumerate(names)])).alias("p")) \
            .select("p.i", "p.v").where(F.col("v").isNotNull()).distinct()
        ranked = reliable_checkpoint(global_row_number(pairs, ["i", "v"], "_k"))
        facts = {r["i"]: (r["f"], r["n"]) for r in ranked.groupBy("i").agg(F.min("_k").alias("f"), F.count("*").alias("n")).collect()}
        for i, c in enumerate(names):
            first, n = facts.get(i, (0, 0))
            out[c] = CodeTable(ranked.where(F.col("i") == i).select(F.col("v").alias(c), (F.col("_k") - first).alias(cols[c])), n)
    return out


def dense_codes(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """The code table of one column."""
    return dense_codes_multi(df, {col: out or f"{col}_code"})[col].table


def join_codes(df: DataFrame, col: str, codes: CodeTable, how: str = "left") -> DataFrame:
    """Join a code table, broadcast if its counted rows are few."""
    return df.join(F.broadcast(codes.table) if codes.rows <= LABELS_TO_SEND else codes.table, col, how)
