"""Range partitioning of documents by sampled splitters, with DataFrame functions only.

Records are ordered by (crc32 of the text, id, row): equal texts lie side by
side.  A size-weighted sample of the keys gives quantile boundaries; ranges
that turn out overfull are sampled again and subdivided, so every range holds
about the same bytes and is sorted by itself.  The ranges' totals give each
record its place among all bytes, and the record goes to the shard in which
its middle byte lies: shards differ by a record at most.  A group of equal
texts is in one shard, or in consecutive ones if it is cut by a boundary or
larger than a shard.

Null texts have size 8 and the checksum of no bytes.  Rows without an id come
first among equal texts; repeated rows are records of their own.  Without
rows the result is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moldwise.session import reliable_checkpoint

KEY = ("text_crc32", "doc_id", "row")


def _uniform(seed: int) -> Column:
    return F.pmod(F.xxhash64("row", "doc_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)


def _splitters(rows: DataFrame, step: float, each: int, seed: int) -> list:
    """Every ``each``-th of the keys drawn with a chance of size / step (large records several times), by range.

    The sample has about total / step rows, which the caller bounds.
    """
    drawn = rows.withColumn("draws", F.floor(F.col("size") / F.lit(step) + _uniform(seed))).where("draws > 0")
    run = F.sum("draws").over(Window.partitionBy("range").orderBy(*KEY))
    before = F.floor((F.col("run") - F.col("draws")) / each)
    return drawn.withColumn("run", run).where(F.floor(F.col("run") / each) > before).select(*KEY).collect()


def _range_of(splitters: list) -> Column:
    """How many splitters lie at or before the row's key: a binary search in a constant array."""
    if not splitters:
        return F.lit(0)
    kinds = ("bigint", "bigint", "bigint")
    keys = F.array(*[F.struct(*[F.lit(v).cast(t).alias(c) for c, v, t in zip(KEY, s, kinds)]) for s in splitters])
    own = F.struct(*[F.col(c).cast(t).alias(c) for c, t in zip(KEY, kinds)])
    n, steps = len(splitters), F.array(*[F.lit(1 << b) for b in range(len(splitters).bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= n) & (F.get(keys, F.least(at + step, F.lit(n)) - 1) <= own), at + step).otherwise(at))


def _order(splitter) -> tuple:
    return tuple((v is not None, v or 0) for v in splitter)


def sharded(docs: DataFrame, shards: int = 24, ranges: int = 192, draws: int = 16) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every document.

    ``ranges`` should grow with the input (a range is sorted in one task);
    ``draws`` keys are sampled for each.
    """
    text = F.coalesce("text", F.lit(""))
    records = docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.monotonically_increasing_id().alias("row"),
    )
    records = reliable_checkpoint(records)
    total = records.agg(F.sum("size").alias("size")).first()["size"] or 0
    share = max(1.0, total / ranges)
    splitters: list = []
    split, step, seed = records.withColumn("range", F.lit(0)), share / draws, 0
    while total:
        splitters = sorted({tuple(s) for s in splitters} | {tuple(s) for s in _splitters(split, step, draws, seed)}, key=_order)
        placed = records.withColumn("range", _range_of(splitters))
        sizes = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), F.max("size").alias("largest"))
        stats = sizes.collect()  # a row for each range
        over = [r["range"] for r in stats if r["bytes"] - r["largest"] > 2 * share]
        if not over:
            break
        split, step, seed = placed.where(F.col("range").isin(over)), share / draws, seed + 1
    if not total:
        stats, placed = [], records.withColumn("range", F.lit(0))
    bytes_before, rows_before, before = 0, 0, []
    for r in sorted(stats, key=lambda r: r["range"]):
        before.append((r["range"], bytes_before, rows_before))
        bytes_before, rows_before = bytes_before + r["bytes"], rows_before + r["n"]
    offsets = docs.sparkSession.createDataFrame(before, "range int, bytes_before long, rows_before long")
    in_range = Window.partitionBy("range").orderBy(*KEY)
    middle = 2 * (F.col("bytes_before") + F.sum("size").over(in_range.rowsBetween(Window.unboundedPreceding, 0))) - F.col("size")
    placed = placed.join(F.broadcast(offsets), "range").select(
        "doc_id", "size", "text_crc32",
        F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(2 * max(total, 1)))).cast("int").alias("shard"),
        (F.col("rows_before") + F.row_number().over(in_range) - 1).alias("place"),
    )
    placed = reliable_checkpoint(placed)
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))  # a row for each shard
    return placed.join(F.broadcast(first), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot"))


def sharding_report(docs: DataFrame) -> DataFrame:
    out = sharded(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
