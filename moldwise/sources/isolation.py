"""Reading with failures kept apart: good rows here, what is wrong there.

One pass over the files parses every row and stores it with the problems found
in it.  Good rows and the quarantine (file, line, column, reason, text) are two
views of that stored table, so a bad value, a row with too many fields or a
file without a needed column never stops the others.  Only when nothing is
good is it an error.

``line`` is a row's place among the records of its file, the header being
line 1; blank lines don't count.  Problems of a whole file have line 1.
"""

from __future__ import annotations

import uuid
from typing import Iterable, NamedTuple, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from moldwise.functions.columns import present_text
from moldwise.operators.features import daily_features
from moldwise.session import checkpoint_dir
from moldwise.sources.manifest import file_manifest
from moldwise.sources.readers import READINGS_SCHEMA, field, parsed_text, placed_text

class Isolated(NamedTuple):
    """``good`` rows (with ``source_file``), and the ``quarantine``."""

    good: DataFrame
    quarantine: DataFrame


def _problems(schema: StructType) -> Column:
    """What is wrong with a row of ``placed_text``: (column, reason, text) for each fault."""
    faults = [F.when(F.exists(F.slice("fields", F.size("header") + 1, F.size("fields")), lambda x: x.isNotNull()), F.struct(
        F.lit(None).cast("string").alias("column"), F.lit("more fields than the header has").alias("reason"),
        F.concat_ws(",", "fields").alias("text")))]
    for f in schema.fields:
        text = present_text(field(f.name))
        faults.append(F.when(text.isNotNull() & parsed_text(text, f.dataType).isNull(), F.struct(
            F.lit(f.name).alias("column"), F.lit(f"not a {f.dataType.simpleString()}").alias("reason"), text.alias("text"))))
    return F.filter(F.array(*faults), lambda x: x.isNotNull())


def read_isolated(spark: SparkSession, path: str, schema: StructType | str, glob: str | None = None,
                  required: Sequence[str] | None = None, whole_files: bool = True) -> Isolated:
    """CSV files by header name, with ``schema`` applied to each row and faults kept apart.

    ``required`` columns (default: all of the schema) must be in a file's
    header.  With ``whole_files`` a file with any fault gives no good rows;
    otherwise only the faulty rows are left out, and files that lack a required
    column.  Texts that mark a missing value are NULL, not faults.  Raises
    ValueError if there are no files or no good row is left.
    """
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    needed = list(schema.names if required is None else required)
    manifest = file_manifest(spark, path, glob)
    lacks = F.array_except(F.array(*[F.lit(c) for c in needed]), "header") if needed else F.array().cast("array<string>")
    missing = manifest.select("source_file", F.lit(1).cast("long").alias("line"), F.explode(lacks).alias("column"),
                              F.lit("the header lacks it").alias("reason"), F.concat_ws(",", "header").alias("text"))
    whole = manifest.where(F.size(lacks) == 0)
    folder = f"{checkpoint_dir(spark).rstrip('/')}/isolated-{uuid.uuid4().hex}"
    rows = placed_text(spark, path, whole, glob).select(
        "source_file", "block", "at", _problems(schema).alias("problems"),
        *[parsed_text(present_text(field(f.name)), f.dataType).alias(f.name) for f in schema.fields])
    rows = rows.withColumn("faulty", F.size("problems") > 0)
    rows.write.partitionBy("faulty").parquet(folder)
    stored = spark.read.schema(rows.schema).parquet(folder)
    good = stored.where(~F.col("faulty")).select("source_file", *schema.names)
    if whole_files:
        good = good.join(stored.where("faulty").select("source_file").distinct(), "source_file", "left_anti")
    quarantine = missing.unionByName(_faults(stored))
    if good.isEmpty():
        some = [f"{r['source_file'].rsplit('/', 1)[-1]} line {r['line']}: {r['column']}: {r['reason']}" for r in quarantine.limit(5).collect()]
        raise ValueError("nothing could be read" + (": " + "; ".join(some) if some else ""))
    return Isolated(good.select("source_file", *schema.names), quarantine)


def _faults(stored: DataFrame) -> DataFrame:
    """The faults of the stored rows.  Rows of a file's block were numbered one after the other as they were read,
    so a row's line follows from the counts of the blocks before its own (one row a block)."""
    blocks = stored.groupBy("source_file", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    bad = stored.where("faulty").select("source_file", "block", "at", F.explode("problems").alias("p"))
    line = F.col("at") - F.col("first") + F.col("before") + 2
    return bad.join(blocks, ["source_file", "block"]).select("source_file", line.alias("line"), "p.column", "p.reason", "p.text")


def machine_features(spark: SparkSession, path: str, glob: str = "*.csv", variables: Iterable[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Daily features of all machine files that can be read whole, and the quarantine of the others."""
    schema = StructType([StructField("timestamp", TimestampType()) if f.name == "timestamp" else f for f in READINGS_SCHEMA.fields])
    needed = ["machine_def", "timestamp", "variable_name", "value"]
    found = read_isolated(spark, path, schema, glob, needed)
    return daily_features(found.good, variables=variables), found.quarantine
