"""Readers and writers for sensor and production files.

One read covers a whole directory (``pathGlobFilter`` selects the files) so
Spark plans one scan with one task per file split, instead of a loop over
files on the driver.  The file a row came from is taken from the hidden
``_metadata`` column, which is how a machine id encoded in a file name
reaches the rows.  Columns are found by header name and read as text; types
come from a schema or from one pass over all rows, never from a sample.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegralType, StringType, StructField, StructType

from moldwise.functions.columns import (machine_key, machine_key_from_path, or_fail, parse_date_monthfirst, present_text,
                                        to_number)
from moldwise.session import checkpoint_dir
from moldwise.sources.manifest import file_manifest, layouts

# Long sensor-reading layout: every field is read as text, values are parsed
# by the feature operators (a value column mixes numbers, durations, codes).
READINGS_SCHEMA = StructType([
    StructField("machine_def", StringType()),
    StructField("timestamp", StringType()),
    StructField("variable_name", StringType()),
    StructField("value", StringType()),
    StructField("variable_attribute", StringType()),
])


# A manifest is broadcast to the scan up to this many bytes of paths and places; beyond it each layout is a scan of its own.
MANIFEST_TO_SEND = 32 << 20


def _csv(spark: SparkSession, paths, names: Sequence[str], glob: str | None, check_header: bool) -> DataFrame:
    """CSV files as text columns ``names``, by place."""
    r = spark.read.option("header", True).option("enforceSchema", not check_header)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.schema(StructType([StructField(n, StringType()) for n in names])).csv(paths)


def placed_text(spark: SparkSession, path: str, manifest: DataFrame, glob: str | None = None) -> DataFrame:
    """Files of several layouts in one scan: (source_file, block, at, header, fields), the fields of a row by place.

    The fields are one more than the widest header has, so that what lies
    beyond a header can be seen; ``at`` numbers the rows of a block in order.  Each row gets its file's header from the
    manifest, broadcast if its size is within ``MANIFEST_TO_SEND``.
    """
    facts = manifest.agg(F.max(F.size("header")).alias("width"), F.sum(F.octet_length("source_file") + F.octet_length(F.concat_ws(",", "header"))).alias("bytes")).first()
    places = [f"c{i}" for i in range((facts["width"] or 0) + 1)]
    rows = _csv(spark, path, places, glob, check_header=False)
    rows = rows.select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("at"), F.array(*places).alias("fields"))
    known = manifest.select("source_file", "header")
    return rows.join(F.broadcast(known) if (facts["bytes"] or 0) <= MANIFEST_TO_SEND else known, "source_file")


def field(name: str) -> Column:
    """The field of column ``name`` in rows of ``placed_text``; NULL where the file lacks it."""
    return F.get("fields", F.array_position("header", name).cast("int") - 1)


def read_text_columns(spark: SparkSession, path: str, columns: Sequence[str] | None = None, glob: str | None = None,
                      with_source: bool = False) -> DataFrame:
    """CSV files with header rows as text columns, found by name.

    Files may order their columns differently or lack some (NULL).  Blank texts
    and marks for missing values (``NaN``, ``NA``, ...) become NULL.  Without
    ``columns`` all columns of all files are read, in the order in which they
    first occur (layouts of more files first).

    One job makes a manifest of all headers.  If the files agree, they are one
    plain scan, whose headers are checked again as they are read; if not, they
    are one scan by place that looks each file up in the manifest, or, with a
    manifest too large to broadcast, a scan for each layout.
    """
    manifest = file_manifest(spark, path, glob)
    found = layouts(manifest)
    names = list(columns) if columns is not None else list(dict.fromkeys(c for header, _ in found for c in header))
    source = [F.col("_metadata.file_path").alias("source_file")] if with_source else []

    def by_name(df: DataFrame, header: Sequence[str]) -> DataFrame:
        return df.select(*[present_text(F.col(f"`{c}`")).alias(c) if c in header else F.lit(None).cast("string").alias(c)
                           for c in names], *source)

    if not found:
        return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in [*names, *(["source_file"] if with_source else [])]]))
    plain = all(len(set(header)) == len(header) for header, _ in found)
    if len(found) == 1 and plain:
        return by_name(_csv(spark, path, found[0][0], glob, check_header=True), found[0][0])
    size = manifest.agg(F.sum(F.octet_length("source_file"))).first()[0]
    if plain and size > MANIFEST_TO_SEND:  # the lists of files are of the scans' own making: a scan holds its files on the driver
        lists = {tuple(r["header"]): r["files"] for r in manifest.groupBy("header").agg(F.collect_list("source_file").alias("files")).toLocalIterator()}
        frames = [by_name(_csv(spark, sorted(unquote(f) for f in files), header, None, check_header=True), header) for header, files in lists.items()]
        return reduce(DataFrame.unionByName, frames)
    rows = placed_text(spark, path, manifest, glob)
    return rows.select(*[present_text(field(c)).alias(c) for c in names], *(["source_file"] if with_source else []))


def parsed_text(text: Column, kind) -> Column:
    """A text as a value of type ``kind``; NULL where it doesn't fit."""
    name = kind.typeName()
    if name == "string":
        return text
    if isinstance(kind, IntegralType):
        number = to_number(text)
        return F.coalesce(F.trim(text).try_cast(kind), F.when(number == F.floor(number), number.try_cast(kind)))
    if isinstance(kind, (DoubleType, FloatType)):
        return to_number(text).cast(kind)
    if name == "date":
        return parse_date_monthfirst(text)
    return F.trim(text).try_cast(kind)


def _typed(c: str, kind, strict: bool):
    """A text column as ``kind``; a text that doesn't fit fails the job, or with ``strict=False`` becomes NULL."""
    text = F.col(f"`{c}`")
    parsed = parsed_text(text, kind)
    return or_fail(parsed, text, c) if strict and kind.typeName() != "string" else parsed


def numbers_where_possible(df: DataFrame) -> DataFrame:
    """Text columns as ``bigint`` or ``double`` where every value is a whole
    number or a number; others stay text.  One aggregate over all rows decides
    (nothing is sampled)."""
    cols = [f.name for f in df.schema.fields if f.dataType == StringType() and f.name != "source_file"]
    if not cols:
        return df
    facts = []
    for i, c in enumerate(cols):
        text, number = F.col(f"`{c}`"), to_number(F.col(f"`{c}`"))
        facts += [F.count(text).alias(f"n{i}"), F.count(number).alias(f"d{i}"), F.count(F.trim(text).try_cast("bigint")).alias(f"i{i}")]
    row = df.agg(*facts).first()
    kinds = {c: "bigint" if row[f"i{i}"] == row[f"n{i}"] else "double" for i, c in enumerate(cols)
             if row[f"n{i}"] and row[f"d{i}"] == row[f"n{i}"]}
    return df.withColumns({c: F.trim(F.col(f"`{c}`")).cast("bigint") if k == "bigint" else to_number(F.col(f"`{c}`"))
                           for c, k in kinds.items()}) if kinds else df


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, glob: str | None = None,
             with_source: bool = False, strict: bool = True) -> DataFrame:
    """CSV files with header rows; columns are found by name.

    With a schema its columns are parsed from text, and a value that doesn't
    fit fails the job (``strict=False``: NULL).  Without one, columns that
    hold only numbers become numbers, decided over all rows.
    """
    if schema is None:
        return numbers_where_possible(read_text_columns(spark, path, None, glob, with_source))
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    df = read_text_columns(spark, path, schema.names, glob, with_source)
    return df.select(*[_typed(f.name, f.dataType, strict).alias(f.name) for f in schema.fields],
                     *(["source_file"] if with_source else []))


def read_readings(spark: SparkSession, path: str, glob: str = "*.csv", machine_from_file: bool = False) -> DataFrame:
    """All sensor files under ``path`` matching ``glob`` as one DataFrame.

    With ``machine_from_file`` a ``machine_id`` column (``M-###``, or
    ``Unknown``) is derived from each row's file name.
    """
    df = read_csv(spark, path, READINGS_SCHEMA, glob, with_source=machine_from_file)
    if machine_from_file:
        df = df.withColumn("machine_id", machine_key_from_path(F.col("source_file")))
    return df


def read_production(spark: SparkSession, path: str, glob: str | None = None,
                    schema: StructType | str | None = None, strict: bool = True) -> DataFrame:
    """Production (order/shift) records from CSV."""
    return read_csv(spark, path, schema, glob, strict=strict)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def require_columns(df: DataFrame, required: Sequence[str]) -> bool:
    """Input gate on the schema only (no data read)."""
    return all(c in df.columns for c in required)


def filter_machine(df: DataFrame, machine_id: str, col: str = "machine_nr") -> DataFrame:
    """Rows of one machine, ids compared without ``-`` and spaces; a frame
    without the column yields no rows.  The predicate is a plain column
    expression, so it runs inside the scan's codegen stage."""
    if col not in df.columns:
        return df.limit(0)
    key = machine_id.replace("-", "").replace(" ", "")
    return df.where(machine_key(F.col(col), "strip") == F.lit(key))


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None,
                  mode: str = "overwrite", rebalance: bool = True) -> None:
    """Write a table; ``partition_by`` lays files out per key value so later
    reads prune whole directories (e.g. one machine).

    Rows are dealt by the partition columns before the write, so a value has
    few files instead of one a task; AQE splits a value that holds much and
    joins small ones (``rebalance=False``: written as they lie).  Mode
    ``overwrite_partitions`` replaces only the partitions that ``df`` has rows of.
    """
    dynamic = mode == "overwrite_partitions"
    if dynamic and not partition_by:
        raise ValueError("overwrite_partitions needs partition columns")
    if partition_by and rebalance:
        df = df.hint("rebalance", *[F.col(f"`{c}`") for c in partition_by])
    w = df.write.mode("overwrite" if dynamic else mode).format(fmt)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_sample(df: DataFrame, path: str, n: int = 100, fmt: str = "csv") -> None:
    """A small preview file (the first ``n`` rows of a sorted output)."""
    write_dataset(df.limit(n).coalesce(1), path, fmt)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}"
