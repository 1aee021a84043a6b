"""A manifest of delimited files: path, size and header of each, by one job.

The job has a task for each file, which reads the file's first lines only
(through Spark's own reader, so any store that Spark reads will do) and stops.
The manifest is stored in the shared folder; readers look up columns in it
instead of opening files from the driver.
"""

from __future__ import annotations

import csv
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moldwise.session import checkpoint_dir

MANIFEST_SCHEMA = "source_file string, size long, header array<string>"
# One file a task, never split: a split's allowance is used up by opening a file.
_ONE_FILE_A_TASK = {"spark.sql.files.maxPartitionBytes": str(1 << 40), "spark.sql.files.openCostInBytes": str(1 << 40),
                    "spark.sql.execution.arrow.maxRecordsPerBatch": "16"}


def header_names(line: str) -> list[str]:
    """Column names of a header line; a nameless one is called by its place, of repeated ones the first counts."""
    names = next(csv.reader([line.lstrip("﻿")]), [])
    return [name if name.strip() else f"_c{i}" for i, name in enumerate(names)]


def _first_lines(batches):
    for batch in batches:
        for line, path, size in zip(*(c.to_pylist() for c in batch.columns)):
            if line.strip():
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size], pa.int64()),
                                                  pa.array([header_names(line)], pa.list_(pa.string()))],
                                                 names=["source_file", "size", "header"])
                return  # the rest of the file isn't read


def file_manifest(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(source_file, size, header) of every file under ``path`` that has a line; the first one that isn't blank is its header."""
    apart = spark.newSession()  # the settings are for this job's scan alone
    for key, value in _ONE_FILE_A_TASK.items():
        apart.conf.set(key, value)
    lines = apart.read.format("text")
    if glob:
        lines = lines.option("pathGlobFilter", glob)
    folder = f"{checkpoint_dir(spark).rstrip('/')}/manifest-{uuid.uuid4().hex}"
    rows = lines.load(path).select("value", "_metadata.file_path", "_metadata.file_size")
    rows.mapInArrow(_first_lines, MANIFEST_SCHEMA).write.parquet(folder)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(folder)


def layouts(manifest: DataFrame) -> list[tuple[list[str], int]]:
    """The different headers, each with its number of files, most files first: as many rows as there are layouts."""
    rows = manifest.groupBy("header").agg(F.count(F.lit(1)).alias("files"), F.min("source_file").alias("first")).collect()
    return [(list(r["header"]), r["files"]) for r in sorted(rows, key=lambda r: (-r["files"], r["first"]))]
