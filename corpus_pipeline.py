"""A corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Quality classifier, toxicity, n-gram Jaccard join, benchmark decontamination,
SentencePiece encoding and decoding.  The stages work on whole texts; each but
the last returns the columns of its input, without the rows that it rejects.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moldwise.llm import decontaminate, jaccard, segment
from moldwise.llm import quality as quality_model
from moldwise.llm import toxicity as toxicity_model
from moldwise.session import checkpoint_dir

#: The driver's SQL check has none: trained models and sampled segmentations aren't SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model doesn't reject (score under its threshold: rejected)."""
    model = quality_model.train(docs, _labels(spark, sf_dir))
    scored = quality_model.quality(docs, model, "__quality_score")
    return scored.where(F.col("__quality_score") >= quality_model.THRESHOLD).select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is under one half."""
    model = toxicity_model.train(docs, _labels(spark, sf_dir))
    scored = toxicity_model.toxicity(docs, model, "__")
    return scored.where(F.col("__toxic_score") < 0.5).select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (smallest id) of each group that links of shingle sets connect."""
    return jaccard.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of any benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    marked = decontaminate.contamination(docs, items, prefix="__")
    return marked.where(F.size("__hit_words") == 0).select(*docs.columns)


def sampled_segmentations(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every document that is left, decoded again."""
    return segment.segmentation_report(docs)


STAGES = [
    ("quality", keep_quality),
    ("toxicity", drop_toxic),
    ("near_copies", one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("segmentation", sampled_segmentations),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
