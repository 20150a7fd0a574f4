"""A training corpus from the table documents: five stages, each written as Parquet and read again for the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.llm.common import scratch_path
from adjudica.llm.line_dedup import drop_repeated_lines
from adjudica.llm.mixing import mixed_documents
from adjudica.llm.near_dup import drop_near_duplicates
from adjudica.llm.packing import pack_documents
from adjudica.llm.queries import vocabulary
from adjudica.llm.rule_classifier import drop_low_quality, fit


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars, where there is one, says what is left of the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that the rule ensemble, learnt from the table labels, predicts to be of quality 0."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return drop_low_quality(docs, model, threshold=0.3)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes aligned blocks of 50 words or more from later documents, and documents of which nothing is left."""
    return _counted(drop_repeated_lines(docs, min_words=50))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: five words, similarity 0.8."""
    return drop_near_duplicates(docs, width=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixes sources by the weights 5, 2, 1 to 150 % of the words; a repeated document is as many rows."""
    return _counted(mixed_documents(docs, weights=(5.0, 2.0, 1.0), share=1.5, most=2.0))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens in sequences of at most 2048."""
    return pack_documents(docs, vocabulary(), end_id=0, capacity=2048)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("MinHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

#: The first stage fits a model and the last encodes tokens: no SQL. Tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
