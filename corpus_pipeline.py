"""A training-corpus pipeline over ``documents``: each stage calls one operator and keeps what it decides.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. run() writes each stage's result as Parquet in the shared
folder and gives it to the next stage, so a lost executor costs one stage's tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm import mixing, pii, quality_gam, sentencepiece_fst, simhash
from roadlens.llm.common import shared_folder, ship, table
from roadlens.llm.queries import quality_weights, tokenizer


def _counted(docs: DataFrame) -> DataFrame:
    """With n_chars, where there is such a column, as the texts are now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    ship(spark)
    return quality_gam.select_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the least id; a null id comes last."""
    ship(spark)
    return simhash.one_of_each(docs, shingle=3, max_distance=2)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind in brackets."""
    return _counted(pii.redact(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; one a source may be cut to the words that its budget has left."""
    return _counted(mixing.mixed_documents(docs, quality_weights(spark, sf_dir)))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the ids of their texts."""
    ship(spark)
    return sentencepiece_fst.with_tokens(docs, tokenizer())


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mixture", mixture), ("tokens", tokens)]

#: SQL can't state the learned, linked and tokenised stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
