"""A corpus pipeline: five stages over ``documents``, each written as Parquet and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm.common import prepare, shared_dir
from shelfmark.llm.decontaminate import without_contaminated
from shelfmark.llm.mixing import mixed_documents
from shelfmark.llm.near import one_per_class
from shelfmark.llm.queries import END_MARK, RANKS, TOKENIZERS
from shelfmark.llm.tokens import Vocabulary, materialise
from shelfmark.llm.toxicity import train, with_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not mark as toxic."""
    prepare(spark)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return with_toxicity(docs, model).where("predicted = 0").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group tied by word n-gram similarity of 0.8 or more."""
    prepare(spark)
    return one_per_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of any benchmark item."""
    prepare(spark)
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them."""
    prepare(spark)
    return mixed_documents(docs)


def training_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences in shuffled binary shards; one row per sequence."""
    prepare(spark)
    return materialise(docs, Vocabulary.read(f"{TOKENIZERS}/{RANKS}", END_MARK))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("training_order", training_order),
]

# The first stage is a trained classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in turn; every result but the last is written to the shared folder and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
