"""From raw documents to token-ready text: five stages, each on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weirstone.llm import disclosure, golay_simhash, pareto_mix, piece_codec, subword_toxicity
from weirstone.llm.queries import model_path
from weirstone.session import shared_folder
from weirstone.sources import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the given labels."""
    return subword_toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest id."""
    return golay_simhash.first_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced; n_chars is that of the new text."""
    return disclosure.sanitise(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come near their target weights: documents repeat or go as the sample says."""
    return pareto_mix.mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids (with the end id), n_tokens and whether decoding gives the text back.

    A null text is encoded like an empty one.
    """
    return piece_codec.encode(docs, model_path())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixing),
    ("encoding", encoding),
]

# Trained models, components and an encoder cannot be expressed in SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
