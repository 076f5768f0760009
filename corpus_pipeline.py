"""The corpus pipeline: documents pass the stages in order, each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataline.llm import jaccard, mixing, packing, pii, quality
from strataline.llm.common import table
from strataline.llm.queries import MIX, domain, tokenizer_files
from strataline.session import stage as written


def _counted(docs: DataFrame) -> DataFrame:
    """Documents whose texts have changed, with their number of characters."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the quality rules reject."""
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one of the documents whose five-word shingles are equal to eight tenths."""
    return jaccard.representatives(docs, jaccard.Similarity(words=5, percent=80))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by marks of its kind."""
    return _counted(pii.redact(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source's share of the token budget."""
    return _counted(mixing.select(docs, domain(), MIX))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences of 1024 ids."""
    return packing.pack(docs, tokenizer_files())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", filter_quality),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Rules are learned and ids come from a tokenizer, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = written(step(spark, docs, sf_dir), name)
    return docs
