"""A corpus pipeline: quality rules, near-duplicates, repeated passages, source weights, packed sequences.

Counted as part of plumbline.llm. Each stage reads what the one before wrote; all but the last return
the columns of documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import mixing, packing, quality, simhash, substring
from plumbline.llm.common import table
from plumbline.llm.queries import tokenizer_path
from plumbline.sources.storage import forget, shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the model is fitted to the labelled documents of sf_dir."""
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share less than 0.8 of their five-word shingles with every document of a smaller id that stays.

    So of documents that are all alike the one with the smallest id stays.
    """
    return simhash.keep_representatives(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 50 words and more that a document with a smaller id has; n_chars follows the text."""
    return substring.strip_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def source_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.apply_mix(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens, with their ids."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_weights", source_weights),
    ("packed_sequences", packed_sequences),
]

#: The model of the first stage and the packing of the last are not SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written as Parquet to the shared folder and read again.

    What a stage wrote goes when the next one has been written; the last table goes with the session.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}-{name}"
        stage(spark, docs, sf_dir).write.parquet(folder)
        if before:
            forget(spark, before)
        docs, before = spark.read.parquet(folder), folder
    return STAGES[-1][1](spark, docs, sf_dir)
