"""Training corpus from ``documents``: toxic documents go, recurring lines go, near copies go, then mixing and packing.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept, which was written as Parquet.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tiermill.llm import line_dedup, mixing, near_dup, packing, queries
from tiermill.llm import toxicity as tox
from tiermill.llm.common import table
from tiermill.plans.staging import stage


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxic threshold; each row is kept or rejected by its own text, whatever its id."""
    return tox.below(docs, queries.toxicity_model(docs, table(spark, sf_dir, "labels")), queries.TOXIC_FROM)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines whose template recurs, short ones included."""
    return line_dedup.drop_lines(docs, words=1).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8): the one with the smallest doc_id.

    Documents without words are no copies and stay.  Of repeated rows one stays, and so does one of a group without ids.
    """
    return near_dup.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents sampled by calibrated probabilities."""
    return mixing.mix_weights(docs, queries.topic(), queries.MIX).where("sampled").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document and their places in sequences."""
    return packing.pack(packing.tokenized(docs, public_tokenizers.path(queries.TOKENIZER)))


STAGES = [("toxicity", toxicity), ("line dedup", lines), ("near-dedup", near_copies), ("mixing", mix), ("packing", pack)]
ORACLE_SQL = None  # a trained model, sketches and tokenization are beyond SQL; tests/llm plant rows for the first three stages


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
