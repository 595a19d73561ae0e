"""From documents to packed sequences: each stage works on all that the one before it kept.

Documents are tables read straight from Parquet files.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stationflow.llm import lines, mixing, packing, simhash, toxicity
from stationflow.llm.scratch import new_path

TOKENIZER, END_ID = "word_bpe_49k.json", 2


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifiers do not reject."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints hang together: three-word shingles, 3 bits or fewer apart."""
    return simhash.one_of_each(docs, from_files=True)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier place has."""
    return lines.remove_repeats(docs, from_files=True)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs, from_files=True)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 ids."""
    return packing.packed_pieces(docs, public_tokenizers.path(TOKENIZER), END_ID)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity_filter", toxicity_filter),
    ("simhash_dedup", simhash_dedup),
    ("line_dedup", line_dedup),
    ("source_mixing", source_mixing),
    ("sequence_packing", sequence_packing),
]

#: SQL can't express the classifier, the fingerprints and the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of `sf_dir`, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
