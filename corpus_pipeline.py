"""A corpus pipeline: from raw documents to packed sequences.

Every stage gets the documents that the one before it kept and returns documents with the same columns;
the last one returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from flowlens.llm import jaccard_join, line_dedup, packing, quality_rules, toxicity
from flowlens.llm.shipping import ship
from flowlens.session import stage


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark, docs, sf_dir):
    """Documents whose toxicity score is below one half."""
    return toxicity.keep_clean(docs, _labels(spark, sf_dir))


def apply_quality_rules(spark, docs, sf_dir):
    """Documents that pass the base rules and the quality model."""
    return quality_rules.keep_good(docs, _labels(spark, sf_dir))


def drop_repeated_lines(spark, docs, sf_dir):
    """All documents, without the lines that ten or more of them share."""
    return line_dedup.drop_repeated_lines(docs)


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each near-duplicate class."""
    ship(spark)
    return jaccard_join.keep_one(docs)


def pack_sequences(spark, docs, sf_dir):
    """Pieces of all documents, placed in sequences."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("quality rules", apply_quality_rules), ("line dedup", drop_repeated_lines),
          ("n-gram Jaccard join", drop_near_duplicates), ("best-fit packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a table folder; each result is written to the shared scratch folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


# Trained stages and tokenisers cannot be stated in SQL; tests/llm compares the run with a brute-force version.
ORACLE_SQL = None
