"""The registered queries of these operators, each over its whole table with production parameters.

``ORACLES`` has the equivalent SQL where SQL can state the result; the others are tested against
brute force, libraries and held-out labels in ``tests/llm``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from flowlens.llm import conversation_trie, hamming_topk, hard_negatives, jaccard_join, language_id, licences, line_dedup, packing, quality_pu, quality_rules, sentencepiece_bpe, toxicity, url_rules
from flowlens.llm.shipping import ship


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_ngram_jaccard_join(spark, sf):
    return jaccard_join.near_duplicates(_table(spark, sf, "documents"))


def op2_sentencepiece(spark, sf):
    return sentencepiece_bpe.round_trip(_table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_line_dedup(spark, sf):
    return line_dedup.digests(_table(spark, sf, "documents"))


def op4_quality_rules(spark, sf):
    return quality_rules.judge(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op5_best_fit_packing(spark, sf):
    return packing.pack(_table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_quality_classifier(spark, sf):
    return quality_pu.scores(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op7_exact_topk(spark, sf):
    return hamming_topk.search(_table(spark, sf, "embeddings"))


def op8_toxicity(spark, sf):
    return toxicity.scores(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op9_licence_scan(spark, sf):
    return licences.scan(_table(spark, sf, "documents"))


def op10_url_filter(spark, sf):
    return url_rules.judge(_table(spark, sf, "pages"))


def op11_language_id(spark, sf):
    return language_id.identify(_table(spark, sf, "documents"))


def op12_conversation_trie(spark, sf):
    return conversation_trie.rollup(conversation_trie.rebuilt(_table(spark, sf, "conversations")))


def op13_hard_negatives(spark, sf):
    return hard_negatives.mine(_table(spark, sf, "embeddings"), hard_negatives.query_label())


QUERIES = {f.__name__: f for f in (op1_ngram_jaccard_join, op2_sentencepiece, op3_line_dedup, op4_quality_rules, op5_best_fit_packing,
                                   op6_quality_classifier, op7_exact_topk, op8_toxicity, op9_licence_scan, op10_url_filter, op11_language_id, op12_conversation_trie,
                                   op13_hard_negatives)}
ORACLES = {"op1_ngram_jaccard_join": jaccard_join.ORACLE, "op3_line_dedup": line_dedup.ORACLE, "op7_exact_topk": hamming_topk.ORACLE,
           "op9_licence_scan": licences.ORACLE, "op10_url_filter": url_rules.ORACLE,
           "op12_conversation_trie": conversation_trie.ORACLE, "op13_hard_negatives": hard_negatives.ORACLE}
