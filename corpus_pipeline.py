"""Corpus pipeline over ``documents``: quality rules, near duplicates, personal
data, mixing to source weights, tokenising.

Every stage reads what the one before wrote and returns the columns of
``documents``, the last one with ids in place of ``text``:

1. quality rules: rejected documents go;
2. near duplicates: one document of each component stays;
3. personal data: spans are replaced by their kind, ``n_chars`` follows;
4. mix: documents are dropped or repeated to meet the source weights, dealt to
   shards and shuffled inside them (``doc_id`` repeats with the copies);
5. SentencePiece: ids of every text, one row per copy.

No SQL twin: the tagger and the mix are seeded models; tests compare the stages
with brute-force versions.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from wanderrank.llm import mixing, ngram_join, pii, quality, sentencepiece_codec
from wanderrank.llm.common import materialise, read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.first_of_component(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = os.environ.get("CORPUS_TOKENIZER", sentencepiece_codec.MODEL_PATH)
    keep = [c for c in docs.columns if c not in ("doc_id", "text", *sentencepiece_codec.RESULT)]
    return sentencepiece_codec.encode_documents(docs, model, keep=tuple(keep))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("sentencepiece", tokenise),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, f"stage-{name}")
    return docs
