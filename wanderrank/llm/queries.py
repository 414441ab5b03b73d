"""Registered queries of this subpackage: ``name -> (spark, sf_dir) -> DataFrame``
over whole tables, and the DuckDB twin of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wanderrank.llm import (fingerprints, html_extract, licenses, manifest, minhash, mixing, ngram_join, pii, quality, secret_scan,
                            sentencepiece_codec, sharding, spelling)
from wanderrank.llm.common import read_table
from wanderrank.llm.oracles import ORACLES  # noqa: F401


def _over(table: str, f):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(read_table(spark, sf_dir, table))
    return query


QUERIES = {
    "op1_secrets": _over("documents", secret_scan.scan_documents),
    "op2_sentencepiece": _over("documents", sentencepiece_codec.encode_documents),
    "op3_licenses": _over("documents", licenses.scan_documents),
    "op4_quality": _over("documents", quality.quality_documents),
    "op5_pii": _over("documents", pii.scan_documents),
    "op6_byte_shards": _over("documents", sharding.shard_documents),
    "op7_mix": _over("documents", mixing.mix_sizes),
    "op8_html": _over("pages", html_extract.extract_pages),
    "op9_ngram_jaccard": _over("documents", ngram_join.near_documents),
    "op10_merkle": _over("documents", fingerprints.fingerprint_documents),
    "op11_minhash": _over("documents", minhash.near_components),
    "op12_merkle_manifest": _over("documents", manifest.manifest_documents),
    "op13_spelling_variants": _over("documents", spelling.spelling_variants),
}
