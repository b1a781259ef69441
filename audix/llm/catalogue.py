"""The thin ``opN_*`` queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from audix.llm import alignment, bpe, collocations, decontaminate, fingerprint, language_id, nearest, ngram_join, pii, sharding, substring_dedup, toxicity, url_filter
from audix.llm.common import table

#: The listed host and path rules of op2.
URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
             ("net/es/", "block"), ("net/fr/", "block")]
N_SHARDS = 16


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    names, model = language_id.fit(language_id.sample(docs))
    rows = language_id.pages_and_documents(table(spark, sf_dir, "pages"), docs)
    return language_id.identify(rows, names, model, ["doc_id", "page_id"])


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [url_filter.host_rule(*r) for r in URL_RULES] + list(url_filter.PATTERNS)
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), rules)


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_join(table(spark, sf_dir, "documents"))


def rank_file() -> bytes:
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), rank_file(), public_tokenizers.PATTERN)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_edits(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_rows(table(spark, sf_dir, "documents"), N_SHARDS)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = alignment.read_files(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return alignment.align_corpus(table(spark, sf_dir, "documents"), files)


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_language_id": op1_language_id, "op2_url_filters": op2_url_filters, "op3_ngram_join": op3_ngram_join, "op4_byte_bpe": op4_byte_bpe, "op7_toxicity": op7_toxicity,
            "op5_pii": op5_pii, "op6_decontamination": op6_decontamination, "op8_fingerprints": op8_fingerprints,
            "op9_substring_dedup": op9_substring_dedup, "op10_sharding": op10_sharding,
            "op11_collocations": op11_collocations, "op12_tokenizer_alignment": op12_tokenizer_alignment,
            "op13_nearest_neighbours": op13_nearest_neighbours}
