"""The training-data pipeline: five stages over ``documents``.

Each stage works on the rows that the one before it kept; ``run`` writes every stage's result as
Parquet under the shared checkpoint folder and reads it back for the next.

1. ``toxicity``: documents that the span model scores at one half or more go.
2. ``near_duplicates``: of each group of linked documents the one with the least id stays.
3. ``decontamination``: documents that hold a benchmark item go.
4. ``pii``: personal data in the texts is replaced by its kind; ``n_chars`` follows the text.
5. ``encoding``: texts become byte-level BPE ids, checked by decoding them.

Defined cases: null, empty and wordless texts pass every stage and are encoded as no ids; null ids are kept, rows that
repeat id and text are one after ``near_duplicates``; without labels nothing is toxic, without items nothing is a leak; an empty
table gives no rows; extra columns, whatever their names, pass all stages but the last.

All but the last return the columns of ``documents``. The result cannot be stated in SQL
(a trained model, a trained classifier, byte-pair merges), so ``ORACLE_SQL`` is None and
the tests compare with a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from audix.llm import bpe, decontaminate, ngram_join, pii, toxicity
from audix.llm.common import staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pii.redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.char_length("text").cast(kind))
    return out.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the packed ids and the hash of the bytes they decode to."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = bpe.encode_texts(docs, ranks, public_tokenizers.PATTERN, decode=True)
    return coded.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), "ids",
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates),
          ("decontamination", drop_contaminated), ("pii", redact_personal_data), ("encoding", encode)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written as Parquet and reread for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(spark, stage(spark, docs, sf_dir), name)
    return docs
