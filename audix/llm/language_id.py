"""Language identification by Bayesian fusion of evidence (operator 1).

Every row brings a text and, where it has them, a declared markup language, an address
suffix and a host. The posterior of a language multiplies

* the text's likelihood under a model of byte trigrams per language, tempered so
  that a text speaks with the weight of at most ``EVIDENCE`` trigrams;
* the likelihood of the declaration, estimated over all rows from what the texts say of rows
  that declare the same;
* the host's prior: the language shares of the host's other rows, smoothed towards those
  of its suffix, which are smoothed towards those of all rows.

The trigram model knows every language that labels a non-empty text, up to ``MAX_LANGUAGES``; more are an
error, none is left out. It is fitted on a bounded sample: of each language at most ``SAMPLE`` documents (all
languages together at most ``SAMPLE * SHARED``, one of each at least), outside the held-out fold unless
the language has no others, and of each document its first ``SAMPLE_BYTES``. Declarations, suffixes and hosts are grouped
aggregates over every row, joined back by key; a host that holds a third of the rows is summed in
parts and met by a join that Spark can split.

Defined cases: null and empty texts say nothing (the prior and the declaration decide); null or empty
evidence is left out; null ids and repeated rows are judged one by one; without labelled
documents the language is null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audix.llm import textvec
from audix.llm.common import ascii_lower, literal_table, staged

BUCKETS = 1 << 16
#: Trigrams whose weight a text has at most.
EVIDENCE = 100.0
#: Documents per language that the model is fitted on, and the bytes that are read of each.
SAMPLE, SAMPLE_BYTES = 400, 1 << 14
#: Languages up to which each has a full sample, and languages up to which a model is made at all.
SHARED, MAX_LANGUAGES = 64, 512
#: Languages whose likelihoods are summed at a time.
TOGETHER = 8
#: Rows that a suffix's or all rows' shares count for in a host's prior.
WEIGHT = 5.0

_fold = np.arange(256, dtype=np.uint32)
_fold[65:91] += 32
_fold[~textvec.ALPHANUMERIC] = 32
_fold[48:58] = 32


def trigram_buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every trigram of the texts together, and where each text's begin.

    A text's trigrams run from its two leading blanks to its trailing ones, so none reaches into its neighbour.
    """
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 3
    b = _fold[np.frombuffer(b"  " + b"   ".join(texts) + b"   ", np.uint8)]
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    at = (code * np.uint32(2654435761)) >> np.uint32(16)
    return at, np.concatenate([[0], np.cumsum(lengths)[:-1]])


def fit(texts: dict[str, list[bytes]]) -> tuple[list[str], np.ndarray]:
    """Languages, and the log-probability of each bucket in each of them (buckets x languages)."""
    names = sorted(texts)
    table = np.zeros((BUCKETS, len(names)), np.float32)
    for k, name in enumerate(names):
        counts = np.bincount(trigram_buckets(texts[name])[0], minlength=BUCKETS) + 0.5
        table[:, k] = np.log(counts / counts.sum())
    if names:
        table -= table.mean(axis=1, keepdims=True)
    return names, table


def likelihoods(texts: list[bytes], table: np.ndarray) -> np.ndarray:
    """Tempered log-likelihood of each text in each language; zeros for empty texts."""
    out = np.zeros((len(texts), table.shape[1]))
    first, size = 0, 0
    for i in range(len(texts) + 1):
        if i == len(texts) or (size and size + len(texts[i]) > textvec.BLOCK):
            if i > first:
                at, starts = trigram_buckets(texts[first:i])
                own = np.array([len(t) for t in texts[first:i]])
                sums = np.concatenate([np.add.reduceat(table[at, k:k + TOGETHER].astype(np.float64), starts, axis=0)
                                       for k in range(0, table.shape[1], TOGETHER)], axis=1)
                out[first:i] = sums / np.maximum(1, own / EVIDENCE)[:, None] * (own > 0)[:, None]
            first, size = i, 0
        if i < len(texts):
            size += len(texts[i]) + 3
    return out


def held_out(id_col: Column) -> Column:
    """Rows that never train: crc32 of the id as text leaves no remainder by 5."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", lang_col: str = "lang",
           per_language: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES,
           max_languages: int = MAX_LANGUAGES) -> dict[str, list[bytes]]:
    """The bounded training sample: the first labelled documents of each language in hash order.

    Raises ValueError if the labels name more than ``max_languages`` languages.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        (F.length("lang") > 0) & (F.length("text") > 0))
    # Rows without an id are told apart by their texts.
    rows = rows.select("lang", F.when(F.col("id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("id")).alias("key"),
                       held_out(F.col("id")).alias("held"), "text")
    counted = rows.groupBy("lang").agg(F.approx_count_distinct(F.when(~F.col("held"), F.col("key"))).alias("free"),
                                       F.approx_count_distinct("key").alias("every"))
    known = counted.limit(max_languages + 1).collect()
    if len(known) > max_languages:
        raise ValueError(f"labels name more than max_languages = {max_languages} languages")
    if not known:
        return {}
    quota = min(per_language, max(1, per_language * SHARED // len(known)))

    def below(cuts: list[dict]) -> DataFrame:
        """Rows that may train and whose key is at most their language's cut."""
        cut = literal_table(docs.sparkSession, cuts, "lang:string,cut:bigint,only_held:boolean")
        return rows.join(F.broadcast(cut), "lang").where((F.col("key") <= F.col("cut")) & (F.col("held") == F.col("only_held")))

    # Keys first, so that no task sends more than keys to choose from: hashes are even, so a share of their range
    # holds a share of the documents, and twice the share that is wanted leaves room for the estimate's error.
    cuts = [{"lang": r["lang"], "only_held": not r["free"], "cut": min(
        (1 << 63) - 1, -(1 << 63) + ((2 * quota + 100) << 64) // (r["free"] or r["every"]))} for r in known]
    keys: dict[str, list[int]] = {r["lang"]: [] for r in known}
    for r in below(cuts).select("lang", "key").distinct().collect():
        keys[r["lang"]].append(r["key"])
    cuts = [c | {"cut": sorted(keys[c["lang"]])[:quota][-1]} for c in cuts]
    # Then the texts of those only.
    chosen = (below(cuts).groupBy("lang", "key").agg(F.min(F.left("text", F.lit(sample_bytes))).alias("text"))
              .select("lang", "text").collect())
    out: dict[str, list[bytes]] = {name: [] for name in keys}
    for r in chosen:
        out[r["lang"]].append(r["text"].encode()[:sample_bytes])
    return out


def markup_text(html: Column) -> Column:
    """Visible text of a page."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(bare, r"(?s)<[^>]*>", " ")


def markup_language(html: Column) -> Column:
    return ascii_lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))


def suffix_of(host: Column) -> Column:
    return F.regexp_extract(host, r"([A-Za-z0-9-]+)(?::[0-9]*)?$", 1)


def identify(rows: DataFrame, names: list[str], table: np.ndarray, keep: list[str]) -> DataFrame:
    """Language of every row with columns text, declared, suffix and host (any may be null).

    Returns the columns ``keep`` and lang, probability, text_lang.
    """
    if not names:
        none = {"lang": "string", "probability": "double", "text_lang": "string"}
        return rows.select(*keep, *(F.lit(None).cast(t).alias(c) for c, t in none.items()))
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(table)
    # Keys for grouping: a null piece of evidence is the empty string.
    given = rows.select(F.col("text").alias("_text"), *(F.coalesce(c, F.lit("")).alias(f"_{c}")
                        for c in ("declared", "suffix", "host")), F.struct(*keep).alias("_keep"))

    fields = given.columns[1:]

    def run(batches):
        for batch in textvec.small_batches(batches):
            values = likelihoods(textvec.raw_texts(batch.column(0)), shared.value)
            top = np.exp(values - values.max(axis=1, keepdims=True)) if values.shape[1] else values
            share = top / top.sum(axis=1, keepdims=True)
            lists = [pa.array(list(x), pa.list_(pa.float64())) for x in (values, share)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *lists], [*fields, "_text_log", "_share"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.drop("_text").schema)
    judged = staged(spark, given.mapInArrow(run, f"{schema}, _text_log array<double>, _share array<double>"), "language")

    k = range(len(names))

    def summed(*by: str) -> DataFrame:
        return judged.groupBy(*by).agg(F.array(*(F.sum(F.get("_share", F.lit(i))) for i in k)).alias("_sum"))

    total = [x or 0.0 for x in summed().first()["_sum"]]
    mass = sum(total) + len(names)
    overall = F.array(*(F.lit((x + 1) / mass) for x in total))

    def shares(sums: Column, parent: Column) -> Column:
        n = F.aggregate(sums, F.lit(0.0), lambda a, x: a + x) + WEIGHT
        return F.zip_with(sums, parent, lambda s, p: (F.greatest(s, F.lit(0.0)) + WEIGHT * p) / n)

    suffixes = summed("_suffix").select("_suffix", F.when(F.col("_suffix") != "", shares(F.col("_sum"), overall))
                                        .otherwise(overall).alias("_suffix_share"))
    hosts = summed("_host", "_suffix").where("_host != ''").withColumnRenamed("_sum", "_host_sum")
    # The added keys make both sides of these joins shuffle for them, so that one frequent host or suffix can be split.
    host_key, suffix_key = F.xxhash64("_host", "_suffix"), F.xxhash64("_suffix", F.lit(1))
    hosts = (hosts.withColumn("_key", suffix_key).join(suffixes.withColumn("_key", suffix_key), ["_suffix", "_key"])
             .withColumn("_key", host_key))
    declared = (summed("_declared").where("_declared != ''")
                .select("_declared", F.zip_with("_sum", F.array(*(F.lit(float(x)) for x in total)),
                                                lambda s, t: F.log((s + 0.1) / (t + 1.0))).alias("_declared_log")))
    joined = (judged.withColumn("_key", host_key).join(hosts, ["_host", "_suffix", "_key"], "left")
              .join(declared, "_declared", "left"))
    others = F.zip_with("_host_sum", "_share", lambda s, p: s - p)
    prior = F.when(F.col("_host_sum").isNotNull(), shares(others, F.col("_suffix_share"))).otherwise(overall)
    logs = F.zip_with("_text_log", F.transform(prior, lambda p: F.log(p)), lambda a, b: a + b)
    logs = F.when(F.col("_declared_log").isNotNull(),
                  F.zip_with(logs, "_declared_log", lambda a, b: a + b)).otherwise(logs)
    joined = joined.withColumn("_log", logs).withColumn("_best", F.array_max("_log"))
    known = F.array(*(F.lit(n) for n in names))
    weight = F.aggregate(F.transform("_log", lambda x: F.exp(x - F.col("_best"))), F.lit(0.0), lambda a, x: a + x)
    return joined.select(
        "_keep.*", F.get(known, F.array_position("_log", F.col("_best")).cast("int") - 1).alias("lang"),
        (F.lit(1.0) / weight).alias("probability"),
        F.get(known, F.array_position("_text_log", F.array_max("_text_log")).cast("int") - 1).alias("text_lang"))


def pages_and_documents(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """The common form of both tables: a document's source stands for its host."""
    none = F.lit(None).cast("string")
    doc_type = docs.schema["doc_id"].dataType
    page_type = pages.schema["page_id"].dataType
    host = host_of(F.coalesce("url", F.lit("")))
    return pages.select(
        F.lit(None).cast(doc_type).alias("doc_id"), F.col("page_id"), markup_text(F.col("html")).alias("text"),
        markup_language(F.coalesce("html", F.lit(""))).alias("declared"), suffix_of(host).alias("suffix"),
        host.alias("host")).unionByName(docs.select(
            "doc_id", F.lit(None).cast(page_type).alias("page_id"), F.col("text"), none.alias("declared"),
            none.alias("suffix"), F.concat(F.lit("source:"), F.col("source")).alias("host")))
