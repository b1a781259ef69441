"""Removal of repeated passages by counted window hashes (operator 9).

A prefix-partitioned suffix tree is not built: there are two fixed depths only, and no nodes between them.

1. *Prefilter.* Hashes of ``PREFIX`` words are counted over sampled
   suffixes: in every window the one whose prefix hash is least. Equal windows sample the same
   offset, so a window that occurs twice has its sampled prefix at least twice. Prefixes that occur
   once are dropped: most of the corpus ends here.
2. *Windows.* All windows of ``WINDOW`` words that sampled a remaining prefix are hashed whole and counted by
   partial counts merged by key, never lists, so none outgrows memory.
3. *Repeats* are the windows counted twice or more; runs of
   such windows in a document are its maximal repeats, and their words go.

Documents with equal word sequences are one class; if a class has two documents, all its windows
are repeated. Texts move only where a prefix node is shared (a bit table of fixed size keeps most of the others in
place, an exact join follows).

Defined cases: a null text has no words; texts of fewer words than a window lose none;
null and repeated ids are documents of their own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audix.llm import textvec
from audix.llm.common import join_counted, staged
from audix.llm.bits import bit_table, is_set

WINDOW = 35
PREFIX = 8


def _sequence(text: bytes) -> tuple[int, bytes, bytes]:
    """Number of words, class key and hash of the words joined by one blank."""
    words = text.split()
    sha = hashlib.sha256(b" ".join(words)).digest()
    return len(words), sha[:16], sha


def _sampled(w: textvec.Words, window: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the windows of a block, the sampled position of each, and the prefix hashes of all positions."""
    starts = np.arange(max(0, len(w.doc) - window + 1))
    starts = starts[w.doc[starts] == w.doc[starts + window - 1]]
    heads = textvec.gram_hashes(w.hashes, prefix)
    if not len(starts):
        return starts, starts, heads
    least = np.lib.stride_tricks.sliding_window_view(heads, window - prefix + 1)[starts].argmin(axis=1)
    return starts, starts + least, heads


def _describe(window: int, prefix: int):
    def run(batches):
        for batch in textvec.small_batches(batches):
            texts = textvec.raw_texts(batch.column(1))
            found = [_sequence(t) for t in texts]
            bounds, heads_of = [np.zeros(1, np.int64)], []
            for w in textvec.blocks(texts):
                _, at, heads = _sampled(w, window, prefix)
                at = np.unique(at)
                heads_of.append(heads[at])
                bounds.append(bounds[-1][-1] + np.searchsorted(w.doc[at], np.arange(1, w.count + 1)))
            values = np.concatenate(heads_of) if heads_of else np.empty(0, np.uint64)
            n, key, sha = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(key, pa.binary()),
                 pa.array([_key_hash(k) for k in key], pa.int64()), pa.array(sha, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.concatenate(bounds), pa.int32()), pa.array(values.view(np.int64)))],
                ["doc_id", "n_words", "key", "key_hash", "sha", "heads"])

    return run


def _grow(window: int, prefix: int):
    """Full-depth nodes of the windows that sampled a shared prefix node: (cid, start, node)."""
    def run(batches):
        for batch in textvec.small_batches(batches, 256):
            cid = batch.column(0).to_numpy()
            texts = textvec.raw_texts(batch.column(1))
            for w in textvec.blocks(texts):
                starts, at, heads = _sampled(w, window, prefix)
                part = batch.column(2).slice(w.first, w.count)
                shared = np.unique(part.flatten().to_numpy().view(np.uint64))
                if not len(starts) or not len(shared):
                    continue
                starts = starts[np.isin(heads[at], shared)]
                node = textvec.gram_hashes(w.hashes, window)[starts].view(np.int64)
                doc = w.doc[starts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cid[w.first + doc]), pa.array((starts - w.bounds[doc]).astype(np.int32)), pa.array(node)],
                    ["cid", "start", "node"])

    return run


def _cut(window: int):
    """Words left when those covered by repeated windows go: (cid, n_removed, sha, spans)."""
    def run(batches):
        for batch in textvec.small_batches(batches, 256):
            out = []
            for cid, text, starts in zip(*(batch.column(c).to_pylist() for c in range(3))):
                words = text.encode().split()
                edge = np.zeros(len(words) + 1, np.int64)
                starts = np.array(starts)
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + window, -1)
                covered = np.cumsum(edge)[:-1] > 0
                kept = b" ".join([x for x, c in zip(words, covered.tolist()) if not c])
                turns = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
                spans = [{"start": a, "end": b} for a, b in zip(turns[::2].tolist(), turns[1::2].tolist())]
                out.append((cid, int(covered.sum()), hashlib.sha256(kept).digest(), spans))
            cid, n, sha, spans = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(cid, pa.int64()), pa.array(n, pa.int64()), pa.array(sha, pa.binary()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                ["cid", "n_removed", "sha", "spans"])

    return run


def _key_hash(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def _suspects(rows: DataFrame, bits: np.ndarray) -> DataFrame:
    """``_text`` and class ``key`` of the rows whose key has its bit set."""
    table = rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in textvec.small_batches(batches):
            keys = [_sequence(t)[1] for t in textvec.raw_texts(batch.column(0))]
            keep = is_set(table.value, np.array([_key_hash(k) for k in keys], np.int64))
            out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary())], ["_text", "key"])
            yield out.filter(pa.array(keep, pa.bool_()))

    return rows.select("_text").mapInArrow(run, "_text string, key binary")


def remove_repeats(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", window: int = WINDOW,
                   prefix: int = PREFIX) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and spans (word ranges removed) of every row."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    described = staged(spark, rows.mapInArrow(_describe(window, prefix),
                       f"doc_id {kind}, n_words bigint, key binary, key_hash bigint, sha binary, heads array<bigint>"), "suffix-heads")
    classes = staged(spark, described.where("n_words >= " + str(window)).groupBy("key")
                     .agg(F.count("*").alias("copies"), F.first("heads").alias("heads"),
                          F.first("n_words").alias("n_words"), F.first("key_hash").alias("key_hash"))
                     .withColumn("cid", F.monotonically_increasing_id()), "suffix-classes")

    heads = classes.select("cid", F.explode("heads").alias("head"))
    inner = heads.groupBy("head").count().where("count > 1").select("head")
    shared = staged(spark, join_counted(heads, inner, "head").groupBy("cid").agg(F.collect_set("head").alias("heads"))
                    .join(classes.select("cid", "key", "key_hash", "copies"), "cid"), "suffix-shared")
    suspects = rows.where(F.octet_length("_text") >= 2 * window - 1)
    texts = (_suspects(suspects, bit_table(shared.select("key_hash")))
             .groupBy("key").agg(F.first("_text").alias("_text")))
    texts = staged(spark, texts.join(shared, "key").select("cid", "_text", "heads", "copies"), "suffix-texts")

    grown = texts.select("cid", "_text", "heads").mapInArrow(_grow(window, prefix), "cid bigint, start int, node bigint")
    deep = grown.groupBy("node").count().where("count > 1").select("node")
    single = texts.where("copies = 1").select("cid", "_text")
    repeats = (join_counted(grown, deep, "node").groupBy("cid").agg(F.collect_list("start").alias("starts")))
    cut = (single.join(repeats, "cid").select("cid", "_text", "starts")
           .mapInArrow(_cut(window), "cid bigint, n_removed bigint, sha binary, "
                                     "spans array<struct<start:bigint,end:bigint>>"))
    whole = classes.where("copies > 1").select(
        "key", F.col("n_words").alias("n_removed"), F.unhex(F.sha2(F.lit("").cast("binary"), 256)).alias("kept"),
        F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_words").alias("end"))).alias("spans"))
    partly = (cut.join(classes.select("cid", "key"), "cid")
              .select("key", "n_removed", F.col("sha").alias("kept"), "spans"))
    changed = staged(spark, whole.unionByName(partly), "suffix-changed")
    return (described.drop("heads", "key_hash").join(changed, "key", "left")
            .select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
                    F.lower(F.hex(F.coalesce("kept", "sha"))).alias("kept_sha256"),
                    F.coalesce("spans", F.array()).alias("spans")))
