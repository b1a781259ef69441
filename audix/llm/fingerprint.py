"""Threshold-scaled document fingerprints (operator 8).

The sketch of a text holds the hash of every shingle (two consecutive words;
the only word of a one-word text) that lies below the fixed fraction ``1 / 2**SCALE_BITS``
of the hash range, cut to 31 bits. Whether a shingle is kept depends on the shingle alone, so
sketches merge by union, and the share of one sketch that lies in another estimates
containment even between very unequal documents. A fingerprint is the hash of the whole text,
a colon and the sketch.

DataFrame functions only. Neighbours in descending id order come from a range-partitioned table
of ids; texts move once by id, and of each next document only the needed head and
sketch move to its predecessor.

Defined cases: a null text counts as an empty one; texts without a kept shingle are alike (1)
if the texts are equal, else 0; rows with equal id and text are one document in the
order and all get its result; equal ids with different texts follow each other by text hash; null
ids come last; a single document is its own next; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from audix.llm.common import staged, words

#: Shingles whose hash starts with so many zero bits are kept.
SCALE_BITS = 2
#: Ids that are put in order by one task.
PIECE_ROWS = 100_000


def with_sketch(df: DataFrame, text_col: str, out: str, scale_bits: int = SCALE_BITS) -> DataFrame:
    """Add the sorted sketch (array of int) of a text column as column ``out``."""
    w = f"{out}_words"
    df = df.withColumn(w, words(F.col(text_col)))
    pairs = F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), lambda a, b: F.xxhash64(a, b))
    hashes = F.slice(pairs, 1, F.greatest(F.size(w) - 1, F.lit(1)))
    below = 1 << (64 - scale_bits)
    kept = F.filter(hashes, lambda h: (h >= 0) & (h < below))
    cut = F.transform(kept, lambda h: F.shiftright(h, 33 - scale_bits).cast("int"))
    return df.withColumn(out, F.sort_array(F.array_distinct(cut))).drop(w)


def merge(a: Column, b: Column) -> Column:
    """Sketch of two documents together."""
    return F.sort_array(F.array_union(a, b))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the first document's shingles that the second has (null if its sketch is empty)."""
    return F.try_divide(F.size(F.array_intersect(a, b)), F.size(a))


def likeness(a: Column, b: Column, equal: Column) -> Column:
    """Estimated Jaccard similarity, 0 to 1; ``equal`` (are the texts?) decides between empty sketches."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either > 0, both / either).otherwise(equal.cast("double"))


def fingerprint(text: Column, sketch: Column) -> Column:
    return F.concat(F.lpad(F.hex(F.xxhash64(text)), 16, "0"), F.lit(":"),
                    F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 8, "0")), ","))


def neighbours(keys: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``key, n, prev_key, prev_n`` for distinct rows ``_id, _hash, key, n``, a ring in descending order.

    Pieces of consecutive ids are ordered by one task each; the first and last
    rows of the pieces, a few for every ``piece_rows`` ids, link them.
    """
    spark = keys.sparkSession
    rows = staged(spark, keys, "fingerprint-keys")
    pieces = max(1, -(-rows.count() // piece_rows))
    order = [F.col("_id").desc_nulls_last(), F.col("_hash")]
    rows = staged(spark, rows.repartitionByRange(pieces, *order).withColumn("_piece", F.spark_partition_id()),
                  "fingerprint-order")
    before = Window.partitionBy("_piece").orderBy(*order)
    me = F.struct("key", "n")
    linked = rows.withColumn("_prev", F.lag(me).over(before)).withColumn("_next", F.lead("key").over(before))
    ends = Window.orderBy("_piece")
    closing = linked.where(F.col("_next").isNull()).select("_piece", me.alias("_last"))
    closing = closing.select("_piece", F.coalesce(
        F.lag("_last").over(ends),
        F.last("_last").over(ends.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_before"))
    return (linked.join(closing, "_piece")
            .withColumn("_prev", F.coalesce("_prev", "_before"))
            .select("key", "n", F.col("_prev.key").alias("prev_key"), F.col("_prev.n").alias("prev_n")))


def fingerprint_edits(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness and that to the next document's.

    The edited text has its last third of characters replaced by as many first
    ones of the next document in descending id order.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    digest = F.xxhash64("text")
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.hex(digest))
    keys = rows.select(F.col("doc_id").alias("_id"), digest.alias("_hash"), key.alias("key"),
                       F.char_length("text").cast("long").alias("n")).distinct()
    ring = staged(docs.sparkSession, neighbours(keys), "fingerprint-ring")
    rows = rows.withColumn("key", key)
    placed = rows.join(ring.select("key", "prev_key", "prev_n"), "key")

    head = F.expr("left(text, int(prev_n div 3))")
    # Grouped by the own key, whose order the join has left, so nothing is sorted for it.
    sent = (with_sketch(placed, "text", "next_sketch")
            .select("key", "prev_key", F.struct(head.alias("head"), "next_sketch", digest.alias("digest"),
                                                F.col("doc_id").alias("doc_id")).alias("_sent"))
            .groupBy("key").agg(F.first("prev_key").alias("_to"), F.first("_sent").alias("next"))
            .select(F.col("_to").alias("key"), "next"))
    both = with_sketch(rows.join(sent, "key"), "text", "sketch").withColumn("n", F.char_length("text").cast("long"))
    both = both.withColumn("edited", F.concat(F.expr("left(text, int(n - n div 3))"), "next.head"))
    both = with_sketch(both, "edited", "edited_sketch")
    return both.select(
        "doc_id", F.col("n").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("text"), F.col("sketch")).alias("fingerprint"),
        fingerprint(F.col("edited"), F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch"), F.col("text") == F.col("edited")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next.next_sketch"), digest == F.col("next.digest")).alias("near_next"),
        F.col("next.doc_id").alias("next_doc_id"))
