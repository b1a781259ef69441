"""N-gram Jaccard self-join as a blocked sparse matrix product (operator 3).

A document is the set of hashes of its five-word shingles: a row of the
document-by-shingle incidence matrix. Documents link when
``100 * |A & B| >= 75 * |A | B|``. Rows with equal sets are merged into one class first.

1. *Blocking keys.* Of the ``LOWEST`` smallest hashes of a class every two
   neighbours make a key. Linked classes share a key: in the ordered union of their sets a fraction of at
   least 0.75 is common, and no two common hashes stand side by side among the first 40 with a
   probability below 4e-10 at the threshold itself, 4e-12 at 0.8 (hashes are random; sets of up to
   40 shingles are compared in full and always share one). Classes without a shared key are done.
2. *Row bound.* A class can only link if at least three quarters of its shingles occur in
   another class that is left; the others are discarded, twice. This removes documents that merely
   share passages, so no frequent passage makes a frequent key.
3. *Families* are the classes connected by shared keys. A family is cut into blocks
   of bounded size; each pair of blocks is one group of work, which multiplies the
   incidence matrix with its transpose, columns chunk by chunk, into overlap counts, and drops pairs below the
   size-derived bound. A group returns a spanning forest of its links and each class's number of links, never all pairs.
4. Components of the links give the result.

Nothing that grows with the input is collected or broadcast, apart from a bit
table of fixed size that keeps classes without a shared key from being shuffled; exact
joins follow it.

Defined cases: null and empty texts, and texts without words, have no shingles and link with nothing
(their component is their own id); null ids never name a component unless all of its ids are null; rows that repeat an id
are documents of their own; an empty table gives no rows; other columns are not read
(:func:`one_of_each` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audix.llm import textvec
from audix.llm.bits import bit_table, is_set, with_bit
from audix.llm.common import join_counted, quoted, releasing, staged
from audix.llm.components import components

SHINGLE = 5
#: Link at overlap / union >= NUMERATOR / DENOMINATOR.
NUMERATOR, DENOMINATOR = 75, 100
LOWEST = 40
#: Bits of the table of shared shingles (8 MB).
SHARED_BITS = 1 << 26
#: Classes and shingles of a block.
BLOCK_CLASSES, BLOCK_SHINGLES = 256, 1 << 19
#: Columns of the incidence matrix multiplied at a time.
COLUMNS = 4096


def shingle_sets(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of texts, bounds, hashes) block by block: the sorted distinct shingle hashes of each text."""
    for w in textvec.blocks(texts, textvec.NOT_SPACE, fold=True):
        bounds = w.bounds
        lengths = np.diff(bounds)
        grams = textvec.gram_hashes(w.hashes, SHINGLE)
        doc = w.doc[:len(grams)]
        inside = np.arange(len(grams)) + SHINGLE <= bounds[1:][doc]
        doc, grams = doc[inside], grams[inside]
        short = np.flatnonzero((lengths > 0) & (lengths < SHINGLE))
        if len(short):
            own = [textvec.gram_hashes(w.hashes[bounds[d]:bounds[d + 1]], int(lengths[d])) for d in short]
            doc, grams = np.concatenate([doc, short]), np.concatenate([grams, *own])
        order = np.lexsort((grams, doc))
        doc, grams = doc[order], grams[order]
        first = np.ones(len(doc), bool)
        first[1:] = (doc[1:] != doc[:-1]) | (grams[1:] != grams[:-1])
        doc, grams = doc[first], grams[first]
        yield w.count, np.searchsorted(doc, np.arange(w.count + 1)), grams


def _sums(bounds: np.ndarray, values: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _lists(bounds: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.view(np.int64)))


def _class(bounds: np.ndarray, grams: np.ndarray) -> list[np.ndarray]:
    """The class of each set: two 64-bit sums over its hashes, and its size."""
    return [_sums(bounds, grams).view(np.int64), _sums(bounds, textvec.mix(grams)).view(np.int64), np.diff(bounds)]


@releasing
def _describe(batches):
    for batch in textvec.small_batches(batches):
        done = 0
        for count, bounds, grams in shingle_sets(textvec.raw_texts(batch.column(3))):
            n = np.diff(bounds)
            low = np.arange(len(grams)) - np.repeat(bounds[:-1], n)
            doc = np.repeat(np.arange(count), n)
            pair = (low[:-1] < LOWEST - 1) & (doc[1:] == doc[:-1]) & (n[doc[:-1]] > 2)
            keys = textvec.mix(grams[:-1] * np.uint64(0x9E3779B97F4A7C15) + grams[1:])[pair]
            key_bounds = np.searchsorted(doc[:-1][pair], np.arange(count + 1))
            yield pa.RecordBatch.from_arrays(
                [*(c.slice(done, count) for c in batch.columns[:3]),
                 *(pa.array(c) for c in _class(bounds, grams)), _lists(key_bounds, keys)],
                ["k1", "k2", "doc_id", "c1", "c2", "n", "keys"])
            done += count


def _sets_of(rows: DataFrame, wanted: np.ndarray) -> DataFrame:
    """c1, c2, n and shingles of the rows whose class has its bit set."""
    table = rows.sparkSession.sparkContext.broadcast(wanted)

    @releasing
    def run(batches):
        bits = table.value
        for batch in textvec.small_batches(batches):
            for _, bounds, grams in shingle_sets(textvec.raw_texts(batch.column(0))):
                c1, c2, n = _class(bounds, grams)
                keep = pa.array(is_set(bits, c1) & (n > 2))
                out = pa.RecordBatch.from_arrays([pa.array(c1), pa.array(c2), pa.array(n), _lists(bounds, grams)],
                                                 ["c1", "c2", "n", "shingles"])
                yield out.filter(keep)

    return rows.select("_text").mapInArrow(run, "c1 bigint, c2 bigint, n bigint, shingles array<bigint>")


def _bounded(sets: DataFrame) -> DataFrame:
    """``sets`` without the classes too few of whose shingles occur in another class.

    Shared shingles are told by a bit table of fixed size: a full table keeps more classes, and never loses one.
    """
    cells = sets.select("cid", F.explode("shingles").alias("h"))
    shared = cells.groupBy("h").agg(F.min("cid").alias("lo"), F.max("cid").alias("hi")).where("lo < hi").select("h")
    table = sets.sparkSession.sparkContext.broadcast(bit_table(shared, SHARED_BITS))
    at = sets.columns.index("shingles")

    @releasing
    def run(batches):
        for batch in batches:
            lists = batch.column(at)
            bounds = lists.offsets.to_numpy()
            hits = np.concatenate([[0], np.cumsum(is_set(table.value, lists.flatten().to_numpy(zero_copy_only=False)))])
            bounds = bounds - bounds[0]
            common = hits[bounds[1:]] - hits[bounds[:-1]]
            yield batch.filter(pa.array(common * DENOMINATOR >= np.diff(bounds) * NUMERATOR))

    return sets.mapInArrow(run, sets.schema)


def _multiply(sets: list[np.ndarray]) -> np.ndarray:
    """Overlap counts of every two sets: the incidence matrix times its transpose, by blocks of columns."""
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    rows, column = rows[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.float64)
    width = int(shared.sum())
    cuts = np.searchsorted(column, np.arange(0, width + COLUMNS, COLUMNS))
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        x = np.zeros((len(sets), min(COLUMNS, width - k * COLUMNS)), np.float32)
        x[rows[a:b], column[a:b] - k * COLUMNS] = 1
        out += x @ x.T
    return out


def _links(cids: np.ndarray, block: np.ndarray, pair: tuple[int, int], sets: list[np.ndarray]):
    """(cid, least linked cid by way of links, number of links) of the classes of a pair of blocks."""
    n = np.array([len(s) for s in sets])
    overlap = _multiply(sets)
    link = overlap * DENOMINATOR >= (n[:, None] + n[None, :] - overlap) * NUMERATOR
    np.fill_diagonal(link, False)
    if pair[0] != pair[1]:
        link &= block[:, None] != block[None, :]
    label = cids.copy()
    while True:
        near = np.where(link, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        new = np.minimum(label, near)
        if (new == label).all():
            return label, link.sum(axis=1)
        label = new


@releasing
def _products(batches):
    """Rows sorted by (family, i, j): the links of each group."""
    held, key = [], None

    def close():
        cids = np.array([r[0] for r in held])
        label, links = _links(cids, np.array([r[1] for r in held]), key[1:], [r[2] for r in held])
        return pa.RecordBatch.from_arrays([pa.array(cids), pa.array(label), pa.array(links)], ["a", "b", "links"])

    for batch in batches:
        family, i, j, block, cid = (batch.column(c).to_pylist() for c in range(5))
        shingles = batch.column(5)
        bounds, values = shingles.offsets.to_numpy(), shingles.values.to_numpy()
        for r in range(batch.num_rows):
            if (family[r], i[r], j[r]) != key:
                if len(held) > 1:
                    yield close()
                held, key = [], (family[r], i[r], j[r])
            held.append((cid[r], block[r], values[bounds[r]:bounds[r + 1]].copy()))
    if len(held) > 1:
        yield close()


def row_key(id_col: str, text_col: str) -> list:
    """Two hashes of a row's id and text: the same in every scan of the table,
    unlike a row number, which depends on how files are dealt to the executors at hand."""
    return [F.xxhash64(F.col(id_col), F.col(text_col)).alias("k1"),
            F.xxhash64(F.lit(7), F.col(text_col), F.col(id_col)).alias("k2")]


def link_classes(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Rows (k1, k2, doc_id, c1, c2, n) and classes (c1, c2, n, component, component_id, links).

    ``k1`` and ``k2`` hash a row's id and text (:func:`row_key`); ``component`` is a
    number of the group of linked classes.
    """
    spark = docs.sparkSession
    rows = docs.select(*row_key(id_col, text_col), F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    described = staged(spark, rows.mapInArrow(
        _describe, f"k1 bigint, k2 bigint, doc_id {kind}, c1 bigint, c2 bigint, n bigint, keys array<bigint>"), "shingles")

    classes = (described.where("n > 0").groupBy("c1", "c2", "n")
               .agg(F.min("doc_id").alias("least"), F.first("keys").alias("keys"))
               .withColumn("cid", F.monotonically_increasing_id()))
    classes = staged(spark, classes, "classes")
    postings = classes.select("cid", F.explode("keys").alias("key"))
    pivots = postings.groupBy("key").agg(F.min("cid").alias("lo"), F.max("cid").alias("hi")).where("lo < hi")
    postings = staged(spark, join_counted(postings, pivots.select("key"), "key"), "shared-keys")

    blocked = staged(spark, postings.select("cid").distinct().join(classes.select("cid", "c1", "c2", "n"), "cid"),
                     "blocked")
    found = _sets_of(rows, bit_table(blocked.select("c1")))
    sets = staged(spark, found.groupBy("c1", "c2", "n").agg(F.first("shingles").alias("shingles"))
                  .join(blocked, ["c1", "c2", "n"]).select("cid", "n", "shingles"), "sets")
    for _ in range(2):
        sets = staged(spark, _bounded(sets), "bounded")

    live = postings.join(sets.select("cid"), "cid")
    star = join_counted(live, live.groupBy("key").agg(F.min("cid").alias("pivot")), "key")
    families = components(star.where("cid != pivot").select(F.col("cid").alias("a"), F.col("pivot").alias("b")))
    members = sets.join(families.withColumnRenamed("node", "cid"), "cid")
    blocks = members.groupBy("component").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK_CLASSES), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    placed = (join_counted(members, blocks, "component")
              .withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
              .select(F.col("component").alias("family"), F.least("block", "other").alias("i"),
                      F.greatest("block", "other").alias("j"), "block", "cid", "shingles"))
    work = placed.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j")
    links = staged(spark, work.mapInArrow(_products, "a bigint, b bigint, links bigint"), "links")

    groups = components(links.select("a", "b"))
    counted = links.groupBy("a").agg(F.sum("links").alias("links"))
    classes = (classes.drop("keys").join(groups.withColumnRenamed("node", "cid"), "cid", "left")
               .join(counted.withColumnRenamed("a", "cid"), "cid", "left")
               .withColumn("component", F.coalesce("component", "cid")))
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = (join_counted(classes, least, "component")
               .select("c1", "c2", "n", "component", "component_id", F.coalesce("links", F.lit(0)).alias("links")))
    return described.drop("keys"), staged(spark, classes, "linked")


def jaccard_join(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id (least id reachable by links) and n_links
    (other shingle sets linked to) of every row."""
    rows, classes = link_classes(docs, text_col, id_col)
    return (rows.join(classes, ["c1", "c2", "n"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("component_id", "doc_id").alias("component_id"),
                    F.coalesce("links", F.lit(0)).alias("n_links")))


def one_of_each(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row of each group of linked documents, one with the least id; all columns.

    Of rows that repeat id and text any one is kept. Rows without shingles all stay.
    """
    spark = docs.sparkSession
    rows, classes = link_classes(docs, text_col, id_col)
    grouped = (rows.join(classes, ["c1", "c2", "n"]).groupBy("k1", "k2", "component")
               .agg(F.first("doc_id").alias("doc_id"), F.count("*").alias("copies")))
    grouped = staged(spark, grouped, "grouped")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2")
    first = grouped.groupBy("component").agg(F.min(order).alias("o")).select("component", "o.k1", "o.k2")
    # What happens to a key: it goes, or its repeated rows are cut to one. Keys not listed stay as they are.
    listed = staged(spark, grouped.join(first.withColumn("keep", F.lit(True)), ["component", "k1", "k2"], "left")
                    .select("k1", "k2", F.coalesce("keep", F.lit(False)).alias("keep"), "copies")
                    .where("NOT keep OR copies > 1").drop("copies"), "listed")
    keyed = docs.select(*row_key(id_col, text_col), F.struct(*map(quoted, docs.columns)).alias("_doc"))
    hashed = keyed.withColumn("_hash", F.col("k1"))
    table = bit_table(listed.select("k1"))
    suspects = with_bit(hashed, table, True).join(listed, ["k1", "k2"], "left")
    once = (suspects.where("keep").groupBy("k1", "k2").agg(F.first("_doc").alias("_doc")))
    return (with_bit(hashed, table, False).select("_doc.*")
            .unionByName(suspects.where("keep IS NULL").select("_doc.*"))
            .unionByName(once.select("_doc.*")))
