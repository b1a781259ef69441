"""Sharding by longest-processing-time scheduling (operator 10).

Rows with equal texts form a group that stays on one shard. Groups go, largest
first, to the shard with the least bytes so far, kept in a heap. Groups of one size are
interchangeable, so the heap schedules the histogram of group sizes: for each size, largest first,
how many groups of that size each shard takes. What reaches the driver is a row per distinct size, of which
there are fewer than twice the square root of all bytes. Groups are then numbered inside their size, and the numbers
tell the shard. Numbers (of groups in a size, of rows in a shard) come from counts of pieces of bounded
size, so no task holds all groups of a frequent size.

Defined cases: a null text counts as an empty one (size 1, crc of no bytes,
same group as ``""``); null and repeated ids keep their rows, each with its own
slot; an empty table gives no rows; other columns are not read by :func:`shard_rows` and kept by
:func:`write_shards`, also when they are named ``shard`` or ``_file`` (the folders are named by ``shard_col``).
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from audix.llm.common import join_counted, quoted, staged

#: Rows (or groups) that are numbered in one piece.
PIECE_ROWS = 5000


def lpt(items: list[tuple[int, int]], n_shards: int) -> list[tuple[int, list[int]]]:
    """Longest-processing-time schedule of (bytes, number of items of that size): per size, largest
    first, the items that each shard takes. Ties of load go by shard number."""
    heap = [(0, s) for s in range(n_shards)]
    out = []
    for size, count in sorted(items, reverse=True):
        taken = [0] * n_shards
        # All shards up to the level that the last item reaches take items at once; the heap deals the few that are left.
        loads = dict((s, load) for load, s in heap)
        lo, hi = min(loads.values()), max(loads.values()) + size * (count + 1)
        while hi - lo > 1:  # the highest level under which not more than ``count`` items fit
            level = (lo + hi) // 2
            fit = sum(max(0, -(-(level - load) // size)) for load in loads.values())
            lo, hi = (level, hi) if fit <= count else (lo, level)
        for s, load in loads.items():
            taken[s] = max(0, -(-(lo - load) // size))
        heap = [(load + size * taken[s], s) for s, load in loads.items()]
        heapq.heapify(heap)
        for _ in range(count - sum(taken)):
            load, s = heapq.heappop(heap)
            taken[s] += 1
            heapq.heappush(heap, (load + size, s))
        out.append((size, taken))
    return out


def _text(text_col: str):
    return F.coalesce(F.col(text_col), F.lit(""))


def _numbered(rows: DataFrame, by: str, order: str, name: str, piece_rows: int) -> DataFrame:
    """Number the rows of each ``by`` from 0 without gaps, piece by piece of about ``piece_rows`` rows.

    ``order`` is a column that tells all rows apart; ``rows`` must be a stored table.
    """
    held = rows.groupBy(by).agg(F.ceil(F.count("*") / piece_rows).alias("_pieces"))
    placed = rows.withColumn("_key", F.xxhash64(by)).join(held.withColumn("_key", F.xxhash64(by)), [by, "_key"]).drop("_key")
    placed = placed.withColumn("_piece", F.pmod(F.xxhash64(order), F.col("_pieces")))
    before = Window.partitionBy(by).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    start = placed.groupBy(by, "_piece").count().select(by, "_piece", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy(by, "_piece").orderBy(order))
    return (placed.withColumn("_inside", inside).join(start, [by, "_piece"])
            .withColumn(name, F.col("_start") + F.col("_inside") - 1).drop("_piece", "_pieces", "_inside", "_start"))


def schedule(spark: SparkSession, rows: DataFrame, n_shards: int, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Relation (_group, shard) of the groups of ``rows`` (columns _group and _size)."""
    groups = staged(spark, rows.groupBy("_group").agg(F.sum("_size").alias("_bytes")), "shard-groups")
    sizes = groups.groupBy("_bytes").count().toArrow()
    plan = lpt(list(zip(sizes.column(0).to_pylist(), sizes.column(1).to_pylist())), n_shards)
    ends = [(size, [sum(taken[:s + 1]) for s in range(n_shards)]) for size, taken in plan]
    table = pa.table({"_bytes": pa.array([x for x, _ in ends], pa.int64()), "_ends": pa.array([e for _, e in ends], pa.list_(pa.int64()))})
    known = spark.createDataFrame(table).withColumn("_key", F.xxhash64("_bytes"))
    placed = _numbered(groups, "_bytes", "_group", "_number", piece_rows).withColumn("_key", F.xxhash64("_bytes"))
    shard = F.size(F.filter("_ends", lambda e: e <= F.col("_number"))).alias("shard")
    return placed.join(known, ["_bytes", "_key"]).select("_group", shard)


def shard_rows(docs: DataFrame, n_shards: int = 16, text_col: str = "text", id_col: str = "doc_id",
               piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Shard and slot of every row: doc_id, size, text_crc32, shard, slot."""
    spark = docs.sparkSession
    text = _text(text_col)
    light = staged(spark, docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("_size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("_group"),
        F.monotonically_increasing_id().alias("_row")), "shard-rows")
    where = schedule(spark, light, n_shards, piece_rows)
    rows = staged(spark, join_counted(light, where, "_group").drop("_group"), "sharded")
    return (_numbered(rows, "shard", "_row", "slot", piece_rows)
            .select("doc_id", F.col("_size").alias("size"), "text_crc32", "shard", "slot"))


def write_shards(docs: DataFrame, path: str, n_shards: int = 16, text_col: str = "text",
                 files_per_shard: int = 8, shard_col: str = "shard") -> None:
    """Write ``docs`` with all its columns as Parquet folders ``<shard_col>=0 .. n-1``.

    Equal texts land in one shard folder; within a shard, rows are spread over
    files by a row hash, so a hot group is not written by one task. A table that has a column
    ``shard_col`` already needs another name for the folders.
    """
    if shard_col in docs.columns:
        raise ValueError(f"the table has a column {shard_col}; give the folders another name by shard_col")
    spark = docs.sparkSession
    text = _text(text_col)
    keyed = docs.select(F.struct(*map(quoted, docs.columns)).alias("_doc"), F.xxhash64(text).alias("_group"),
                        (F.octet_length(text) + 1).cast("long").alias("_size"))
    where = schedule(spark, keyed.select("_group", "_size"), n_shards)
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(files_per_shard))
    placed = join_counted(keyed.drop("_size"), where, "_group").repartition(n_shards * files_per_shard, "shard", spread)
    (placed.select(*[F.col("_doc")[c].alias(c) for c in docs.columns], F.col("shard").alias(shard_col))
     .write.partitionBy(shard_col).mode("overwrite").parquet(path))
