"""Distinct households per group over any range of weeks, from one stored table.

A distinct count does not add up over weeks. Here a (group, week) keeps the set of its households as
bitmaps: ids are cut into buckets of 32,768 neighbouring ids, one bitmap of 4 KB for each bucket in use. The
reach of a week range is the union of its bitmaps, bit by bit, and their count: exact, mergeable, and without the
lines. Ids must be non-negative numbers and should be dense (row numbers of a household dimension);
scattered ids use a bitmap for every few households.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audix import contracts as C


def reach_bitmaps(txn: DataFrame, groups: DataFrame, group_col: str = C.GROUP, by: str = C.WEEK) -> DataFrame:
    """(group, week, bucket, bitmap): the households of each group and week. Null ids are nobody."""
    lines = (txn.select(C.HOUSEHOLD, C.PRODUCT, by).where(F.col(C.HOUSEHOLD).isNotNull())
             .join(groups.select(C.PRODUCT, group_col), C.PRODUCT))
    return (lines.groupBy(group_col, by, F.bitmap_bucket_number(F.col(C.HOUSEHOLD)).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(C.HOUSEHOLD))).alias("bitmap")))


def merge_bitmaps(*stores: DataFrame, group_col: str = C.GROUP, by: str = C.WEEK) -> DataFrame:
    """One store of several (a week may be in more than one, as when lines arrive late)."""
    out = stores[0]
    for s in stores[1:]:
        out = out.unionByName(s)
    return out.groupBy(group_col, by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def reach(store: DataFrame, start: int | None = None, end: int | None = None, group_col: str = C.GROUP,
          by: str = C.WEEK) -> DataFrame:
    """Distinct households per group with a line from ``start`` to ``end`` (either may be open)."""
    if start is not None:
        store = store.where(F.col(by) >= start)
    if end is not None:
        store = store.where(F.col(by) <= end)
    merged = store.groupBy(group_col, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(group_col).agg(F.sum(F.bitmap_count("bitmap")).alias("n_households"))
