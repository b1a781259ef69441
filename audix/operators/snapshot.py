"""Transaction snapshot and its profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audix import contracts as C


def snapshot_txn(txn: DataFrame, start_week: int | None = None, end_week: int | None = None,
                 channel: str | Sequence[str] | None = None, segments: DataFrame | None = None,
                 fill: str = C.SEGMENT_FILL_LABEL) -> DataFrame:
    """Lines of card holders inside a week range, optionally one channel.

    Filters are plain column predicates so they reach the Parquet scan.
    ``segments`` (household -> segment) is attached with a left join and the
    fill label when given; it is cheaper to attach segments to household-level
    results later (see ``attach_segment``) than to every line, so the chains
    of this library do that.
    """
    df = txn
    if start_week is not None or end_week is not None:
        lo = start_week if start_week is not None else -(2 ** 31)
        hi = end_week if end_week is not None else 2 ** 31 - 1
        df = df.where(F.col(C.WEEK).between(int(lo), int(hi)))
    df = df.where(F.col(C.CUSTOMER).isNotNull())
    if channel is not None:
        chans = [channel] if isinstance(channel, str) else list(channel)
        df = df.where(F.col(C.CHANNEL).isin(chans))
    if segments is not None:
        df = (df.join(segments.select(C.HOUSEHOLD, C.SEGMENT), C.HOUSEHOLD, "left")
              .fillna(fill, subset=[C.SEGMENT]))
    return df


def snapshot_profile(snap: DataFrame, segments: DataFrame, fill: str = C.SEGMENT_FILL_LABEL) -> DataFrame:
    """Range and size of a snapshot per segment.

    Lines are first reduced to one row per household (partial aggregation
    before the shuffle), and only then joined to the household-level segment
    table; the segment never travels with the lines.
    """
    per_hh = snap.groupBy(C.HOUSEHOLD).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.min(C.WEEK).alias("min_week"), F.max(C.WEEK).alias("max_week"),
        F.min(C.DATE).alias("min_date"), F.max(C.DATE).alias("max_date"),
        F.sum(C.SPEND).alias("spend"))
    with_seg = (per_hh.join(segments.select(C.HOUSEHOLD, C.SEGMENT), C.HOUSEHOLD, "left")
                .fillna(fill, subset=[C.SEGMENT]))
    return with_seg.groupBy(C.SEGMENT).agg(
        F.sum("n_lines").alias("n_lines"), F.count(F.lit(1)).alias("n_households"),
        F.min("min_week").alias("min_week"), F.max("max_week").alias("max_week"),
        F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"),
        F.sum("spend").alias("spend"))


def snapshot_range(snap: DataFrame) -> DataFrame:
    """Global min / max of week and date (a quick range check)."""
    return snap.agg(F.min(C.WEEK).alias("min_week"), F.max(C.WEEK).alias("max_week"),
                    F.min(C.DATE).alias("min_date"), F.max(C.DATE).alias("max_date"))
