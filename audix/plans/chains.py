"""The three chains of the method, wired to the fixture specs.

Each function returns the intermediate DataFrames of its chain so a query
can pick the one it reports. Rank steps stage their input in the shared
checkpoint folder (see ``operators.ranking``), so building a chain runs the
jobs up to its ranks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from audix import contracts as C
from audix.operators import allocate as A
from audix.operators import cycle as Y
from audix.operators import groups as G
from audix.operators import pool as P
from audix.operators import rank as R
from audix.operators.segment import segments_at
from audix.operators.snapshot import snapshot_txn
from audix.plans import specs as S
from audix.plans.workflows import WaterfallRun
from audix.sources import fixtures
from audix.sources.sinks import stage_table


def full_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_txn(fixtures.transactions(spark, sf_dir))


def week_snapshot(spark: SparkSession, sf_dir: str, start_week: int, end_week: int, channel=None) -> DataFrame:
    """Snapshot of a week range; its first and last day, from the calendar,
    bound the physical date column, so the scan reads that range only."""
    weeks = fixtures.date_dim(spark, sf_dir).where(F.col(C.WEEK).between(start_week, end_week))
    lo, hi = weeks.agg(F.min(C.DATE), F.max(C.DATE)).first()
    dates = None if lo is None else (lo, hi)
    return snapshot_txn(fixtures.transactions(spark, sf_dir, dates), start_week, end_week, channel)


def segments_at_week(spark: SparkSession, sf_dir: str, week: int | None = None) -> DataFrame:
    """Segments as of the last day of ``week`` (default: the last week of data), with their period."""
    return segments_at(fixtures.segment_history(spark, sf_dir), fixtures.date_dim(spark, sf_dir), week)


# ---- chain A: rank map pool and sequential allocation -------------------

def pool_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.sales_rank(full_snapshot(spark, sf_dir), S.pool_groups(spark, sf_dir))


def pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.allocation_pool(pool_ranks(spark, sf_dir))


def rank_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rankings of different groups, from one pass over the lines."""
    visits = stage_table(R.visit_spend(full_snapshot(spark, sf_dir), S.pool_groups(spark, sf_dir), extra=[C.CHANNEL]), "visit-spend")
    part1 = R.frequency_rank_of(visits.where(F.col(C.GROUP).isin(S.FREQ_GROUPS)), drop=S.FREQ_DROP)
    delivery = (F.col(C.GROUP) == S.DELIVERY_GROUP) & (F.col(C.CHANNEL) == C.CHANNEL_DELIVERY)
    rest = visits.where(delivery | (F.col(C.GROUP) == S.PLAIN_GROUP))
    spend = stage_table(rest.groupBy(C.HOUSEHOLD, C.GROUP).agg(F.sum(C.SALES).alias(C.SALES)), "group-spend")
    return R.combine_ranks(part1, R.rank_spend(spend))


def allocation(spark: SparkSession, sf_dir: str, sizes=(1, 2, 3, 4)) -> tuple[DataFrame, A.Allocation]:
    pl = pool(spark, sf_dir)
    return pl, A.allocate(pl, S.alloc_spec(spark, sf_dir), sizes=sizes)


# ---- chain B: waterfall over one campaign -------------------------------

def waterfall(spark: SparkSession, sf_dir: str) -> WaterfallRun:
    return WaterfallRun(fixtures.transactions(spark, sf_dir), S.waterfall_groups(spark, sf_dir),
                        S.waterfall_spec(spark, sf_dir))


# ---- chain C: purchase cycles ------------------------------------------

def class_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.expand_to_class(fixtures.prod_dim(spark, sf_dir), S.cycle_targets(spark, sf_dir))


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Y.purchase_gaps(full_snapshot(spark, sf_dir), class_products(spark, sf_dir))
