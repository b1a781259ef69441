"""The allocation pool: per household, the groups it bought and its rank in each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audix import contracts as C
from audix.functions import sorted_join


def allocation_pool(ranks: DataFrame, group_col: str = C.GROUP, rank_col: str = C.RANK) -> DataFrame:
    """(household_id, gr_nm_list sorted, n_gr, gr_rank_map) in one aggregate.

    A household with two ranks for one group keeps the best one, so building
    the map can never meet a duplicate key. Both aggregations run on one
    shuffle by household (a hash partitioning on the household satisfies the
    (household, group) grouping too); a household has at most one row per
    group, so no task gets more than #groups rows of one household.
    """
    best = (ranks.select(C.HOUSEHOLD, group_col, rank_col).repartition(C.HOUSEHOLD)
            .groupBy(C.HOUSEHOLD, group_col).agg(F.min(rank_col).alias(rank_col)))
    pool = best.groupBy(C.HOUSEHOLD).agg(
        F.sort_array(F.collect_list(group_col)).alias(C.GROUP_LIST),
        F.map_from_entries(F.collect_list(F.struct(F.col(group_col), F.col(rank_col)))).alias(C.RANK_MAP))
    return pool.withColumn(C.GROUP_COUNT, F.size(C.GROUP_LIST))


def pool_long(pool: DataFrame) -> DataFrame:
    """One row per (household, group): household_id, n_gr, gr_nm, rank."""
    return pool.select(C.HOUSEHOLD, C.GROUP_COUNT,
                       F.explode(C.RANK_MAP).alias(C.GROUP, "rank"))


def pool_check(pool: DataFrame) -> DataFrame:
    """Households per list size, and how many have a list size different
    from their map size (must be 0)."""
    bad = F.when(F.col(C.GROUP_COUNT) != F.size(C.RANK_MAP), 1).otherwise(0)
    return pool.groupBy(C.GROUP_COUNT).agg(F.count(F.lit(1)).alias("n_households"),
                                           F.sum(bad).alias("n_mismatch"))


def combination_report(pool: DataFrame) -> DataFrame:
    """Households per group combination."""
    return (pool.groupBy(C.GROUP_COUNT, sorted_join(F.col(C.GROUP_LIST)).alias(C.GROUP_LIST))
            .agg(F.count(F.lit(1)).alias("n_households")))


def household_group_sets(spend: DataFrame, group_col: str = C.GROUP, set_col: str = "gr_set") -> DataFrame:
    """The sorted set of groups each household bought (from a household x
    group spend table), and its size. A household has at most one row per
    group, so the collected set is bounded by the number of groups."""
    return (spend.groupBy(C.HOUSEHOLD).agg(F.sort_array(F.collect_set(group_col)).alias(set_col))
            .withColumn("n_" + set_col, F.size(set_col)))


def exclusive_shoppers(spend: DataFrame, group_col: str = C.GROUP) -> DataFrame:
    """Households that bought exactly one of the groups in ``spend``: (household, group).

    ``spend`` has one row per (household, group), as ``group_spend`` makes
    it, so a row count is the number of groups (one plain aggregate, no
    distinct-aggregate expansion)."""
    return (spend.groupBy(C.HOUSEHOLD)
            .agg(F.count(F.lit(1)).alias("_k"), F.min(group_col).alias(group_col))
            .where(F.col("_k") == 1).select(C.HOUSEHOLD, group_col))
