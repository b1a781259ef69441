"""Household sales ranks inside product groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audix import contracts as C
from audix.operators.ranking import rank_within
from audix.sources.readers import union_all
from audix.sources.sinks import stage_table


def _spend_lines(txn: DataFrame, groups: DataFrame, group_col: str, amount: str,
                 extra: Sequence[str] = ()) -> DataFrame:
    # The group table is small (products x groups): AQE broadcasts it when its
    # measured size allows, otherwise the join stays a shuffle join.
    return (txn.select(C.HOUSEHOLD, C.PRODUCT, amount, *extra)
            .join(groups.select(C.PRODUCT, group_col), C.PRODUCT))


def group_spend(txn: DataFrame, groups: DataFrame, group_col: str = C.GROUP, amount: str = C.SPEND,
                sales_col: str = C.SALES) -> DataFrame:
    """Transaction lines reduced to one row per (household, group): sales and
    line count. A product listed in two groups counts in both, as a join
    fan-out does. This is the one pass over the lines that the ranking and
    waterfall steps need; everything after it works on households x groups.
    """
    return (_spend_lines(txn, groups, group_col, amount)
            .groupBy(C.HOUSEHOLD, group_col)
            .agg(F.sum(amount).alias(sales_col), F.count(F.lit(1)).alias("n_lines")))


def rank_spend(spend: DataFrame, group_col: str = C.GROUP, label: str | None = None,
               names: Sequence[str] | None = None, rank_col: str = C.RANK,
               sales_col: str = C.SALES) -> DataFrame:
    """Rank households inside each group of a spend table (highest sales
    first, ties by household id). ``names`` keeps some groups; ``label``
    pools them into one group (sales summed per household)."""
    src = spend if names is None else spend.where(F.col(group_col).isin(list(names)))
    if label is not None:
        src = (src.groupBy(C.HOUSEHOLD).agg(F.sum(sales_col).alias(sales_col))
               .withColumn(group_col, F.lit(label)))
    src = src.select(C.HOUSEHOLD, group_col, sales_col)
    return rank_within(src, [group_col], [F.col(sales_col).desc_nulls_last(), F.col(C.HOUSEHOLD).asc()], rank_col)


def sales_rank(txn: DataFrame, groups: DataFrame, group_col: str = C.GROUP, label: str | None = None,
               amount: str = C.SPEND, rank_col: str = C.RANK, sales_col: str = C.SALES) -> DataFrame:
    """Sales per (household, group) and the household's rank in the group
    (highest sales first, ties by household id).

    With ``label`` all given groups are pooled under that one name; a product
    listed in two pooled groups then counts twice, as a join fan-out does.
    Sums are exact when ``amount`` is an integer or decimal column.
    """
    # Staged once: the rank's range sample and the rank itself then read the
    # household x group table instead of scanning the lines twice.
    spend = stage_table(group_spend(txn, groups, group_col, amount, sales_col), "group-spend")
    return rank_spend(spend, group_col, label, None, rank_col, sales_col)


def visit_spend(txn: DataFrame, groups: DataFrame, group_col: str = C.GROUP, amount: str = C.SPEND,
                sales_col: str = C.SALES, extra: Sequence[str] = ()) -> DataFrame:
    """Transaction lines reduced to one row per (group, household, visit) and the visit's ``extra`` columns."""
    lines = _spend_lines(txn, groups, group_col, amount, extra=[C.TRANSACTION, *extra])
    return lines.groupBy(group_col, C.HOUSEHOLD, C.TRANSACTION, *extra).agg(F.sum(amount).alias(sales_col))


def frequency_rank_of(visits: DataFrame, drop: Sequence[str] = (), group_col: str = C.GROUP, rank_col: str = C.RANK,
                      sales_col: str = C.SALES) -> DataFrame:
    """:func:`frequency_rank` from a table of :func:`visit_spend`."""
    per_hh = visits.groupBy(group_col, C.HOUSEHOLD).agg(
        F.count(F.lit(1)).alias("visits"), F.sum(sales_col).alias(sales_col))
    times = F.when(F.col("visits") == 1, F.lit(C.ONE_TIME_LABEL)).otherwise(F.lit(C.MULTI_TIME_LABEL))
    named = (per_hh.withColumn("times_buy", times)
             .withColumn("_new", F.concat_ws("_", F.col(group_col), F.col("times_buy"))))
    if drop:
        named = named.where(~F.col("_new").isin(list(drop)))
    named = stage_table(named, "frequency-spend")
    ranked = rank_within(named, [group_col, "times_buy"],
                         [F.col(sales_col).desc_nulls_last(), F.col(C.HOUSEHOLD).asc()], rank_col)
    return ranked.select(C.HOUSEHOLD, sales_col, F.col("_new").alias(group_col), rank_col)


def frequency_rank(txn: DataFrame, groups: DataFrame, drop: Sequence[str] = (), group_col: str = C.GROUP,
                   amount: str = C.SPEND, rank_col: str = C.RANK, sales_col: str = C.SALES) -> DataFrame:
    """Split each group by purchase frequency (one distinct visit ->
    ``<group>_onetime``, more -> ``<group>_multitimes``) and rank inside the
    split; sub-groups named in ``drop`` are left out.

    Two partial aggregations instead of count(distinct): no Expand, and each
    level is combined map-side before it is shuffled.
    """
    return frequency_rank_of(visit_spend(txn, groups, group_col, amount, sales_col), drop, group_col, rank_col, sales_col)


def combine_ranks(*parts: DataFrame) -> DataFrame:
    """Union of rank tables by column name."""
    return union_all(parts)


def group_reach(txn: DataFrame, groups: DataFrame, group_col: str = C.GROUP) -> DataFrame:
    """Distinct buying households per group."""
    return (txn.select(C.HOUSEHOLD, C.PRODUCT).join(groups.select(C.PRODUCT, group_col), C.PRODUCT)
            .groupBy(group_col).agg(F.countDistinct(C.HOUSEHOLD).alias("n_households")))


def rank_drilldown(ranks: DataFrame, group: str, rank_value: int, group_col: str = C.GROUP,
                   rank_col: str = C.RANK) -> DataFrame:
    """Every rank row of the households that hold ``rank_value`` in ``group``."""
    at = ranks.where((F.col(group_col) == group) & (F.col(rank_col) == rank_value)).select(C.HOUSEHOLD)
    return ranks.join(at, C.HOUSEHOLD, "left_semi")
