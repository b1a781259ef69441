"""Waterfall steps: exclusion of earlier audiences, co-purchase, department
minus products, quota picks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audix import contracts as C
from audix.operators.ranking import pick_by_rank
from audix.sources.readers import spec_frame, union_all


def allocated_households(*allocations: DataFrame) -> DataFrame:
    return union_all([a.select(C.HOUSEHOLD) for a in allocations]).distinct()


def exclude_allocated(df: DataFrame, *allocations: DataFrame) -> DataFrame:
    """Rows of households not in any earlier allocation: one anti join
    against the union of earlier picks (bounded by the quotas)."""
    if not allocations:
        return df
    return df.join(allocated_households(*allocations), C.HOUSEHOLD, "left_anti")


def bought_all(spend: DataFrame, names: Sequence[str], label: str | None = None,
               group_col: str = C.GROUP) -> DataFrame:
    """Households with purchases in every one of the named groups (from a
    household x group spend table, one row per household and group, so a row
    count is the number of groups bought)."""
    need = len(set(names))
    hh = (spend.where(F.col(group_col).isin(list(set(names))))
          .groupBy(C.HOUSEHOLD).agg(F.count(F.lit(1)).alias("_k"))
          .where(F.col("_k") == need).select(C.HOUSEHOLD))
    return hh if label is None else hh.withColumn(group_col, F.lit(label))


def exclusion_groups(groups: DataFrame, departments: Sequence[str], excluded: Sequence[str], suffix: str,
                     group_col: str = C.GROUP) -> DataFrame:
    """Product-level difference, on the small group table: for each
    department, its products that are in no excluded group, named
    ``<department><suffix>``. Spend on these groups is spend on the
    department's lines minus the excluded products' lines."""
    exc = groups.where(F.col(group_col).isin(list(excluded))).select(C.PRODUCT).distinct()
    return (groups.where(F.col(group_col).isin(list(departments)))
            .join(exc, C.PRODUCT, "left_anti")
            .select(C.PRODUCT, F.concat(F.col(group_col), F.lit(suffix)).alias(group_col)))


def bought_excluding_lines(spend: DataFrame, departments: Sequence[str], suffix: str,
                           excluded: Sequence[str] | None = None, household_level: bool = False,
                           group_col: str = C.GROUP) -> DataFrame:
    """Households that bought every listed department, counting only lines
    whose product is not in an excluded group (the ``<department><suffix>``
    groups of :func:`exclusion_groups` must be in ``spend``).

    The exclusion is per line: a household that also bought an excluded
    product stays if it bought another product of the department. With
    ``household_level`` (and ``excluded`` given) a household that bought any
    excluded group is dropped as well.
    """
    out = bought_all(spend, [d + suffix for d in departments], group_col=group_col)
    if household_level and excluded:
        bad = spend.where(F.col(group_col).isin(list(excluded))).select(C.HOUSEHOLD).distinct()
        out = out.join(bad, C.HOUSEHOLD, "left_anti")
    return out


def regroup_spend(spend: DataFrame, mapping: Mapping[str, str], group_col: str = C.GROUP,
                  sales_col: str = C.SALES) -> DataFrame:
    """Roll a spend table up into super-groups (sales and lines summed)."""
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return (spend.withColumn(group_col, lookup[F.col(group_col)]).where(F.col(group_col).isNotNull())
            .groupBy(C.HOUSEHOLD, group_col)
            .agg(F.sum(sales_col).alias(sales_col), F.sum("n_lines").alias("n_lines")))


def top_k(candidates: DataFrame, ranks: DataFrame, k: int, rank_col: str = C.RANK) -> DataFrame:
    """The ``k`` candidates with the best rank (ranks of one group)."""
    joined = candidates.select(C.HOUSEHOLD).join(ranks, C.HOUSEHOLD)
    return pick_by_rank(joined, [], k, rank_col, [C.HOUSEHOLD])


def quota_table(spark, quotas: Mapping[str, int], group_col: str = C.GROUP, limit_col: str = "limit") -> DataFrame:
    return spec_frame(spark, [(g, int(v)) for g, v in quotas.items()], f"{group_col} string, {limit_col} long")


def limit_by_quota(df: DataFrame, quotas: Mapping[str, int] | DataFrame, group_col: str = C.GROUP,
                   rank_col: str = C.RANK, limit_col: str = "limit") -> DataFrame:
    """Best ``limit`` rows per group by rank, all groups in one job.

    ``quotas`` is {group: limit} or a (group, limit) table; groups without a
    quota drop out.
    """
    if not isinstance(quotas, DataFrame):
        quotas = quota_table(df.sparkSession, quotas, group_col, limit_col)
    joined = df.join(quotas.select(group_col, limit_col), group_col)
    return pick_by_rank(joined, [group_col], F.col(limit_col), rank_col, [C.HOUSEHOLD]).select(*df.columns)


def rank_up_to_quota(ranks: DataFrame, quotas: Mapping[str, int], group_col: str = C.GROUP,
                     rank_col: str = C.RANK) -> DataFrame:
    """The rows of a complete ranking (ranks 1..n in every group) up to each
    group's quota: a filter, no second numbering."""
    limit = F.create_map(*[F.lit(x) for g, v in quotas.items() for x in (g, int(v))])[F.col(group_col)]
    return ranks.where(F.col(rank_col) <= limit)


def map_sets(sets: DataFrame, mapping: DataFrame, ranks: DataFrame, set_col: str = "gr_set",
             target_col: str = C.GROUP) -> DataFrame:
    """Map each household's exact group set to a target group (a set not in
    the mapping drops out), then attach the household's rank in that group."""
    mapped = sets.select(C.HOUSEHOLD, set_col).join(
        mapping.select(F.sort_array(set_col).alias(set_col), target_col), set_col)
    return mapped.join(ranks, [C.HOUSEHOLD, target_col]).drop(set_col)


def combine_allocations(*allocations: DataFrame, group_col: str = C.GROUP,
                        rank_col: str = C.RANK) -> DataFrame:
    """One table (household_id, group, rank) from allocations with different
    column sets; a missing rank stays null."""
    parts = []
    for a in allocations:
        cols = [F.col(C.HOUSEHOLD), F.col(group_col)]
        cols.append(F.col(rank_col).cast("int") if rank_col in a.columns else F.lit(None).cast("int").alias(rank_col))
        parts.append(a.select(*cols))
    return union_all(parts)


def one_audience_check(alloc: DataFrame) -> DataFrame:
    """Rows and distinct households (equal when every household is in one audience)."""
    return alloc.agg(F.count(F.lit(1)).alias("n_rows"),
                     F.countDistinct(C.HOUSEHOLD).alias("n_households"))


def allocation_profile(alloc: DataFrame, group_col: str = C.GROUP, rank_col: str = C.RANK) -> DataFrame:
    """Best and worst rank picked, and count, per audience."""
    return alloc.groupBy(group_col).agg(F.min(rank_col).alias("min_rank"), F.max(rank_col).alias("max_rank"),
                                        F.count(F.lit(1)).alias("n_households"))


def cut_tail(picks: DataFrame, width: int = 10, group_col: str = C.GROUP, rank_col: str = C.RANK) -> DataFrame:
    """The last ``width`` picks of every audience (worst ranks picked): a
    check of where each quota cut fell."""
    backwards = picks.withColumn("_from_end", -F.col(rank_col)).withColumn("_last_first", -F.col(C.HOUSEHOLD))
    return pick_by_rank(backwards, [group_col], width, "_from_end", ["_last_first"]).select(*picks.columns)
