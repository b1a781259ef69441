"""End-to-end runs over your own tables (the fixture chains in ``chains.py``
wire the same operators to the driver's test tables).

    pool  = rank_pool(txn, groups, start_week=202201, end_week=202226)
    alloc = spec_allocation(pool, spec)                    # sequential quotas
    split = audience_split(alloc.picks, segments, fractions, group_col="ca_nm", salt="2022-08")
    files = export_audiences(split, customer_dim, "s3://bucket/export", group_col="ca_nm")
    prob  = purchase_propensity(txn, prod_dim, targets, "2022-08-01")
    stages = run_waterfall(txn, groups, WaterfallSpec(...))   # hand-written chain
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audix import contracts as C
from audix.operators import allocate as A
from audix.operators import cycle as Y
from audix.operators import export as X
from audix.operators import pool as P
from audix.operators import rank as R
from audix.operators import split as SP
from audix.operators import waterfall as W
from audix.operators.groups import expand_to_class
from audix.operators.pool import allocation_pool
from audix.operators.rank import sales_rank
from audix.operators.segment import attach_segment
from audix.operators.snapshot import snapshot_txn
from audix.sources.readers import spec_frame
from audix.sources.sinks import stage_bucketed, stage_table


def rank_pool(txn: DataFrame, groups: DataFrame, start_week: int | None = None, end_week: int | None = None,
              channel: str | Sequence[str] | None = None) -> DataFrame:
    """Snapshot -> sales rank per group -> one pool row per household
    (group list, size, group -> rank map)."""
    snap = snapshot_txn(txn, start_week, end_week, channel)
    return allocation_pool(sales_rank(snap, groups))


def spec_allocation(pool: DataFrame, spec: DataFrame, sizes: Sequence[int] = (1, 2, 3, 4),
                    picks: DataFrame | None = None) -> A.Allocation:
    """Sequential quota allocation of a pool under a (gr_nm, ca_nm, n_ca) spec."""
    return A.allocate(pool, spec, sizes=sizes, picks=picks)


def audience_split(alloc: DataFrame, segments: DataFrame, fractions: Mapping[str, float],
                   group_col: str = C.GROUP, no_control: Sequence[str] = (),
                   default_fraction: float | None = None, *, salt: str) -> DataFrame:
    """Attach segments (fill label for households without one), then assign
    test / control per audience x segment."""
    with_seg = attach_segment(alloc, segments)
    return SP.assign_arm(with_seg, fractions, group_col=group_col, no_control=no_control,
                         default_fraction=default_fraction, salt=salt)


def export_audiences(split: DataFrame, customer_dim: DataFrame, path: str,
                     group_col: str = C.GROUP) -> DataFrame:
    """Write one id list per audience and arm and read back the row counts."""
    ids = stage_table(SP.attach_hashed_ids(split, customer_dim), "export-ids")
    X.export_lists(ids, path, group_col=group_col)
    return X.export_counts(ids, path, group_col=group_col)


def purchase_propensity(txn: DataFrame, prod_dim: DataFrame, targets: DataFrame,
                        campaign_start: dt.date | str, campaign_days: int = C.CAMPAIGN_DAYS,
                        alpha: float = C.SMOOTHING_ALPHA) -> DataFrame:
    """Products of the targets' classes -> purchase gaps -> rhythm of each
    household -> probability of a purchase inside the campaign window."""
    gaps = Y.purchase_gaps(txn, expand_to_class(prod_dim, targets))
    return Y.window_probability(Y.purchase_rhythm(gaps, alpha), campaign_start, campaign_days)


@dataclass
class DepartmentStage:
    """Households that bought every department, counting only lines outside
    the excluded groups; ranked on the pooled departments; best ``quota``."""
    departments: Sequence[str]
    excluded: Sequence[str]
    label: str
    quota: int


@dataclass
class WaterfallSpec:
    family: Sequence[str]                          # exclusive-shopper groups
    exclusive_quota: Mapping[str, int]             # quota per family group
    super_groups: Mapping[str, str]                # family group -> super-group
    set_mapping: Sequence[tuple[Sequence[str], str]]   # exact super-group set -> target
    super_quota: Mapping[str, int]                 # quota per target super-group
    both: Sequence[str] = ()                       # co-purchase stage (no quota)
    both_label: str | None = None
    departments: Sequence[DepartmentStage] = field(default_factory=list)


def department_suffix(i: int) -> str:
    """Suffix of the product groups of department stage ``i`` without its excluded products."""
    return f"~d{i}"


class WaterfallRun:
    """The hand-written waterfall as one declarative run: exclusive shoppers
    -> exact super-group sets -> co-buyers -> department-minus-products stages,
    each stage excluding the households of the earlier ones.

    The lines are read once into a household x group spend table, stored in buckets of households; every
    stage works on it, and set building and the anti joins with earlier stages move the picks only. Stages are built on first use, so a report on an early
    stage does not run the later ones, and every stage's picks are staged
    (bounded by its quota), so later stages anti-join short plans.
    """

    def __init__(self, txn: DataFrame, groups: DataFrame, spec: WaterfallSpec):
        self.txn, self.groups, self.spec = txn, groups, spec
        self._departments: dict[int, DataFrame] = {}
        self._before: dict[int, DataFrame] = {}

    @cached_property
    def spend(self) -> DataFrame:
        groups = self.groups
        for i, st in enumerate(self.spec.departments):
            groups = groups.unionByName(
                W.exclusion_groups(self.groups, st.departments, st.excluded, department_suffix(i)))
        return stage_bucketed(R.group_spend(snapshot_txn(self.txn), groups), "waterfall_spend", C.HOUSEHOLD)

    @cached_property
    def exclusive_candidates(self) -> DataFrame:
        family = self.spend.where(F.col(C.GROUP).isin(list(self.spec.family)))
        return stage_table(P.exclusive_shoppers(family).join(R.rank_spend(family), [C.HOUSEHOLD, C.GROUP]), "exclusive-candidates")

    @cached_property
    def exclusive(self) -> DataFrame:
        return stage_table(W.limit_by_quota(self.exclusive_candidates, dict(self.spec.exclusive_quota)), "exclusive")

    @cached_property
    def _super_spend(self) -> DataFrame:
        rest = W.exclude_allocated(self.spend, self.exclusive)
        rolled = W.regroup_spend(rest.where(F.col(C.GROUP).isin(list(self.spec.super_groups))), dict(self.spec.super_groups))
        return stage_bucketed(rolled, "super_spend", C.HOUSEHOLD)

    @cached_property
    def super_rank(self) -> DataFrame:
        return R.rank_spend(self._super_spend)

    @cached_property
    def mapped(self) -> DataFrame:
        mapping = spec_frame(self.txn.sparkSession, [(sorted(s), t) for s, t in self.spec.set_mapping],
                             f"gr_set array<string>, {C.GROUP} string")
        return stage_table(W.map_sets(P.household_group_sets(self._super_spend), mapping, self.super_rank), "mapped-sets")

    @cached_property
    def sets(self) -> DataFrame:
        return stage_table(W.limit_by_quota(self.mapped, dict(self.spec.super_quota)), "sets")

    @cached_property
    def after_sets(self) -> DataFrame:
        return W.exclude_allocated(self.spend, self.exclusive, self.sets)

    @cached_property
    def both(self) -> DataFrame | None:
        if not self.spec.both:
            return None
        return stage_table(W.bought_all(self.after_sets, self.spec.both, label=self.spec.both_label), "both")

    def _before_department(self, i: int) -> DataFrame:
        """Spend on the departments of stage ``i`` of the households that no stage before it took; staged, since
        candidates and ranks read it."""
        if i not in self._before:
            taken = [self.exclusive, self.sets, *([self.both] if self.spec.both else []),
                     *(self.department(k) for k in range(i))]
            names = self.spec.departments[i].departments
            own = self.spend.where(F.col(C.GROUP).isin([*names, *(d + department_suffix(i) for d in names)]))
            self._before[i] = stage_bucketed(W.exclude_allocated(own, *taken), "before_department", C.HOUSEHOLD)
        return self._before[i]

    def department_candidates(self, i: int) -> DataFrame:
        return W.bought_excluding_lines(self._before_department(i), self.spec.departments[i].departments,
                                        department_suffix(i))

    def department(self, i: int) -> DataFrame:
        if i not in self._departments:
            st = self.spec.departments[i]
            ranks = R.rank_spend(self._before_department(i), names=st.departments, label=st.label)
            self._departments[i] = stage_table(W.top_k(self.department_candidates(i), ranks, st.quota), "department")
        return self._departments[i]

    @cached_property
    def combined(self) -> DataFrame:
        return W.combine_allocations(self.exclusive, self.sets, *([self.both] if self.spec.both else []),
                                     *(self.department(i) for i in range(len(self.spec.departments))))


def run_waterfall(txn: DataFrame, groups: DataFrame, spec: WaterfallSpec) -> dict[str, DataFrame]:
    """Every stage of :class:`WaterfallRun` by name, and ``combined``."""
    run = WaterfallRun(txn, groups, spec)
    out = {"exclusive": run.exclusive, "sets": run.sets}
    if spec.both:
        out["both"] = run.both
    for i, st in enumerate(spec.departments):
        out[st.label] = run.department(i)
    out["combined"] = run.combined
    return out
