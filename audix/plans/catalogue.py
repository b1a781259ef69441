"""The query catalogue: one query per operator of the method, each over the
driver's tables at ``sf_dir``. Column names match the SQL twins in
``oracle.py``; integers are reported as bigint, amounts as double."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from audix import contracts as C
from audix.functions import map_to_string, sorted_join, spend_to_double
from audix.operators import allocate as A
from audix.operators import cycle as Y
from audix.operators import export as X
from audix.operators import groups as G
from audix.operators import pool as P
from audix.operators import rank as R
from audix.operators import split as SP
from audix.operators import waterfall as W
from audix.functions.sql import register_functions
from audix.operators.reach import reach, reach_bitmaps
from audix.operators.report import ordered
from audix.operators.segment import attach_segment, periods_back, segments_at
from audix.operators.snapshot import snapshot_profile as _snapshot_profile
from audix.operators.snapshot import snapshot_txn
from audix.operators.snapshot_store import read_snapshot, refresh_snapshot
from audix.operators.tables import except_distinct, pivot_values, reconcile
from audix.plans import chains as K
from audix.plans import specs as S
from audix.session import stage_path
from audix.sources import fixtures
from audix.sources.readers import file_row_counts, read_catalog, read_many, read_spec_csv, read_table
from audix.sources.sinks import stage_table
from audix.sources.spec_intake import read_spec_checked

Query = Callable[[SparkSession, str], DataFrame]


def normalize(df: DataFrame) -> DataFrame:
    """Integers as bigint, floats and decimals as double."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.FloatType, T.DecimalType)):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _sales(df: DataFrame) -> DataFrame:
    return df.withColumn(C.SALES, spend_to_double(F.col(C.SALES)))


def _round(col: str, digits: int = 6):
    return F.round(F.col(col), digits).alias(col)


# ---- snapshot, calendar, segments --------------------------------------

def q_snapshot_profile(spark, sf_dir):
    snap = K.week_snapshot(spark, sf_dir, S.TOPK_START_WEEK, S.TOPK_END_WEEK, S.SNAP_PROFILE_CHANNEL)
    seg = K.segments_at_week(spark, sf_dir, S.TOPK_END_WEEK)
    out = _snapshot_profile(snap, seg)
    return out.withColumn("spend", spend_to_double(F.col("spend")))


def q_segment_as_of(spark, sf_dir):
    """The chosen period prunes the folders of a history partitioned by period."""
    history = stage_table(fixtures.segment_history(spark, sf_dir), "segment-history", partition_by=[C.PERIOD])
    return segments_at(history, fixtures.date_dim(spark, sf_dir)).select(C.HOUSEHOLD, C.SEGMENT, F.col(C.PERIOD).cast("long").alias(C.PERIOD))


def q_period_of(spark, sf_dir):
    """Period of the last order date and of the day a look-back before it."""
    return periods_back(fixtures.date_dim(spark, sf_dir), [0, C.SEGMENT_LOOKBACK_DAYS])


def q_snapshot_with_segment(spark, sf_dir):
    seg = K.segments_at_week(spark, sf_dir)
    snap = snapshot_txn(fixtures.transactions(spark, sf_dir), channel=S.SNAP_PROFILE_CHANNEL, segments=seg)
    return snap.groupBy(C.SEGMENT).agg(F.count(F.lit(1)).alias("n_lines"),
                                       F.countDistinct(C.HOUSEHOLD).alias("n_households"))


def q_product_groups(spark, sf_dir):
    return G.group_summary(S.waterfall_groups(spark, sf_dir))


def q_group_reach(spark, sf_dir):
    return R.group_reach(K.full_snapshot(spark, sf_dir), S.waterfall_groups(spark, sf_dir))


def q_class_products(spark, sf_dir):
    return K.class_products(spark, sf_dir)


# ---- ranks and pool (chain A) -------------------------------------------

def q_sales_top_k(spark, sf_dir):
    """Minimum slice: week-range snapshot -> sales rank -> best k per group."""
    snap = K.week_snapshot(spark, sf_dir, S.TOPK_START_WEEK, S.TOPK_END_WEEK)
    ranks = R.sales_rank(snap, S.pool_groups(spark, sf_dir))
    top = W.rank_up_to_quota(ranks, {g: S.TOPK_PER_GROUP for g in S.POOL_BRANDS})
    return _sales(top)


def q_sales_rank(spark, sf_dir):
    return _sales(K.pool_ranks(spark, sf_dir))


def q_frequency_rank(spark, sf_dir):
    snap = K.full_snapshot(spark, sf_dir)
    groups = S.pool_groups(spark, sf_dir).where(F.col(C.GROUP).isin(S.FREQ_GROUPS))
    return _sales(R.frequency_rank(snap, groups, drop=S.FREQ_DROP))


def q_rank_union(spark, sf_dir):
    return _sales(K.rank_parts(spark, sf_dir))


def q_group_list(spark, sf_dir):
    pl = K.pool(spark, sf_dir)
    return pl.select(C.HOUSEHOLD, sorted_join(F.col(C.GROUP_LIST)).alias(C.GROUP_LIST), C.GROUP_COUNT)


def q_rank_map(spark, sf_dir):
    pl = K.pool(spark, sf_dir)
    return pl.select(C.HOUSEHOLD, C.GROUP_COUNT, map_to_string(F.col(C.RANK_MAP)).alias(C.RANK_MAP))


def q_pool_check(spark, sf_dir):
    return P.pool_check(K.pool(spark, sf_dir))


def q_combination_report(spark, sf_dir):
    return ordered(P.combination_report(K.pool(spark, sf_dir)), C.GROUP_COUNT, "-n_households", C.GROUP_LIST)


def q_rank_drilldown(spark, sf_dir):
    return _sales(R.rank_drilldown(K.pool_ranks(spark, sf_dir), S.DRILL_GROUP, S.DRILL_RANK))


# ---- sequential allocation (chain A) ------------------------------------

def _picks_out(picks: DataFrame) -> DataFrame:
    return picks.select(*A.PICKS_COLUMNS)


def q_allocation_pass1(spark, sf_dir):
    _, alloc = K.allocation(spark, sf_dir, sizes=(1,))
    return _picks_out(alloc.picks)


def q_remaining_quota(spark, sf_dir):
    _, alloc = K.allocation(spark, sf_dir, sizes=(1,))
    out = A.remaining_quota(S.alloc_spec(spark, sf_dir), alloc.picks)
    out = out.select(C.GROUP, C.AUDIENCE, C.QUOTA, "n_allctd", "to_alloc", _round("prop_to_alloc"), "position")
    return ordered(out, "position", C.AUDIENCE)


def q_available_by_size(spark, sf_dir):
    pl, alloc = K.allocation(spark, sf_dir, sizes=(1,))
    return A.available_by_size(pl, alloc.picks)


def q_allocation_full(spark, sf_dir):
    _, alloc = K.allocation(spark, sf_dir)
    return alloc.state.select(C.HOUSEHOLD, C.GROUP_COUNT, sorted_join(F.col(C.GROUP_LIST)).alias(C.GROUP_LIST),
                              C.AUDIENCE)


def q_allocation_audit(spark, sf_dir):
    _, alloc = K.allocation(spark, sf_dir)
    return _picks_out(alloc.picks)


def q_allocation_profile(spark, sf_dir):
    _, alloc = K.allocation(spark, sf_dir)
    return W.allocation_profile(alloc.picks, group_col=C.AUDIENCE, rank_col="rank")


def q_preview_top_k(spark, sf_dir):
    return A.preview_top_k(K.pool(spark, sf_dir), S.alloc_spec(spark, sf_dir), n=2)


def q_snapshot_conflicts(spark, sf_dir):
    return A.snapshot_conflicts(A.preview_top_k(K.pool(spark, sf_dir), S.alloc_spec(spark, sf_dir), n=2))


def q_overlap_candidates(spark, sf_dir):
    return A.overlap_candidates(K.pool(spark, sf_dir), S.audience_sets(spark))


# ---- waterfall (chain B) -------------------------------------------------

def q_exclusive_shoppers(spark, sf_dir):
    return _sales(K.waterfall(spark, sf_dir).exclusive_candidates)


def q_quota_top_k(spark, sf_dir):
    return _sales(K.waterfall(spark, sf_dir).exclusive)


def q_cut_tail(spark, sf_dir):
    return _sales(W.cut_tail(K.waterfall(spark, sf_dir).exclusive, width=S.CUT_TAIL_WIDTH))


def q_super_group_rank(spark, sf_dir):
    return _sales(K.waterfall(spark, sf_dir).super_rank)


def q_set_mapping(spark, sf_dir):
    return _sales(K.waterfall(spark, sf_dir).mapped)


def q_waterfall_exclude(spark, sf_dir):
    rest = K.waterfall(spark, sf_dir).after_sets
    listed = rest.where(~F.col(C.GROUP).contains("~"))
    return listed.groupBy(C.HOUSEHOLD).agg(F.countDistinct(C.GROUP).alias("n_groups"),
                                           F.sum("n_lines").alias("n_lines"))


def q_bought_both(spark, sf_dir):
    return K.waterfall(spark, sf_dir).both


def q_bought_excluding_lines(spark, sf_dir):
    return K.waterfall(spark, sf_dir).department_candidates(1)


def q_pooled_rank_top_k(spark, sf_dir):
    wf = K.waterfall(spark, sf_dir)
    return _sales(wf.department(0).unionByName(wf.department(1)))


def q_combine_allocations(spark, sf_dir):
    return K.waterfall(spark, sf_dir).combined


def q_combine_check(spark, sf_dir):
    return W.one_audience_check(K.waterfall(spark, sf_dir).combined)


def q_waterfall_profile(spark, sf_dir):
    return W.allocation_profile(K.waterfall(spark, sf_dir).combined)


# ---- split and export ----------------------------------------------------

FRACTIONS = {label: C.CONTROL_FRACTION for label in S.SEGMENT_LABELS + [C.SEGMENT_FILL_LABEL]}


def _with_segment(spark, sf_dir):
    seg = K.segments_at_week(spark, sf_dir)
    return attach_segment(K.waterfall(spark, sf_dir).combined, seg)


def _split(spark, sf_dir, no_control=()):
    return SP.assign_arm(_with_segment(spark, sf_dir), FRACTIONS, salt=S.SALT, no_control=no_control)


def q_alloc_segment(spark, sf_dir):
    return _with_segment(spark, sf_dir)


def q_alloc_segment_inner(spark, sf_dir):
    seg = K.segments_at_week(spark, sf_dir)
    return attach_segment(K.waterfall(spark, sf_dir).combined, seg, how="inner")


def q_stratified_split(spark, sf_dir):
    return _split(spark, sf_dir).select(C.HOUSEHOLD, C.GROUP, C.SEGMENT, C.ARM)


def q_split_no_control(spark, sf_dir):
    return _split(spark, sf_dir, S.NO_CONTROL).select(C.HOUSEHOLD, C.GROUP, C.SEGMENT, C.ARM)


def q_sample_by_split(spark, sf_dir):
    """Invariants of the seeded sampleBy split, whose rows depend on the partition layout."""
    alloc = _with_segment(spark, sf_dir).where(~F.col(C.GROUP).isin(S.NO_CONTROL))
    return SP.sampled_shares(SP.sample_by_arm(alloc, FRACTIONS, seed=0), FRACTIONS)


def q_split_summary(spark, sf_dir):
    return ordered(SP.split_summary(_split(spark, sf_dir, S.NO_CONTROL)), "-n_total", C.GROUP)


def q_hashed_ids(spark, sf_dir):
    split = _split(spark, sf_dir, S.NO_CONTROL)
    return SP.attach_hashed_ids(split, fixtures.customer_dim(spark, sf_dir)).select(
        C.HOUSEHOLD, C.GROUP, C.ARM, C.HASHED_ID)


def q_export_lists(spark, sf_dir):
    """Lists with names like 007 and 7, households without an id, and empty control arms."""
    split = _split(spark, sf_dir, S.NO_CONTROL)
    names = F.create_map(*[F.lit(x) for kv in S.EXPORT_NAMES.items() for x in kv])
    split = split.withColumn(C.GROUP, F.coalesce(names[F.col(C.GROUP)], F.col(C.GROUP)))
    known = fixtures.customer_dim(spark, sf_dir).where(F.col(C.HOUSEHOLD) % S.NO_ID_MODULUS != 0)
    ids = stage_table(SP.attach_hashed_ids(split, known).select(C.GROUP, C.ARM, C.HASHED_ID), "export-ids")
    path = X.export_lists(ids, stage_path(spark, "export"))
    return X.export_counts(ids, path).select(C.GROUP, C.ARM, "n_households", "n_without_id", "n_rows")


# ---- purchase cycles (chain C) --------------------------------------------

def q_purchase_cycle(spark, sf_dir):
    return K.gaps(spark, sf_dir)


def _rhythm(spark, sf_dir):
    return Y.purchase_rhythm(K.gaps(spark, sf_dir))


def q_usage_rate(spark, sf_dir):
    return _rhythm(spark, sf_dir).select(C.HOUSEHOLD, "days_per_unit")


def q_smoothed_cycle(spark, sf_dir):
    return _rhythm(spark, sf_dir).select(C.HOUSEHOLD, "cycle_days", "n_gaps")


def q_recency(spark, sf_dir):
    return _rhythm(spark, sf_dir).select(C.HOUSEHOLD, "last_date", "cycle_days")


def q_purchase_probability(spark, sf_dir):
    out = Y.window_probability(_rhythm(spark, sf_dir), S.CAMPAIGN_START)
    return out.select(C.HOUSEHOLD, "last_date", "cycle_days", "days_to_start", _round("chance"))


def q_shopping_cycle(spark, sf_dir):
    return Y.shopping_cycle(K.full_snapshot(spark, sf_dir), K.class_products(spark, sf_dir))


def q_dominant_cycle(spark, sf_dir):
    out = Y.dominant_cycle(K.full_snapshot(spark, sf_dir), K.class_products(spark, sf_dir))
    return out.select(C.HOUSEHOLD, _round("share"), "dominant", "cycle_days")


def q_next_shop_median(spark, sf_dir):
    return Y.next_shop_median(K.full_snapshot(spark, sf_dir))


def q_next_shop_consumption(spark, sf_dir):
    out = Y.next_shop_by_consumption(K.full_snapshot(spark, sf_dir), K.class_products(spark, sf_dir))
    return out.select(C.HOUSEHOLD, "last_date_id", "last_units", _round("med_units_per_day"),
                      _round("next_days"), "next_date_id")


# ---- sources --------------------------------------------------------------

def q_spec_csv(spark, sf_dir):
    """Audience sets written as a CSV spec with a JSON list column, read back with a schema."""
    path = stage_path(spark, "spec-csv")
    sets = S.audience_sets(spark).withColumn("ca_gr_set", F.to_json("ca_gr_set"))
    parts = fixtures.table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias(C.AUDIENCE)).agg(
        F.to_json(F.sort_array(F.collect_set("p_type"))).alias("ca_gr_set"))
    sets.unionByName(parts).write.option("header", True).option("escape", '"').csv(path)
    back = read_spec_csv(spark, path, f"{C.AUDIENCE} string, ca_gr_set string", ["ca_gr_set"])
    return back.select(C.AUDIENCE, F.explode("ca_gr_set").alias(C.GROUP))


def _parts_folder(spark, sf_dir) -> str:
    """A folder of two tables ``rank_a`` and ``rank_b`` with different columns, and one ``other``."""
    path = stage_path(spark, "parts")
    part = fixtures.table(spark, sf_dir, "part")
    part.where("p_size <= 10").select("p_partkey", "p_size").write.parquet(f"{path}/rank_a")
    part.where("p_size > 10 AND p_size <= 30").select("p_partkey", "p_brand").write.parquet(f"{path}/rank_b")
    part.where("p_size > 30").select("p_partkey", "p_type").write.parquet(f"{path}/other")
    return path


def q_prefix_parts(spark, sf_dir):
    return read_many(spark, _parts_folder(spark, sf_dir), glob="rank_*").select("p_partkey", "p_size", "p_brand")


def q_folder_union(spark, sf_dir):
    return read_many(spark, _parts_folder(spark, sf_dir)).select("p_partkey", "p_size", "p_brand", "p_type")


def q_part_counts(spark, sf_dir):
    counts = file_row_counts(read_many(spark, _parts_folder(spark, sf_dir)))
    table = F.regexp_extract("file", "/(rank_a|rank_b|other)/", 1).alias("part")
    return counts.groupBy(table).agg(F.sum("n_rows").alias("n_rows"))


def q_default_load(spark, sf_dir):
    """A table loaded by path and once more from the session's catalog."""
    read_table(spark, f"{sf_dir.rstrip('/')}/supplier.parquet").createOrReplaceTempView("audix_supplier")
    return read_catalog(spark, "audix_supplier").select("s_suppkey", "s_nationkey")


# ---- stored snapshot, reach, table operators ------------------------------

def q_snapshot_refresh(spark, sf_dir):
    """A stored snapshot: all weeks, then the last one again, first with the lines of one channel
    only and then with all of them."""
    txn = fixtures.transactions(spark, sf_dir)
    weeks = [r[0] for r in fixtures.date_dim(spark, sf_dir).select(C.WEEK).distinct().collect()]
    path = refresh_snapshot(txn, stage_path(spark, "snapshot"), weeks, files_per_week=1)
    refresh_snapshot(txn, path, [max(weeks)], channel=S.SNAP_PROFILE_CHANNEL, files_per_week=1)
    refresh_snapshot(txn, path, [max(weeks)], files_per_week=1)
    out = read_snapshot(spark, path).groupBy(C.WEEK).agg(
        F.count(F.lit(1)).alias("n_lines"), F.countDistinct(C.HOUSEHOLD).alias("n_households"), F.sum(C.SPEND).alias("spend"))
    return out.withColumn("spend", spend_to_double(F.col("spend")))


def q_reach_by_weeks(spark, sf_dir):
    """Reach of two overlapping week ranges from one stored table of bitmaps."""
    store = stage_table(reach_bitmaps(K.full_snapshot(spark, sf_dir), S.waterfall_groups(spark, sf_dir)), "reach")
    parts = [reach(store, lo, hi).withColumn("weeks", F.lit(label)) for label, (lo, hi) in S.REACH_RANGES.items()]
    return parts[0].unionByName(parts[1])


def q_except_distinct(spark, sf_dir):
    """Rank parities by group, with nulls, repeats and a map column: those of all households but no even one."""
    pool = K.pool(spark, sf_dir)
    rows = pool.select(C.HOUSEHOLD, F.when(F.col(C.GROUP_COUNT) > 1, F.col(C.GROUP_COUNT)).alias("size"),
                       F.transform_values(C.RANK_MAP, lambda k, v: v % S.RANK_PARITY).alias(C.RANK_MAP))
    rows = stage_table(rows, "parities")
    left, right = rows.drop(C.HOUSEHOLD), rows.where(F.col(C.HOUSEHOLD) % 2 == 0).drop(C.HOUSEHOLD)
    return except_distinct(left, right).select("size", map_to_string(F.col(C.RANK_MAP)).alias(C.RANK_MAP))


def q_reconcile_cycles(spark, sf_dir):
    """Two independent estimates of a household's cycle: target products in all channels, all products in one channel."""
    targets = _rhythm(spark, sf_dir).select(C.HOUSEHOLD, "cycle_days")
    snap = K.full_snapshot(spark, sf_dir).where(F.col(C.CHANNEL) == S.SNAP_PROFILE_CHANNEL)
    return reconcile(targets, Y.shopping_cycle(snap), [C.HOUSEHOLD])


def q_channel_pivot(spark, sf_dir):
    """Spend of each household by channel, one column per channel found."""
    spend = K.full_snapshot(spark, sf_dir).groupBy(C.HOUSEHOLD, C.CHANNEL).agg(F.sum(C.SPEND).alias(C.SPEND))
    out = pivot_values(stage_table(spend, "channel-spend"), [C.HOUSEHOLD], C.CHANNEL, F.col(C.SPEND), prefix="spend_")
    return out.select(C.HOUSEHOLD, *[spend_to_double(F.col(c)).alias(c) for c in out.columns if c != C.HOUSEHOLD])


def q_spec_rejects(spark, sf_dir):
    """A spec written by hand: quotas that are no numbers or negative, audiences without a name, keys given twice."""
    path = stage_path(spark, "spec-rejects")
    part = fixtures.table(spark, sf_dir, "part")
    size = F.col("p_size")
    quota = (F.when(size % 10 == 0, F.lit("many")).when(size % 7 == 0, (-size).cast("string")).otherwise(size.cast("string")))
    name = F.when(size % 9 != 0, F.concat_ws("_", "p_type", (F.col("p_partkey") % S.SPEC_AUDIENCES).cast("string")))
    part.select(F.col("p_brand").alias(C.GROUP), name.alias(C.AUDIENCE), quota.alias(C.QUOTA)).write.option("header", True).csv(path)
    good, bad = read_spec_checked(spark, path, f"{C.GROUP} string, {C.AUDIENCE} string, {C.QUOTA} long",
                                  key=[C.GROUP, C.AUDIENCE], required=[C.GROUP, C.AUDIENCE], checks={"negative quota": F.col(C.QUOTA) >= 0})
    both = bad.select("reason", C.QUOTA).unionByName(good.select(F.lit("used").alias("reason"), C.QUOTA))
    return both.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(C.QUOTA).alias(C.QUOTA))


def q_probability_sql(spark, sf_dir):
    """The purchase probability in SQL text, by the session's own SQL function."""
    register_functions(spark)
    return spark.sql("SELECT household_id, datediff(CAST(:start AS DATE), last_date) AS days_to_start, "
                     "round(window_probability(cycle_days, datediff(CAST(:start AS DATE), last_date), "
                     "datediff(CAST(:start AS DATE), last_date) + :days), 6) AS chance FROM {rhythm}",
                     args={"start": S.CAMPAIGN_START, "days": C.CAMPAIGN_DAYS}, rhythm=_rhythm(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "snapshot_refresh": q_snapshot_refresh,
    "reach_by_weeks": q_reach_by_weeks,
    "except_distinct": q_except_distinct,
    "reconcile_cycles": q_reconcile_cycles,
    "channel_pivot": q_channel_pivot,
    "spec_rejects": q_spec_rejects,
    "probability_sql": q_probability_sql,
    "period_of": q_period_of,
    "snapshot_with_segment": q_snapshot_with_segment,
    "alloc_segment_inner": q_alloc_segment_inner,
    "spec_csv": q_spec_csv,
    "prefix_parts": q_prefix_parts,
    "folder_union": q_folder_union,
    "part_counts": q_part_counts,
    "default_load": q_default_load,
    "snapshot_profile": q_snapshot_profile,
    "segment_as_of": q_segment_as_of,
    "product_groups": q_product_groups,
    "group_reach": q_group_reach,
    "class_products": q_class_products,
    "sales_top_k": q_sales_top_k,
    "sales_rank": q_sales_rank,
    "frequency_rank": q_frequency_rank,
    "rank_union": q_rank_union,
    "group_list": q_group_list,
    "rank_map": q_rank_map,
    "pool_check": q_pool_check,
    "combination_report": q_combination_report,
    "rank_drilldown": q_rank_drilldown,
    "allocation_pass1": q_allocation_pass1,
    "remaining_quota": q_remaining_quota,
    "available_by_size": q_available_by_size,
    "allocation_full": q_allocation_full,
    "allocation_audit": q_allocation_audit,
    "allocation_profile": q_allocation_profile,
    "preview_top_k": q_preview_top_k,
    "snapshot_conflicts": q_snapshot_conflicts,
    "overlap_candidates": q_overlap_candidates,
    "exclusive_shoppers": q_exclusive_shoppers,
    "quota_top_k": q_quota_top_k,
    "cut_tail": q_cut_tail,
    "super_group_rank": q_super_group_rank,
    "set_mapping": q_set_mapping,
    "waterfall_exclude": q_waterfall_exclude,
    "bought_both": q_bought_both,
    "bought_excluding_lines": q_bought_excluding_lines,
    "pooled_rank_top_k": q_pooled_rank_top_k,
    "combine_allocations": q_combine_allocations,
    "combine_check": q_combine_check,
    "waterfall_profile": q_waterfall_profile,
    "alloc_segment": q_alloc_segment,
    "stratified_split": q_stratified_split,
    "split_no_control": q_split_no_control,
    "sample_by_split": q_sample_by_split,
    "split_summary": q_split_summary,
    "hashed_ids": q_hashed_ids,
    "export_lists": q_export_lists,
    "purchase_cycle": q_purchase_cycle,
    "usage_rate": q_usage_rate,
    "smoothed_cycle": q_smoothed_cycle,
    "recency": q_recency,
    "purchase_probability": q_purchase_probability,
    "shopping_cycle": q_shopping_cycle,
    "dominant_cycle": q_dominant_cycle,
    "next_shop_median": q_next_shop_median,
    "next_shop_consumption": q_next_shop_consumption,
}


def queries() -> dict[str, Query]:
    return {name: (lambda fn: (lambda spark, sf_dir: normalize(fn(spark, sf_dir))))(fn)
            for name, fn in QUERIES.items()}
