from audix import contracts as C
from audix.operators.rank import group_spend
from audix.operators.waterfall import (bought_all, cut_tail, bought_excluding_lines, combine_allocations, exclude_allocated,
                                       exclusion_groups, limit_by_quota, map_sets, one_audience_check, top_k)
from tests.conftest import rows

TXN = "household_id long, transaction_uid long, upc_id long, net_spend_amt long"


def _setup(spark):
    groups = spark.createDataFrame([(1, "dep"), (2, "dep"), (2, "x"), (3, "other")], "upc_id long, gr_nm string")
    # hh 1 bought dep product 1 and excluded product 2; hh 2 only the excluded one; hh 3 only product 1
    txn = spark.createDataFrame([(1, 1, 1, 10), (1, 2, 2, 10), (2, 3, 2, 10), (3, 4, 1, 10), (4, 5, 3, 1)], TXN)
    allg = groups.unionByName(exclusion_groups(groups, ["dep"], ["x"], "~ex"))
    return groups, allg, group_spend(txn, allg)


def test_exclusion_is_per_line(spark):
    _, allg, spend = _setup(spark)
    assert rows(allg.where("gr_nm = 'dep~ex'"), C.PRODUCT) == [(1,)]
    assert rows(bought_excluding_lines(spend, ["dep"], "~ex")) == [(1,), (3,)]
    # household level: a household that bought an excluded product is out
    assert rows(bought_excluding_lines(spend, ["dep"], "~ex", excluded=["x"], household_level=True)) == [(3,)]


def test_bought_all_and_exclusion(spark):
    _, _, spend = _setup(spark)
    assert rows(bought_all(spend, ["dep", "x"], label="both"), C.HOUSEHOLD, C.GROUP) == [(1, "both"), (2, "both")]
    picked = spark.createDataFrame([(1,)], "household_id long")
    assert rows(exclude_allocated(spend, picked).select(C.HOUSEHOLD).distinct()) == [(2,), (3,), (4,)]


def test_limit_by_quota_zero_and_bounds(spark):
    df = spark.createDataFrame([(h, g, r) for g in ("a", "b") for r, h in enumerate(range(10, 15), 1)],
                               "household_id long, gr_nm string, gr_sales_rank int")
    out = limit_by_quota(df, {"a": 2, "b": 0})
    assert rows(out, C.HOUSEHOLD, C.GROUP, C.RANK) == [(10, "a", 1), (11, "a", 2)]
    assert "limit" not in out.columns


def test_top_k_and_map_sets(spark):
    ranks = spark.createDataFrame([(1, "g", 3), (2, "g", 1), (3, "g", 2)], "household_id long, gr_nm string, gr_sales_rank int")
    cands = spark.createDataFrame([(1,), (3,)], "household_id long")
    assert rows(top_k(cands, ranks, 1), C.HOUSEHOLD) == [(3,)]
    sets = spark.createDataFrame([(1, ["b", "a"]), (2, ["a"]), (3, ["c"])], "household_id long, gr_set array<string>")
    mapping = spark.createDataFrame([(["a"], "a"), (["a", "b"], "b")], "gr_set array<string>, gr_nm string")
    r2 = spark.createDataFrame([(1, "b", 7), (2, "a", 4)], "household_id long, gr_nm string, gr_sales_rank int")
    from pyspark.sql import functions as F
    sets = sets.withColumn("gr_set", F.sort_array("gr_set"))
    assert rows(map_sets(sets, mapping, r2), C.HOUSEHOLD, C.GROUP, C.RANK) == [(1, "b", 7), (2, "a", 4)]


def test_combine_allocations_fills_missing_rank(spark):
    a = spark.createDataFrame([(1, "a", 1)], "household_id long, gr_nm string, gr_sales_rank int")
    b = spark.createDataFrame([(2, "b")], "household_id long, gr_nm string")
    comb = combine_allocations(a, b)
    assert rows(comb) == [(1, "a", 1), (2, "b", None)]
    assert rows(one_audience_check(comb)) == [(2, 2)]


def test_cut_tail(spark):
    picks = spark.createDataFrame([(h, "a", h) for h in range(1, 8)] + [(20, "b", 3)],
                                  "household_id long, gr_nm string, gr_sales_rank int")
    assert rows(cut_tail(picks, width=2), C.HOUSEHOLD) == [(6,), (7,), (20,)]
