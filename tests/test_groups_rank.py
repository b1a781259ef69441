import os
import tempfile

from pyspark.sql import functions as F

from audix import contracts as C
from audix.operators.groups import expand_to_class, group_summary, product_groups, regroup
from audix.operators.pool import allocation_pool, combination_report, exclusive_shoppers, pool_check, pool_long
from audix.operators.rank import frequency_rank, group_spend, rank_drilldown, rank_spend, sales_rank
from audix.sources.readers import read_many, read_spec_csv
from tests.conftest import rows

TXN = "household_id long, transaction_uid long, upc_id long, net_spend_amt long"


def _txn(spark, data):
    return spark.createDataFrame(data, TXN)


def test_product_groups_union_rules_and_unique(spark):
    dim = spark.createDataFrame([(1, "SKIN", "A"), (2, "SKIN", "B"), (3, "HAIR", "A")],
                                "upc_id long, department_name string, section_name string")
    listed = spark.createDataFrame([(1, "g1"), (1, "g1"), (3, "g2")], "upc_id long, gr_nm string")
    out = product_groups(listed, dim, {"dep_skin": F.col("department_name") == "SKIN",
                                       "sec_a": F.col("section_name") == "A"})
    assert rows(out) == [(1, "dep_skin"), (1, "g1"), (1, "sec_a"), (2, "dep_skin"), (3, "g2"), (3, "sec_a")]
    summ = {r[C.GROUP]: r["n_products"] for r in group_summary(out).collect()}
    assert summ == {"dep_skin": 2, "g1": 1, "sec_a": 2, "g2": 1}


def test_regroup_and_class_expansion(spark):
    groups = spark.createDataFrame([(1, "a"), (2, "b"), (3, "z")], "upc_id long, gr_nm string")
    assert rows(regroup(groups, {"a": "ab", "b": "ab"})) == [(1, "ab"), (2, "ab")]
    dim = spark.createDataFrame([(1, 10), (2, 10), (3, 20), (4, 30)], "upc_id long, class_code int")
    targets = spark.createDataFrame([(1,), (3,)], "upc_id long")
    assert rows(expand_to_class(dim, targets)) == [(1,), (2,), (3,)]


def test_sales_rank_ties_by_household_and_exact_sums(spark):
    txn = _txn(spark, [(5, 1, 1, 300), (3, 2, 1, 100), (3, 3, 1, 200), (9, 4, 1, 300), (7, 5, 2, 1)])
    groups = spark.createDataFrame([(1, "g"), (2, "g")], "upc_id long, gr_nm string")
    got = rows(sales_rank(txn, groups), C.HOUSEHOLD, C.SALES, C.RANK)
    # 3, 5 and 9 all spent 300: ties broken by household id
    assert got == [(3, 300, 1), (5, 300, 2), (7, 1, 4), (9, 300, 3)]


def test_pooled_label_counts_product_in_two_groups_twice(spark):
    txn = _txn(spark, [(1, 1, 1, 10), (2, 2, 2, 15)])
    groups = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "upc_id long, gr_nm string")
    got = rows(sales_rank(txn, groups, label="ab"), C.HOUSEHOLD, C.GROUP, C.SALES, C.RANK)
    assert got == [(1, "ab", 20, 1), (2, "ab", 15, 2)]


def test_frequency_rank_split_and_drop(spark):
    txn = _txn(spark, [(1, 1, 1, 10), (1, 2, 1, 10), (2, 3, 1, 50), (3, 4, 1, 5), (3, 4, 1, 5)])
    groups = spark.createDataFrame([(1, "g")], "upc_id long, gr_nm string")
    got = rows(frequency_rank(txn, groups), C.HOUSEHOLD, C.GROUP, C.RANK)
    assert got == [(1, "g_multitimes", 1), (2, "g_onetime", 1), (3, "g_onetime", 2)]
    dropped = rows(frequency_rank(txn, groups, drop=["g_multitimes"]), C.HOUSEHOLD)
    assert dropped == [(2,), (3,)]


def test_pool_keeps_best_rank_when_household_ranked_twice(spark):
    ranks = spark.createDataFrame([(1, "a", 5), (1, "a", 2), (1, "b", 1), (2, "b", 2)],
                                  "household_id long, gr_nm string, gr_sales_rank int")
    pool = allocation_pool(ranks)
    got = {r[C.HOUSEHOLD]: (r[C.GROUP_LIST], r[C.GROUP_COUNT], dict(r[C.RANK_MAP])) for r in pool.collect()}
    assert got == {1: (["a", "b"], 2, {"a": 2, "b": 1}), 2: (["b"], 1, {"b": 2})}
    assert rows(pool_check(pool)) == [(1, 1, 0), (2, 1, 0)]
    assert rows(combination_report(pool)) == [(1, "b", 1), (2, "a,b", 1)]
    assert rows(pool_long(pool), C.HOUSEHOLD, C.GROUP, "rank") == [(1, "a", 2), (1, "b", 1), (2, "b", 2)]


def test_exclusive_shoppers_and_drilldown(spark):
    spend = group_spend(_txn(spark, [(1, 1, 1, 5), (1, 2, 2, 5), (2, 3, 1, 9), (3, 4, 2, 1)]),
                        spark.createDataFrame([(1, "a"), (2, "b")], "upc_id long, gr_nm string"))
    assert rows(exclusive_shoppers(spend)) == [(2, "a"), (3, "b")]
    ranks = rank_spend(spend)
    assert rows(rank_drilldown(ranks, "a", 2), C.HOUSEHOLD, C.GROUP) == [(1, "a"), (1, "b")]


def test_spec_csv_keeps_leading_zeros_with_explicit_schema(spark):
    d = tempfile.mkdtemp(prefix="audix-csv-")
    path = os.path.join(d, "groups.csv")
    with open(path, "w") as fh:
        fh.write("upc_id,gr_nm\n007,a\n010,b\n")
    got = rows(read_spec_csv(spark, path, "upc_id string, gr_nm string"))
    assert got == [("007", "a"), ("010", "b")]


def test_read_many_unions_by_name(spark):
    d = tempfile.mkdtemp(prefix="audix-parts-")
    spark.createDataFrame([(1, "a", 3)], "household_id long, gr_nm string, r int").write.parquet(f"{d}/part_1")
    spark.createDataFrame([(2, "b")], "household_id long, gr_nm string").write.parquet(f"{d}/part_2")
    spark.createDataFrame([(3, "c")], "household_id long, gr_nm string").write.parquet(f"{d}/other")
    both = read_many(spark, [f"{d}/part_1", f"{d}/part_2"])
    assert rows(both, "household_id", "r") == [(1, 3), (2, None)]


def test_spec_csv_json_array_column(spark):
    d = tempfile.mkdtemp(prefix="audix-csv-")
    path = os.path.join(d, "sets.csv")
    with open(path, "w") as fh:
        fh.write('gr_set,gr_nm\n"[""a"",""b""]",b\n"[""a""]",a\n')
    got = rows(read_spec_csv(spark, path, "gr_set string, gr_nm string", json_arrays=["gr_set"]), "gr_nm", "gr_set")
    assert got == [("a", ["a"]), ("b", ["a", "b"])]
