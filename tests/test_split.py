import tempfile

import pytest
from pyspark.sql import functions as F

from audix import contracts as C
from audix.operators.split import assign_arm, attach_hashed_ids, sample_by_arm, split_summary


def _alloc(spark, n=4000):
    data = [(i, ["a", "b", "nc"][i % 3], ["s1", "s2", "odd"][i % 7 % 3]) for i in range(n)]
    return spark.createDataFrame(data, "household_id long, gr_nm string, seg_desc string")


def test_arm_is_layout_independent_and_stratified(spark):
    df = _alloc(spark)
    fr = {"s1": 0.5, "s2": 0.1}
    a = {r[0]: r[1] for r in assign_arm(df.repartition(3), fr, no_control=["nc"], salt="t", default_fraction=0.0).select(C.HOUSEHOLD, C.ARM).collect()}
    b = {r[0]: r[1] for r in assign_arm(df.repartition(7), fr, no_control=["nc"], salt="t", default_fraction=0.0).select(C.HOUSEHOLD, C.ARM).collect()}
    assert a == b and len(a) == 4000
    out = assign_arm(df, fr, no_control=["nc"], salt="t", default_fraction=0.0)
    share = {(r["gr_nm"], r["seg_desc"]): r["c"] for r in out.groupBy("gr_nm", "seg_desc").agg(
        F.avg(F.when(F.col(C.ARM) == C.ARM_CONTROL, 1.0).otherwise(0.0)).alias("c")).collect()}
    assert all(v == 0.0 for (g, s), v in share.items() if g == "nc" or s == "odd")
    assert all(abs(v - fr[s]) < 0.08 for (g, s), v in share.items() if g != "nc" and s in fr)


def test_unknown_stratum_default_and_strict(spark):
    df = _alloc(spark, 300)
    allc = assign_arm(df, {"s1": 0.0}, default_fraction=1.0, salt="t")
    assert {r[0] for r in allc.where("seg_desc <> 's1'").select(C.ARM).distinct().collect()} == {C.ARM_CONTROL}
    with pytest.raises(Exception, match="no control fraction"):
        assign_arm(df, {"s1": 0.5}, salt="t").collect()
    with pytest.raises(ValueError):
        assign_arm(df, {"s1": 0.5}, salt="")


def test_rows_without_audience_are_left_out_and_salt_changes_arms(spark):
    df = _alloc(spark, 900).withColumn(C.GROUP, F.when(F.col(C.GROUP) != "b", F.col(C.GROUP)))
    first = assign_arm(df, {}, default_fraction=0.5, salt="jan")
    assert first.count() == 600 and first.where(F.col(C.GROUP).isNull()).count() == 0
    arms = [{r[0]: r[1] for r in assign_arm(df, {}, default_fraction=0.5, salt=x).select(C.HOUSEHOLD, C.ARM).collect()}
            for x in ("jan", "feb")]
    assert 200 < sum(arms[0][k] != arms[1][k] for k in arms[0]) < 400


def test_export_keeps_names_ids_and_empty_lists(spark):
    from audix.operators.export import export_counts, export_lists
    data = [("007", "test", "a"), ("007", "test", None), ("007", "ctrl", None), ("7", "test", "b"), ("7", "test", "c"),
            ("x", "test", "0012")]
    df = spark.createDataFrame(data, "gr_nm string, arm string, hashed_id string")
    path = tempfile.mkdtemp(prefix="audix-lists-") + "/lists"
    export_lists(df, path, rows_per_file=1)
    got = {(r.gr_nm, r.arm): (r.n_households, r.n_without_id, r.n_rows) for r in export_counts(df, path).collect()}
    assert got == {("007", "test"): (2, 1, 1), ("007", "ctrl"): (1, 1, 0), ("7", "test"): (2, 0, 2), ("7", "ctrl"): (0, 0, 0),
                   ("x", "test"): (1, 0, 1), ("x", "ctrl"): (0, 0, 0)}


def test_summary_keeps_empty_arm_and_hashed_ids(spark):
    df = _alloc(spark, 600)
    out = assign_arm(df, {"s1": 0.5, "s2": 0.5}, no_control=["nc"], salt="t", default_fraction=0.0)
    summ = {r[C.GROUP]: (r["n_test"], r["n_ctrl"], r["n_total"]) for r in split_summary(out).collect()}
    assert summ["nc"][1] == 0 and summ["nc"][0] == summ["nc"][2] == 200
    assert all(t + c == n for t, c, n in summ.values())
    cust = spark.createDataFrame([(0, "h0"), (1, "h1")], "household_id long, hashed_id string")
    ids = attach_hashed_ids(out, cust)
    assert ids.count() == 600 and ids.where(F.col(C.HASHED_ID).isNotNull()).count() == 2


def test_sample_by_arm_covers_input(spark):
    df = _alloc(spark, 1000)
    out = sample_by_arm(df, {"s1": 0.3, "s2": 0.3, "odd": 0.3}, seed=0)
    assert out.count() == 1000
    assert out.select(C.HOUSEHOLD).distinct().count() == 1000
    assert 150 < out.where(F.col(C.ARM) == C.ARM_CONTROL).count() < 450
