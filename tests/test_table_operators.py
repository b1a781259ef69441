"""Set difference, reconciliation, pivot, exact quantile, spec intake and the SQL function."""

import random

import pytest
from pyspark.sql import functions as F

from audix import contracts as C
from audix.functions import exponential_window_probability
from audix.functions.sql import register_functions
from audix.operators.quantile import exact_quantile
from audix.operators.tables import except_distinct, pivot_values, reconcile
from audix.sources.spec_intake import read_spec_checked
from tests.conftest import rows


def test_except_distinct_with_nulls_repeats_and_maps(spark):
    schema = "`a.b` long, m map<string,int>, l array<map<string,int>>, s struct<x:int,m:map<int,int>>"
    left = [(1, {"a": 1, "b": 2}, [{"x": 1}], (1, {1: 2})), (1, {"b": 2, "a": 1}, [{"x": 1}], (1, {1: 2})), (None, None, None, None),
            (None, None, None, None), (2, {}, [], (None, None)), (3, {"a": None}, [None], (3, {}))]
    right = [(1, {"b": 2, "a": 1}, [{"x": 1}], (1, {1: 2})), (3, {"a": 0}, [None], (3, {}))]
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    got = {(r[0], None if r[1] is None else tuple(r[1].items())) for r in except_distinct(a, b).collect()}
    assert got == {(None, None), (2, ()), (3, (("a", None),))} and except_distinct(a, b).count() == 3
    assert except_distinct(a, b).schema == a.schema
    assert except_distinct(a, a).collect() == [] and except_distinct(a, a.limit(0)).count() == 4
    # Columns are matched by name, and other columns of the right side are not read.
    assert except_distinct(a.select("`a.b`"), b.select("m", "`a.b`")).count() == 2


def test_reconcile_names_the_side(spark):
    a = spark.createDataFrame([(1, 10, "x"), (2, 20, "y"), (None, 30, "z")], "id long, v long, only_a string")
    b = spark.createDataFrame([(2, 21), (3, 31), (None, 32)], "id long, v long")
    out = reconcile(a, b, ["id"])
    assert out.columns == ["id", "v_left", "only_a", "v_right", "found_in"]
    assert sorted(map(str, out.collect())) == sorted(map(str, [
        out.sparkSession.createDataFrame([r], out.schema).first() for r in
        [(1, 10, "x", None, "left"), (2, 20, "y", 21, "both"), (None, 30, "z", 32, "both"), (3, None, None, 31, "right")]]))
    assert "CartesianProduct" not in out._jdf.queryExecution().executedPlan().toString()
    assert rows(reconcile(a.limit(0), b, ["id"]), "v_right", "found_in") == [(21, "right"), (31, "right"), (32, "right")]


def test_pivot_bounds_and_absent_values(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", 6), (1, "b", 7), (2, None, 8)], "id long, k string, v long")
    got = {r["id"]: (r["a"], r["b"]) for r in pivot_values(df, ["id"], "k", F.col("v")).collect()}
    assert got == {1: (11, 7), 2: (None, None)}
    given = pivot_values(df, ["id"], "k", F.col("v"), values=["b", "c"], prefix="k_")
    assert given.columns == ["id", "k_b", "k_c"]
    assert {r["id"]: (r["k_b"], r["k_c"]) for r in given.collect()} == {1: (7, None), 2: (None, None)}
    with pytest.raises(ValueError, match="more than 1"):
        pivot_values(df, ["id"], "k", F.col("v"), max_values=1)
    assert pivot_values(df.limit(0), ["id"], "k", F.col("v")).columns == ["id"]


@pytest.mark.parametrize("seed", range(4))
def test_exact_quantile(spark, seed):
    rnd = random.Random(seed)
    values = [rnd.choice([rnd.gauss(0, 1), rnd.randint(-3, 3) * 1.0, 1e9 * rnd.random(), 0.1 + 1e-17]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values + [None, float("nan")]], "v double")
    for q in (0.5, 0.001, 0.9, 1.0):
        want = sorted(values)[max(1, -(-int(q * 1000) * len(values) // 1000)) - 1]
        assert exact_quantile(df, "v", q, ranges=7, few=5) == want
    assert exact_quantile(df.limit(0), "v") is None
    assert exact_quantile(df.where("v IS NULL"), "v") is None


def test_spec_rejects_have_reasons(spark, tmp_path):
    (tmp_path / "spec.csv").write_text('gr_nm,ca_nm,n_ca\na,A,10\na,B,ten\nb,,5\nb,C,-1\nc,D,1\nc,D,2\nd,E,3,4\n007," ",1\n007,F,0\ne,G,\n')
    good, bad = read_spec_checked(spark, str(tmp_path / "spec.csv"), "gr_nm string, ca_nm string, n_ca long", key=[C.GROUP, C.AUDIENCE],
                                  required=[C.GROUP, C.AUDIENCE], checks={"negative quota": F.col(C.QUOTA) >= 0})
    assert rows(good) == [("007", "F", 0), ("a", "A", 10)]
    assert sorted((r.reason, r.gr_nm) for r in bad.collect()) == [
        ("duplicate", "c"), ("duplicate", "c"), ("malformed", "a"), ("malformed", "d"), ("missing ca_nm", "007"), ("missing ca_nm", "b"),
        ("negative quota", "b"), ("negative quota", "e")]
    assert {r.line for r in bad.collect() if r.reason == "malformed"} == {"a,B,ten", "d,E,3,4"}


def test_probability_as_sql_function(spark):
    register_functions(spark)
    df = spark.createDataFrame([(m, s) for m in (None, -1.0, 0.0, 7.5) for s in (-20, -3, 0, 9)], "m double, s int")
    out = df.selectExpr("m", "s", "window_probability(m, s, s + 14) AS p").withColumn(
        "q", exponential_window_probability(F.col("m"), F.col("s"), F.col("s") + 14))
    assert all(r.p == r.q for r in out.collect()) and out.where("p IS NOT NULL").count() == 4
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
