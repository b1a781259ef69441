import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from audix.operators.ranking import pick_by_rank, rank_within


def _frame(spark, n=3000, seed=7, null_group=False):
    rnd = random.Random(seed)
    groups = ["hot"] * 20 + ["b", "c"] + ([None] if null_group else [])
    data = [(rnd.choice(groups), i, rnd.randint(0, 40)) for i in range(n)]
    return spark.createDataFrame(data, "g string, hh long, s long")


def _expected(df, by):
    w = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy(F.col("s").desc(), "hh")
    return {(r["g"], r["hh"]): r["e"] for r in df.withColumn("e", F.row_number().over(w)).collect()}


@pytest.mark.parametrize("by", [["g"], []])
@pytest.mark.parametrize("parts", [3, 8])
def test_rank_equals_row_number(spark, by, parts):
    df = _frame(spark, null_group=True)
    got = rank_within(df, by, [F.col("s").desc(), F.col("hh")], "rk", num_partitions=parts)
    exp = _expected(df, by)
    res = {(r["g"], r["hh"]): r["rk"] for r in got.collect()}
    assert res == exp


@pytest.mark.parametrize("width", [1, 7, 10_000])
@pytest.mark.parametrize("by", [["g"], []])
def test_pick_by_rank_equals_sort_and_limit(spark, width, by):
    df = rank_within(_frame(spark, n=600, null_group=True), ["g"], [F.col("s").desc(), F.col("hh")], "rk")
    df = df.withColumn("lim", F.when(F.col("g") == "hot", 40).otherwise(3) if by else F.lit(23))
    got = pick_by_rank(df, by, F.col("lim"), "rk", ["hh"], width=width)
    assert got.columns == df.columns
    w = Window.partitionBy(*(by or [F.lit(0)])).orderBy("rk", "hh")
    want = df.withColumn("k", F.row_number().over(w)).where("k <= lim").drop("k")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_pick_by_rank_edges(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 3, None)], "g string, hh long, rk int")
    assert pick_by_rank(df, ["g"], 0, "rk").collect() == []
    assert pick_by_rank(df, ["g"], 9, "rk").count() == 2
    assert pick_by_rank(df.limit(0), [], 9, "rk").collect() == []
