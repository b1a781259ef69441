import datetime as dt
import tempfile

from pyspark.sql import functions as F

from audix import contracts as C
from audix.operators.groups import regroup
from audix.operators.rank import group_reach
from audix.operators.snapshot import snapshot_range
from audix.sources.readers import file_row_counts, read_many, read_table, spec_frame
from audix.sources.sinks import stage_table, write_table
from tests.conftest import rows


def test_glob_filtered_folder_and_file_counts(spark):
    d = tempfile.mkdtemp(prefix="audix-glob-")
    spark.createDataFrame([(1,), (2,)], "household_id long").coalesce(1).write.parquet(f"{d}/gr_nm_sales_part1")
    spark.createDataFrame([(3,)], "household_id long").coalesce(1).write.parquet(f"{d}/gr_nm_sales_part2")
    spark.createDataFrame([(9,)], "household_id long").coalesce(1).write.parquet(f"{d}/other")
    picked = read_many(spark, d, glob="gr_nm_sales*")
    assert sorted(r[0] for r in picked.collect()) == [1, 2, 3]
    spark.createDataFrame([(8, "x")], "household_id long, extra string").write.parquet(f"{d}/wide")
    every = read_many(spark, d)
    assert sorted((r.household_id, r.extra) for r in every.collect()) == [(1, None), (2, None), (3, None), (8, "x"), (9, None)]
    only = read_many(spark, [f"{d}/gr_nm_sales_part1", f"{d}/gr_nm_sales_part2"])
    assert sorted(r[0] for r in only.collect()) == [1, 2, 3]
    counts = sorted(r["n_rows"] for r in file_row_counts(only).collect())
    assert counts == [1, 2]


def test_partitioned_write_and_stage(spark):
    df = spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (3, 2, "c")], "household_id long, n_gr int, gr_nm string")
    d = tempfile.mkdtemp(prefix="audix-write-")
    write_table(df, f"{d}/t", partition_by=["n_gr"])
    back = read_table(spark, f"{d}/t").where(F.col("n_gr") == 2)
    assert rows(back, "household_id") == [(2,), (3,)]
    staged = stage_table(df, "test", partition_by=["n_gr"])
    assert staged.count() == 3
    plan = staged.where(F.col("n_gr") == 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_snapshot_range_reach_and_mapping_regroup(spark):
    txn = spark.createDataFrame(
        [(1, 10, dt.date(2022, 1, 3), 202201), (2, 11, dt.date(2022, 2, 1), 202205), (2, 10, dt.date(2022, 2, 1), 202205)],
        "household_id long, upc_id long, date_id date, week_id int")
    assert rows(snapshot_range(txn)) == [(202201, 202205, dt.date(2022, 1, 3), dt.date(2022, 2, 1))]
    groups = spec_frame(spark, [(10, "a"), (11, "b"), (10, "b")], "upc_id long, gr_nm string")
    assert rows(group_reach(txn, groups)) == [("a", 2), ("b", 2)]
    mapping = spark.createDataFrame([("a", "ab"), ("b", "ab")], "gr_nm string, super string")
    assert rows(regroup(groups, mapping), C.PRODUCT, C.GROUP) == [(10, "ab"), (11, "ab")]
