"""The stored snapshot, reach from bitmaps, bucketed staging and the calendar inside the plan."""

import datetime as dt
import os

import pytest

from audix import contracts as C
from audix.operators.pool import household_group_sets
from audix.operators.reach import merge_bitmaps, reach, reach_bitmaps
from audix.operators.segment import periods_back, segments_at
from audix.operators.snapshot_store import read_snapshot, refresh_snapshot
from audix.operators.waterfall import exclude_allocated, limit_by_quota, quota_table
from audix.sources.readers import spec_frame
from audix.sources.sinks import stage_bucketed, stage_table
from tests.conftest import rows

LINES = "household_id long, customer_id long, upc_id long, week_id int, channel string, net_spend_amt long"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _lines(spark, data):
    return spark.createDataFrame([(h, h, u, w, ch, 10) for h, u, w, ch in data], LINES)


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_refresh_replaces_its_weeks_only(spark, tmp_path):
    path = str(tmp_path / "snap")
    old = _lines(spark, [(1, 1, 1, "store"), (2, 1, 1, "store"), (1, 2, 2, "store"), (3, 2, 3, "store"), (None, 2, 3, "store")])
    refresh_snapshot(old, path, [1, 2, 3])
    kept = {f: t for f, t in _files(path).items() if "week_id=2" not in f}
    new = _lines(spark, [(7, 1, 2, "store"), (8, 1, 2, "pickup"), (9, 1, 1, "store")])
    for _ in range(2):  # running it again gives the same table
        refresh_snapshot(new, path, [2])
        assert rows(read_snapshot(spark, path), "household_id", "week_id") == [(1, 1), (2, 1), (3, 3), (7, 2), (8, 2)]
        assert {f: t for f, t in _files(path).items() if "week_id=2" not in f} == kept
    refresh_snapshot(new, path, [1, 3])  # week 3 has no lines any more
    assert rows(read_snapshot(spark, path), "household_id", "week_id") == [(7, 2), (8, 2), (9, 1)]
    refresh_snapshot(new, path, [2], channel="pickup")
    assert rows(read_snapshot(spark, path, 2, 2), "household_id") == [(8,)]
    plan = _plan(read_snapshot(spark, path, 2, 3))
    assert "week_id#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_reach_merges_over_any_weeks(spark):
    data = [(h, u, w, "store") for h, u, w in [(1, 1, 1), (1, 1, 2), (2, 1, 2), (40_000, 1, 3), (2, 2, 3), (70_001, 2, 1), (None, 2, 2)]]
    groups = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "upc_id long, gr_nm string")
    store = reach_bitmaps(_lines(spark, data), groups)
    for lo, hi in ((1, 3), (1, 2), (2, 3), (3, 3), (None, 1), (4, 9)):
        want = {}
        for h, u, w, _ in data:
            for g in ("a",) if u == 1 else ("b", "c"):
                if h is not None and (lo is None or lo <= w) and w <= hi:
                    want.setdefault(g, set()).add(h)
        assert rows(reach(store, lo, hi), "gr_nm", "n_households") == sorted((g, len(s)) for g, s in want.items())
    late = reach_bitmaps(_lines(spark, [(5, 1, 2, "store"), (1, 1, 2, "store")]), groups)
    merged = merge_bitmaps(store, late)
    assert rows(reach(merged, 2, 2), "gr_nm", "n_households") == [("a", 3)]
    assert merged.count() == store.count()


def test_bucketed_spend_is_not_moved(spark):
    spend = spark.createDataFrame([(h, g, h * 7 % 5, 1) for h in range(200) for g in "abc" if (h + ord(g)) % 3],
                                  "household_id long, gr_nm string, sales long, n_lines long")
    stored = stage_bucketed(spend, "test_spend", C.HOUSEHOLD)
    assert rows(stored, *spend.columns) == rows(spend)
    picks = stage_table(spark.range(0, 200, 3).select("id").withColumnRenamed("id", C.HOUSEHOLD), "test-picks")
    more = stage_table(spark.range(0, 200, 5).select("id").withColumnRenamed("id", C.HOUSEHOLD), "test-picks")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rest = exclude_allocated(exclude_allocated(stored, picks), more)
        plan = _plan(household_group_sets(rest))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    depth = lines[at].index("FileScan")
    above = []  # the operators over the scan, up to the root
    for line in reversed(lines[:at]):
        indent = len(line) - len(line.lstrip(" :+-"))
        if indent < depth:
            above.append(line)
            depth = indent
    assert any("SortMergeJoin" in line for line in above)
    assert not any("Exchange" in line for line in above), plan


def test_spec_joins_broadcast_the_spec(spark):
    ranks = stage_table(spark.range(1000).selectExpr("id AS household_id", "if(id % 2 = 0, 'a', 'b') AS gr_nm",
                                                     "cast(id div 2 + 1 AS int) AS gr_sales_rank"), "test-ranks")
    joined = ranks.join(quota_table(spark, {"a": 3, "b": 2}), C.GROUP)
    plan = _plan(joined)
    assert "BroadcastHashJoin" in plan and "hashpartitioning(gr_nm" not in plan
    got = limit_by_quota(ranks, {"a": 3, "b": 2})
    assert rows(got, "gr_nm", "gr_sales_rank") == [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 2)]
    assert spec_frame(spark, [], "a string, b array<string>").collect() == []


def test_calendar_inside_the_plan(spark):
    days = [dt.date(2021, 7, 1) + dt.timedelta(days=i) for i in range(549)]
    dim = spark.createDataFrame([(d, d.year * 100 + (d.timetuple().tm_yday - 1) // 7 + 1, d.year * 100 + d.month) for d in days],
                                "date_id date, week_id int, period_id int")
    assert rows(periods_back(dim, [0, 180]), "back_days", "period_id") == [(0, 202212), (180, 202207)]
    history = stage_table(spark.createDataFrame([(h, f"s{p}", p) for h in (1, 2) for p in (202201, 202205, 202206) for _ in range(2)],
                                                "household_id long, seg_desc string, period_id int"), "test-history", partition_by=[C.PERIOD])
    # Week 20 ends in May: the period itself; the last week: the latest published one is too old to fall back on.
    assert rows(segments_at(history, dim, 202220), "household_id", "seg_desc", "period_id") == [(1, "s202205", 202205), (2, "s202205", 202205)]
    assert rows(segments_at(history, dim, 202230), "seg_desc") == [("s202206",), ("s202206",)]
    assert rows(segments_at(history, dim), "seg_desc") == []
    found = segments_at(history, dim, 202230)
    scan = next(line for line in _plan(found).splitlines() if "FileScan" in line and "seg_desc" in line)
    assert "ubquery" in scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    with pytest.raises(Exception, match="no period"):
        segments_at(history, dim, 202130).collect()
