import datetime as dt


from audix import contracts as C
from audix.operators.segment import attach_segment, last_date_of_week, period_of, segment_as_of
from audix.operators.snapshot import snapshot_profile, snapshot_txn
from tests.conftest import rows

D = dt.date


def _date_dim(spark, start=D(2022, 1, 1), days=400):
    out = []
    for i in range(days):
        d = start + dt.timedelta(days=i)
        iso = d.isocalendar()
        out.append((d, iso[0] * 100 + iso[1], d.year * 100 + d.month))
    return spark.createDataFrame(out, "date_id date, week_id int, period_id int")


def _txn(spark):
    data = [(1, 1, 10, D(2022, 1, 3), 202201, 100, "delivery"),
            (2, None, 11, D(2022, 1, 4), 202201, 50, "delivery"),      # no card: dropped
            (3, 3, 12, D(2022, 2, 1), 202205, 70, "pickup"),
            (4, 4, 13, D(2022, 3, 1), 202209, 20, "delivery")]          # outside the range
    return spark.createDataFrame(data, "household_id long, customer_id long, upc_id long, date_id date, "
                                       "week_id int, net_spend_amt long, channel string")


def test_snapshot_filters(spark):
    snap = snapshot_txn(_txn(spark), 202201, 202205)
    assert rows(snap, C.HOUSEHOLD) == [(1,), (3,)]
    assert rows(snapshot_txn(_txn(spark), 202201, 202205, channel="delivery"), C.HOUSEHOLD) == [(1,)]


def test_snapshot_profile_fills_label(spark):
    seg = spark.createDataFrame([(1, "A")], "household_id long, seg_desc string")
    prof = snapshot_profile(snapshot_txn(_txn(spark), 202201, 202205), seg)
    got = {r[C.SEGMENT]: (r["n_lines"], r["n_households"], r["spend"]) for r in prof.collect()}
    assert got == {"A": (1, 1, 100), C.SEGMENT_FILL_LABEL: (1, 1, 70)}


def test_calendar_lookups(spark):
    dim = _date_dim(spark)
    assert last_date_of_week(dim, 202201) == D(2022, 1, 9)
    assert period_of(dim, "2022-07-15", 180) == 202201


def _history(spark, periods):
    return spark.createDataFrame([(h, f"seg{p % 3}", p) for h in (1, 2) for p in periods],
                                 "household_id long, seg_desc string, period_id int")


def test_segment_falls_back_to_latest_published(spark):
    dim = _date_dim(spark)
    hist = _history(spark, [202203, 202204, 202205])          # 202207 not published yet
    seg, period = segment_as_of(hist, dim, "2022-07-20")
    assert period == 202205
    assert rows(seg) == [(1, "seg2"), (2, "seg2")]


def test_segment_uses_current_when_published(spark):
    dim = _date_dim(spark)
    hist = _history(spark, [202201, 202206, 202207, 202208])
    seg, period = segment_as_of(hist, dim, "2022-07-20")
    assert period == 202207


def test_attach_segment_left_fills_and_inner_drops(spark):
    seg = spark.createDataFrame([(1, "A"), (2, None)], "household_id long, seg_desc string")
    alloc = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "household_id long, gr_nm string")
    left = attach_segment(alloc, seg)
    assert rows(left, C.HOUSEHOLD, C.SEGMENT) == [(1, "A"), (2, C.SEGMENT_FILL_LABEL), (3, C.SEGMENT_FILL_LABEL)]
    assert rows(attach_segment(alloc, seg, "inner"), C.HOUSEHOLD) == [(1,), (2,)]


def test_calendar_gap_is_named(spark):
    import pytest
    dim = _date_dim(spark, D(2022, 3, 1), 60)
    history = _history(spark, [202203])
    with pytest.raises(ValueError, match="2021-10-02"):
        segment_as_of(history, dim, "2022-03-31")
    with pytest.raises(ValueError, match="2023-01-01"):
        period_of(dim, "2023-01-01")
