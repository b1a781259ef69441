import datetime as dt
import tempfile

from audix import contracts as C
from audix.plans.workflows import (audience_split, export_audiences, purchase_propensity, rank_pool,
                                   spec_allocation)
from tests.conftest import rows

D = dt.date
TXN = ("household_id long, customer_id long, transaction_uid long, upc_id long, date_id date, week_id int, "
       "net_spend_amt long, pkg_weight_unit double, channel string")


def test_end_to_end_on_own_tables(spark):
    data = []
    for hh in range(1, 31):
        for k, upc in enumerate([1, 2] if hh % 3 == 0 else [1 + hh % 2]):
            data.append((hh, hh, hh * 10 + k, upc, D(2022, 1, 3 + hh % 20), 202201, 100 * hh + k, 1.0, "delivery"))
    data.append((99, None, 990, 1, D(2022, 1, 3), 202201, 10 ** 6, 1.0, "delivery"))   # no card: never allocated
    txn = spark.createDataFrame(data, TXN)
    groups = spark.createDataFrame([(1, "a"), (2, "b")], "upc_id long, gr_nm string")
    spec = spark.createDataFrame([("a", "A", 6), ("b", "B", 5)], "gr_nm string, ca_nm string, n_ca long")
    pool = rank_pool(txn, groups, 202201, 202201)
    alloc = spec_allocation(pool, spec)
    picks = alloc.picks
    counts = dict(rows(picks.groupBy(C.AUDIENCE).count()))
    assert counts == {"A": 6, "B": 5}
    assert 99 not in {r[0] for r in picks.select(C.HOUSEHOLD).collect()}

    segs = spark.createDataFrame([(h, "s") for h in range(1, 31, 2)], "household_id long, seg_desc string")
    split = audience_split(picks.select(C.HOUSEHOLD, C.AUDIENCE), segs, {"s": 0.5, C.SEGMENT_FILL_LABEL: 0.5},
                           group_col=C.AUDIENCE, salt="jan")
    assert split.count() == 11
    cust = spark.createDataFrame([(h, f"id{h}") for h in range(1, 31)], "household_id long, hashed_id string")
    out = export_audiences(split, cust, tempfile.mkdtemp(prefix="audix-export-") + "/lists", group_col=C.AUDIENCE)
    assert sum(r["n_rows"] for r in out.collect()) == 11


def test_purchase_propensity(spark):
    txn = spark.createDataFrame(
        [(1, 1, D(2022, 1, 1), 1.0), (1, 2, D(2022, 1, 11), 1.0), (1, 1, D(2022, 1, 21), 1.0)],
        "household_id long, upc_id long, date_id date, pkg_weight_unit double")
    dim = spark.createDataFrame([(1, 7), (2, 7), (3, 8)], "upc_id long, class_code int")
    targets = spark.createDataFrame([(1,)], "upc_id long")
    out = purchase_propensity(txn, dim, targets, "2022-01-25")
    r = out.collect()[0]
    assert r["cycle_days"] == 10.0 and r["days_to_start"] == 4


def test_waterfall_by_name_and_lazily_agree(spark):
    """run_waterfall returns the stages that the lazy run builds one by one."""
    from audix.plans import chains as K
    from audix.plans import specs as S
    from audix.plans.workflows import run_waterfall
    from audix.sources import fixtures
    sf = "/root/testdata/sf0.001"
    got = run_waterfall(fixtures.transactions(spark, sf), S.waterfall_groups(spark, sf), S.waterfall_spec(spark, sf))
    assert set(got) == {"exclusive", "sets", "both", "large_no_cold", "promo_medium_no_tea", "combined"}
    assert rows(got["combined"]) == rows(K.waterfall(spark, sf).combined)
    taken = [r[0] for r in got["combined"].select(C.HOUSEHOLD).collect()]
    assert taken and len(taken) == len(set(taken))
