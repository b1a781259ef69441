"""Cardinalities of the fixture chains, as checked in FIXTURES.md (sf0.001)."""

import os

import pytest
from pyspark.sql import functions as F

from audix import contracts as C
from audix.plans import chains as K

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_pool_sizes(spark):
    pool = K.pool(spark, SF)
    sizes = {r[0]: r[1] for r in pool.groupBy(C.GROUP_COUNT).count().collect()}
    assert sum(sizes.values()) > 0 and set(sizes) <= {1, 2, 3, 4}


def test_waterfall_stage_counts(spark):
    wf = K.waterfall(spark, SF)
    quota = wf.spec.exclusive_quota["tea"]
    per_drink = {r[0]: r[1] for r in wf.exclusive.groupBy(C.GROUP).count().collect()}
    assert per_drink and all(n <= quota for n in per_drink.values())
    for i, st in enumerate(wf.spec.departments):
        assert wf.department(i).count() == min(st.quota, wf.department_candidates(i).count())
    combined = wf.combined
    assert combined.count() == combined.select(C.HOUSEHOLD).distinct().count()


def test_cycle_households(spark):
    gaps = K.gaps(spark, SF)
    snap = K.full_snapshot(spark, SF).join(K.class_products(spark, SF), C.PRODUCT)
    days = snap.select(C.HOUSEHOLD, C.DATE).distinct().groupBy(C.HOUSEHOLD).count()
    assert gaps.select(C.HOUSEHOLD).distinct().count() == days.where("count >= 2").count()
    assert gaps.where(F.col("gap_before").isNotNull()).select(C.HOUSEHOLD).distinct().count() == days.where("count >= 3").count()
