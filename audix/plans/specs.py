"""Fixture specs over the driver's test tables: product groups, quotas and
parameters of each chain. The SQL twins in ``oracle.py`` restate them.

Quotas scale with the customer base: ``base * customers // 1500`` (1500 is
the customer count at sf0.01), so the same spec does the same work at every
scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from audix.operators.groups import product_groups
from audix.plans.workflows import DepartmentStage, WaterfallSpec
from audix.sources import fixtures
from audix.sources.readers import spec_frame

QUOTA_BASE_CUSTOMERS = 1500

# Chain A: groups = brand of ECONOMY parts, Brand#1..#4; one audience each.
POOL_BRANDS = ["Brand#1", "Brand#2", "Brand#3", "Brand#4"]
# Thirteen audiences; several share a group, each is on one row.
ALLOC_SPEC_BASE = [("Brand#1", "ca_01", 40), ("Brand#2", "ca_02", 110), ("Brand#3", "ca_03", 60), ("Brand#4", "ca_04", 90),
                   ("Brand#1", "ca_05", 25), ("Brand#2", "ca_06", 70), ("Brand#3", "ca_07", 85), ("Brand#4", "ca_08", 30),
                   ("Brand#2", "ca_09", 55), ("Brand#3", "ca_10", 20), ("Brand#4", "ca_11", 75), ("Brand#1", "ca_12", 35),
                   ("Brand#4", "ca_13", 45)]
AUDIENCE_SETS = [("ca_x", ["Brand#1", "Brand#2"]), ("ca_y", ["Brand#3"]), ("ca_z", ["Brand#2", "Brand#4"])]
FREQ_GROUPS = ["Brand#1", "Brand#2"]
FREQ_DROP = ["Brand#2_multitimes"]
DELIVERY_GROUP = "Brand#3"
PLAIN_GROUP = "Brand#4"
TOPK_START_WEEK, TOPK_END_WEEK = 199901, 200026
TOPK_PER_GROUP = 25
REACH_RANGES = {"first": (199801, 200026), "second": (199927, 200152)}     # overlapping week ranges
RANK_PARITY = 2
SPEC_AUDIENCES = 40
DRILL_GROUP, DRILL_RANK = "Brand#2", 5

# Chain B: a drinks campaign. Listed products by (type, brand), departments by rule.
LISTED_GROUPS = [("PROMO", "Brand#5", "tea"), ("PROMO", "Brand#6", "coffee"), ("PROMO", "Brand#7", "cocoa"),
                 ("PROMO", "Brand#8", "juice"), ("PROMO", "Brand#9", "soda"),
                 ("STANDARD", "Brand#1", "snacks"), ("STANDARD", "Brand#3", "snacks"), ("ECONOMY", "Brand#5", "bakery")]
DRINKS = ["tea", "coffee", "cocoa", "juice", "soda"]
SUPER_GROUPS = {"tea": "hot", "coffee": "hot", "cocoa": "sweet", "juice": "cold", "soda": "cold"}
SET_MAPPING = [(["hot"], "hot"), (["cold"], "cold"), (["sweet", "hot"], "sweet"), (["cold", "sweet", "hot"], "cold")]
SNACKERS, SNACKERS_LABEL = ["snacks", "bakery"], "snackers"
SHELVES = [(["shelf_large"], ["juice", "soda"], "large_no_cold", 8),
           (["shelf_promo", "shelf_medium"], ["tea"], "promo_medium_no_tea", 15)]   # quota in units of the first
DRINK_BASE, SUPER_BASE = 24, 36    # quota per drink, per super-group
NO_CONTROL = ["hot", "cocoa", "snackers"]
CUT_TAIL_WIDTH = 10
SALT = "drinks-2001"
NO_ID_MODULUS = 11                # households with custkey % 11 == 0 have no hashed id
EXPORT_NAMES = {"tea": "007", "coffee": "7"}      # list names that must stay text
SEGMENT_LABELS = fixtures.SEGMENT_LABELS
SNAP_PROFILE_CHANNEL = "delivery"

# Chain C: target products SMALL and MEDIUM parts of size <= 5, expanded to
# their class (size); the two types cover every size 1..5 at every scale
# factor, so the expanded class is all parts of size <= 5.
CYCLE_TYPES, CYCLE_MAX_SIZE = ["SMALL", "MEDIUM"], 5
CAMPAIGN_START = "2001-07-01"


def customers(spark: SparkSession, sf_dir: str) -> int:
    return fixtures.table(spark, sf_dir, "customer").count()


def scaled(base: int, n_customers: int) -> int:
    return base * n_customers // QUOTA_BASE_CUSTOMERS


def pool_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (fixtures.table(spark, sf_dir, "part")
            .where((F.col("p_type") == "ECONOMY") & F.col("p_brand").isin(POOL_BRANDS))
            .select(F.col("p_partkey").alias("upc_id"), F.col("p_brand").alias("gr_nm")))


def alloc_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = customers(spark, sf_dir)
    return spec_frame(spark, [(g, ca, scaled(b, n)) for g, ca, b in ALLOC_SPEC_BASE], "gr_nm string, ca_nm string, n_ca long")


def audience_sets(spark: SparkSession) -> DataFrame:
    return spec_frame(spark, AUDIENCE_SETS, "ca_nm string, ca_gr_set array<string>")


def waterfall_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed groups unioned with the shelf rules."""
    part = fixtures.table(spark, sf_dir, "part")
    listing = spec_frame(spark, LISTED_GROUPS, "p_type string, p_brand string, gr_nm string")
    listed = part.join(listing, ["p_type", "p_brand"]).select(F.col("p_partkey").alias("upc_id"), "gr_nm")
    dim = fixtures.prod_dim(spark, sf_dir)
    rules = {
        "shelf_promo": F.col("department_name") == "PROMO",
        "shelf_medium": (F.col("department_name") == "MEDIUM") & (F.col("section_name") < "Brand#3"),
        "shelf_large": F.col("department_name").isin("LARGE", "PROMO") & (F.col("class_code") % 3 == 0),
    }
    return product_groups(listed, dim, rules)


def waterfall_spec(spark: SparkSession, sf_dir: str) -> WaterfallSpec:
    n = customers(spark, sf_dir)
    drink = scaled(DRINK_BASE, n)
    return WaterfallSpec(
        family=DRINKS, exclusive_quota={g: drink for g in DRINKS}, super_groups=SUPER_GROUPS,
        set_mapping=SET_MAPPING, super_quota={g: scaled(SUPER_BASE, n) for g in ("hot", "cold", "sweet")},
        both=SNACKERS, both_label=SNACKERS_LABEL,
        departments=[DepartmentStage(d, x, label, k * drink) for d, x, label, k in SHELVES])


def cycle_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (fixtures.prod_dim(spark, sf_dir)
            .where(F.col("department_name").isin(CYCLE_TYPES) & (F.col("class_code") <= CYCLE_MAX_SIZE))
            .select("upc_id"))
