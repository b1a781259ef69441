"""Views of the driver's test tables in the shape the operators expect.

household = o_custkey, visit = o_orderkey, product = l_partkey,
date = order date, channel from the order priority, spend exact in 1/10000
units, units = l_quantity. The same expressions are used by the SQL twins.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from audix import contracts as C
from audix.functions import exact_line_spend, hashed_id, iso_week_id, month_period_id
from audix.sources.sinks import stage_table

# Fixed values of the fixture mapping.
CHANNEL_BY_PRIORITY = {"1-URGENT": C.CHANNEL_DELIVERY, "2-HIGH": C.CHANNEL_PICKUP}
OTHER_CHANNEL = "store"
SEGMENT_GAP_MODULUS = 7          # households with custkey % 7 == 0 have no segment
NO_CARD_MODULUS = 13             # lines of households with custkey % 13 == 0 have no card
SEGMENT_PERIODS = 3              # periods that each household's history covers
SEGMENT_LABELS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PUBLISHED_LAG_MONTHS = 2         # segments are published two months behind the data


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _channel(priority):
    expr = F.lit(OTHER_CHANNEL)
    for key, label in reversed(list(CHANNEL_BY_PRIORITY.items())):
        expr = F.when(priority == key, F.lit(label)).otherwise(expr)
    return expr


def transactions(spark: SparkSession, sf_dir: str, dates: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """Transaction lines: one row per order line. ``dates`` (first and last
    day) is a filter on the physical column, so it reaches the Parquet scan."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    if dates is not None:
        lo, hi = (F.lit(d).cast(orders.schema["o_orderdate"].dataType) for d in (dates[0], dates[1] + dt.timedelta(days=1)))
        orders = orders.where((F.col("o_orderdate") >= lo) & (F.col("o_orderdate") < hi))
    date = F.col("o_orderdate").cast("date")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias(C.HOUSEHOLD),
        F.when(F.col("o_custkey") % NO_CARD_MODULUS != 0, F.col("o_custkey")).alias(C.CUSTOMER),
        F.col("o_orderkey").alias(C.TRANSACTION),
        F.col("l_partkey").alias(C.PRODUCT),
        date.alias(C.DATE),
        iso_week_id(date).alias(C.WEEK),
        month_period_id(date).alias(C.PERIOD),
        exact_line_spend(F.col("l_extendedprice"), F.col("l_discount")).alias(C.SPEND),
        F.col("l_quantity").alias(C.UNITS),
        _channel(F.col("o_orderpriority")).alias(C.CHANNEL),
    )


_calendars: dict[tuple[str, str], DataFrame] = {}


def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar: every day between the first and the last order date, staged
    once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _calendars:
        days = (table(spark, sf_dir, "orders")
                .agg(F.min(F.col("o_orderdate").cast("date")).alias("lo"),
                     F.max(F.col("o_orderdate").cast("date")).alias("hi"))
                .select(F.explode(F.sequence("lo", "hi")).alias(C.DATE)))
        _calendars[key] = stage_table(days.select(C.DATE, iso_week_id(F.col(C.DATE)).alias(C.WEEK),
                                                  month_period_id(F.col(C.DATE)).alias(C.PERIOD)), "calendar")
    return _calendars[key]


def segment_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment history: every segmented household in the last published
    periods (the newest lies two months before the last data month), with a label
    that changes from period to period."""
    last = date_dim(spark, sf_dir).agg(F.add_months(F.max(C.DATE), -PUBLISHED_LAG_MONTHS)).scalar()
    labels = F.array(*[F.lit(x) for x in SEGMENT_LABELS])
    key, period = F.col("c_custkey"), F.col(C.PERIOD)
    label = F.get(labels, ((key + period) % len(SEGMENT_LABELS)).cast("int"))
    return (table(spark, sf_dir, "customer").where(key % SEGMENT_GAP_MODULUS != 0)
            .select(key, F.explode(F.array(*[F.lit(k) for k in range(SEGMENT_PERIODS)])).alias("_back"))
            .select(key, month_period_id(F.add_months(last, -F.col("_back"))).alias(C.PERIOD))
            .select(key.alias(C.HOUSEHOLD), label.alias(C.SEGMENT), C.PERIOD))


def prod_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias(C.PRODUCT),
        F.col("p_type").alias("department_name"),
        F.col("p_brand").alias("section_name"),
        F.col("p_size").alias("class_code"),
        F.concat(F.lit("class_"), F.col("p_size").cast("string")).alias("class_name"),
    )


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias(C.HOUSEHOLD), hashed_id(F.col("c_name")).alias(C.HASHED_ID))
