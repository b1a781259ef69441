"""Calendar keys as Column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_week_id(date: Column) -> Column:
    """ISO year * 100 + ISO week, e.g. 2000-01-01 -> 199952."""
    return (F.extract(F.lit("YEAROFWEEK"), date) * 100 + F.weekofyear(date)).cast("int")


def month_period_id(date: Column) -> Column:
    """Calendar year * 100 + month."""
    return (F.year(date) * 100 + F.month(date)).cast("int")
