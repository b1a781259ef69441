"""Exact money arithmetic.

Sums of doubles depend on the order of addition, which depends on the
partitioning; a rank built on such a sum could flip between runs. Amounts are
therefore carried as integers of 1/10000 currency units and turned into a
double only for display.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 10000


def exact_line_spend(price: Column, discount: Column) -> Column:
    """price * (1 - discount) as a bigint in 1/10000 units."""
    cents = F.round(price * 100).cast("bigint")
    keep = F.lit(100) - F.round(discount * 100).cast("bigint")
    return cents * keep


def spend_to_double(amount: Column) -> Column:
    return amount.cast("double") / SCALE
