"""Exact quantiles by counting passes.

Numbering all rows for the sake of one of them sorts the whole column. Here a pass counts rows in
``RANGES`` equal ranges between two bounds and the range that holds the wanted place becomes the
bounds of the next pass, until the range holds one value or few rows. A pass is one aggregate without a sort, and
its counts are all that leaves the executors; their number does not depend on the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANGES = 4096
#: Rows that are put in order by one task in the end.
FEW = 10_000


def exact_quantile(df: DataFrame, col: str, q: float = 0.5, ranges: int = RANGES, few: int = FEW) -> float | None:
    """The least value that at least a share ``q`` of the non-null values do not exceed (None: no values).

    ``col`` is numeric; NaN is not a value. ``df`` is read once per pass: stage it first if it is costly.
    """
    v = F.col(col).cast("double")
    rows = df.where(v.isNotNull() & ~F.isnan(v)).select(v.alias("_v"))
    lo, hi, n = rows.agg(F.min("_v"), F.max("_v"), F.count(F.lit(1))).first()
    if not n:
        return None
    place = max(1, math.ceil(q * n))
    while lo < hi and n > few:
        width = hi / ranges - lo / ranges
        at = F.least(F.floor((F.col("_v") - lo) / width).cast("int"), F.lit(ranges - 1)) if width > 0 else F.lit(0)
        inside = rows.where(F.col("_v").between(lo, hi))
        counts = sorted(inside.groupBy(at.alias("at")).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")).collect())
        for r in counts:
            if place <= r["n"]:
                break
            place -= r["n"]
        if (r["lo"], r["hi"], r["n"]) == (lo, hi, n):  # the values lie closer than doubles divide
            break
        lo, hi, n = r["lo"], r["hi"], r["n"]
    if lo == hi:
        return lo
    seen = 0  # few rows, or few neighbouring doubles: their counts in order
    for r in rows.where(F.col("_v").between(lo, hi)).groupBy("_v").count().orderBy("_v").collect():
        seen += r["count"]
        if seen >= place:
            return r["_v"]
    return hi
