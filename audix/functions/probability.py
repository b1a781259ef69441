"""Probability of a purchase inside a campaign window."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def exponential_window_probability(mean_days: Column, start_days: Column, end_days: Column) -> Column:
    """CDF(end) - CDF(start) of an exponential law with the given mean.

    CDF(x) = 1 - exp(-x / mean) for x >= 0 and 0 below, so the difference is
    exp(-max(start, 0) / mean) - exp(-max(end, 0) / mean). Null when the
    mean is null or not positive.
    """
    s = F.greatest(start_days.cast("double"), F.lit(0.0))
    e = F.greatest(end_days.cast("double"), F.lit(0.0))
    m = mean_days.cast("double")
    return F.when(m > 0, F.exp(-s / m) - F.exp(-e / m))
