"""Functions of the method for use in SQL text."""

from pyspark.sql import SparkSession

#: CDF(end) - CDF(start) of an exponential law; the twin of :func:`exponential_window_probability`.
_WINDOW_PROBABILITY = """
CREATE OR REPLACE TEMPORARY FUNCTION window_probability(mean_days DOUBLE, start_days DOUBLE, end_days DOUBLE)
RETURNS DOUBLE
COMMENT 'Probability that a purchase falls between two numbers of days, under an exponential law of that mean'
RETURN CASE WHEN mean_days > 0
       THEN exp(-greatest(start_days, 0.0D) / mean_days) - exp(-greatest(end_days, 0.0D) / mean_days) END
"""


def register_functions(spark: SparkSession) -> None:
    """Make ``window_probability(mean_days, start_days, end_days)`` known to the session's SQL.

    It is a SQL-defined function: Catalyst puts its body into the calling plan, so it runs inside
    generated code like any built-in and starts no Python worker.
    """
    spark.sql(_WINDOW_PROBABILITY)
