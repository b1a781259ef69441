"""Ordered reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ordered(report: DataFrame, *keys: str) -> DataFrame:
    """A report sorted for reading: ``"n_gr"`` ascending, ``"-n_households"``
    descending; nulls come last either way."""
    return report.orderBy(*(F.col(k[1:]).desc_nulls_last() if k.startswith("-") else F.col(k).asc_nulls_last()
                            for k in keys))
