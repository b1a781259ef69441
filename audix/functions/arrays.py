"""Stable text forms of arrays and maps (for reports and hashing)."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def sorted_join(arr: Column, sep: str = ",") -> Column:
    return F.array_join(F.sort_array(arr), sep)


def map_to_string(m: Column, sep: str = ",") -> Column:
    """'k1:v1,k2:v2' with keys in ascending order."""
    entries = F.sort_array(F.map_entries(m))
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), sep)
