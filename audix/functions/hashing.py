"""Deterministic hashing shared with any SQL engine that has md5 / sha2."""

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 2 ** 32


def unit_bucket(key: Column, salt: str = "") -> Column:
    """An integer in [0, 2^32) from the first 8 hex digits of md5(key || ':' || salt).

    It does not depend on partitioning or on the run, so an arm drawn from it
    is the same after a retry or on another cluster.
    """
    text = F.concat(key.cast("string"), F.lit(":" + salt))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hashed_id(value: Column) -> Column:
    """Hex sha-256 of a text id."""
    return F.sha2(value.cast("string"), 256)
