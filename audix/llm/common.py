"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import functools
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from audix.session import stage_path

#: Java pattern of the white space that separates words: blank, tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage at a point that survives the loss of an executor and
    keeps a costly step from being computed twice.
    """
    path = stage_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, for ``mapInArrow``, so that memory Arrow has no more use for goes back to the system.

    Arrow's pool otherwise keeps what batches took. Python workers outlive their task, so that
    an executor's idle workers would hold it through the stages that follow.
    """
    @functools.wraps(run)
    def released(batches):
        pool = pa.default_memory_pool()

        def given():
            for batch in batches:
                yield batch
                pool.release_unused()

        try:
            yield from run(given())
        finally:
            pool.release_unused()

    return released


def literal_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small driver-side list as a relation without Python or RDD nodes."""
    js = json.dumps(rows).replace("\\", "\\\\").replace("'", "\\'")
    return spark.sql(f"SELECT inline(from_json('{js}', 'array<struct<{schema}>>'))")


def quoted(name: str) -> str:
    """A column name as Spark reads it whole, dots and all."""
    return "`" + name.replace("`", "``") + "`"


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z only; every other character stays."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(col: Column) -> Column:
    """Words of a text (null: none)."""
    parts = F.split(F.coalesce(col, F.lit("")), SPACE, -1)
    return F.filter(parts, lambda w: w != "")


#: Any constant; see :func:`join_counted`.
_FLIP = 0x2545F4914F6CDD1D


def join_counted(rows: DataFrame, counted: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` with ``counted``, an aggregate of theirs by the 64-bit column ``key``.

    The key is replaced one to one on both sides for the join. The aggregate's
    partitioning then does not serve the join, both sides are shuffled for it,
    and adaptive execution can split a key that many rows share, which it
    cannot while the aggregation ends in the join's own stage.
    """
    def flipped(df: DataFrame) -> DataFrame:
        return df.withColumn(key, F.col(key).bitwiseXOR(F.lit(_FLIP)))

    return flipped(flipped(rows).join(flipped(counted), key, how))
