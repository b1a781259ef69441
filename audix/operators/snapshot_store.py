"""A stored snapshot that is refreshed week by week.

The table has one folder per week (``week_id``). A refresh replaces the weeks it is given and leaves the
files of every other week alone (dynamic partition overwrite), so a weekly run writes one week and not the
history; running it again gives the same table. Inside a week lines are spread over
``files_per_week`` files by a hash of the household, so a week is never one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from audix import contracts as C
from audix.operators.snapshot import snapshot_txn


def refresh_snapshot(txn: DataFrame, path: str, weeks: Sequence[int], channel: str | Sequence[str] | None = None,
                     files_per_week: int = 8) -> str:
    """Replace ``weeks`` of the snapshot at ``path`` with the card holders' lines of ``txn``.

    A given week without lines (any more) ends up empty. The first call makes the table.
    """
    weeks = sorted({int(w) for w in weeks})
    if not weeks:
        return path
    spark = txn.sparkSession
    try:
        before = {r[0] for r in read_snapshot(spark, path, weeks[0], weeks[-1]).select(C.WEEK).distinct().collect()}
    except AnalysisException:  # no table yet
        before = set()
    written = Observation()
    lines = (snapshot_txn(txn, weeks[0], weeks[-1], channel).where(F.col(C.WEEK).isin(weeks))
             .observe(written, F.collect_set(C.WEEK).alias("weeks")))
    spread = F.pmod(F.xxhash64(C.HOUSEHOLD), F.lit(files_per_week))
    (lines.repartition(len(weeks) * files_per_week, C.WEEK, spread)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(C.WEEK).parquet(path))
    # Spark replaces the folders of weeks that have lines; a week that lost all of them is replaced by an empty file.
    for w in sorted((before & set(weeks)) - set(written.get["weeks"])):
        spark.createDataFrame([], lines.drop(C.WEEK).schema).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{C.WEEK}={w}")
    return path


def read_snapshot(spark: SparkSession, path: str, start_week: int | None = None, end_week: int | None = None) -> DataFrame:
    """The stored lines of a week range; only the folders of its weeks are listed and read."""
    df = spark.read.parquet(path)
    if start_week is not None:
        df = df.where(F.col(C.WEEK) >= int(start_week))
    if end_week is not None:
        df = df.where(F.col(C.WEEK) <= int(end_week))
    return df
