"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from audix.session import stage_path


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, **options) -> str:
    """Write a table. ``fmt`` may be any format on the classpath (Parquet by
    default); ``partition_by`` lays out one folder per key value."""
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def stage_table(df: DataFrame, name: str, fmt: str = "parquet",
                partition_by: Sequence[str] | None = None) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared checkpoint folder and read
    it back: the lineage is cut and the table survives lost executors.
    ``partition_by`` lays it out by key so later filters prune folders."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    write_table(df, path, fmt=fmt, partition_by=partition_by)
    return spark.read.format(fmt).load(path)


def stage_bucketed(df: DataFrame, name: str, by: str, buckets: int | None = None) -> DataFrame:
    """Like :func:`stage_table`, stored in buckets of ``by`` (sorted inside; one file each).

    Aggregates and joins by that column read it in place, without an exchange. The table is known to the session's
    catalog under a fresh name, its files lie under the shared checkpoint folder. Key nulls meet in one bucket.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = stage_path(spark, name)
    table = "audix_" + "".join(c if c.isalnum() else "_" for c in path.rsplit("/", 1)[-1])
    (df.repartition(n, by).write.format("parquet").bucketBy(n, by).sortBy(by).option("path", path).saveAsTable(table))
    return spark.table(table)
