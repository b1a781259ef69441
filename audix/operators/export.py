"""Export of one id list per audience and arm, and its read-back check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audix import contracts as C
from audix.sources.readers import spec_frame

#: Rows of a list that go to one file.
ROWS_PER_FILE = 5_000_000


def export_lists(df: DataFrame, path: str, group_col: str = C.GROUP, arm_col: str = C.ARM,
                 id_col: str = C.HASHED_ID, rows_per_file: int = ROWS_PER_FILE) -> str:
    """Write ``id_col`` as CSV with a header into ``path/<group>=<g>/<arm>=<a>/``.

    One job for all lists. Rows without an id have nothing to export and are
    left out here; :func:`export_counts` reports them per list. A list is
    spread by a hash of the id over as many files as its rows need, so a large
    audience is written by several tasks. Stage ``df`` first if it is costly: its lists are
    counted before they are written. The numbers of files, one for each list, come back as a local relation, so
    the rows meet them where they are.
    """
    lists = df.where(F.col(id_col).isNotNull()).select(group_col, arm_col, id_col)
    held = lists.groupBy(group_col, arm_col).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).alias("_files"))
    files = spec_frame(df.sparkSession, [tuple(r) for r in held.collect()], held.schema)
    placed = lists.join(files, [group_col, arm_col]).withColumn("_file", F.pmod(F.xxhash64(id_col), F.col("_files")))
    (placed.repartition(group_col, arm_col, "_file").select(group_col, arm_col, id_col)
     .write.mode("overwrite").partitionBy(group_col, arm_col).option("header", True).csv(path))
    return path


def expected_lists(df: DataFrame, group_col: str = C.GROUP, arm_col: str = C.ARM,
                   id_col: str = C.HASHED_ID) -> DataFrame:
    """Every audience with both arms, the households of each list and those without an id."""
    arms = F.array(F.lit(C.ARM_TEST), F.lit(C.ARM_CONTROL))
    lists = df.select(group_col).distinct().select(group_col, F.explode(arms).alias(arm_col))
    held = df.groupBy(group_col, arm_col).agg(
        F.count(F.lit(1)).alias("n_households"),
        F.sum(F.when(F.col(id_col).isNull(), 1).otherwise(0)).alias("n_without_id"))
    return lists.join(held, [group_col, arm_col], "left").fillna(0, subset=["n_households", "n_without_id"])


def export_counts(df: DataFrame, path: str, group_col: str = C.GROUP, arm_col: str = C.ARM,
                  id_col: str = C.HASHED_ID) -> DataFrame:
    """Rows and files of each exported list beside what ``df`` holds for it.

    The files are read back in one scan with an explicit schema, so list
    names such as ``007`` stay text; lists without rows count 0.
    """
    schema = f"`{id_col}` string, `{group_col}` string, `{arm_col}` string"
    back = (df.sparkSession.read.schema(schema).option("header", True).option("basePath", path).csv(path)
            .withColumn("_file", F.input_file_name()))
    found = back.groupBy(group_col, arm_col).agg(F.count(F.lit(1)).alias("n_rows"),
                                                 F.countDistinct("_file").alias("n_files"))
    return (expected_lists(df, group_col, arm_col, id_col).join(found, [group_col, arm_col], "left")
            .fillna(0, subset=["n_rows", "n_files"]))
