"""Spec files with their rejects.

A spec is written by hand, so some rows are wrong. :func:`read_spec_checked` splits a CSV into the rows that can be
used and a table of rejects, each with its reason and the line as it stands in the file, instead of turning bad cells to null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

_BAD = "_line"


def read_spec_checked(spark: SparkSession, path: str, schema: StructType | str, key: Sequence[str] = (),
                      required: Sequence[str] = (), checks: Mapping[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a CSV spec with a header.

    Reasons, the first that holds: ``malformed`` (a cell does not fit its type, or the line has another number of cells),
    ``missing <column>`` (null or blank in ``required``), the name of a condition in ``checks`` that is not true, and ``duplicate`` (the
    ``key`` occurs in more than one otherwise good row; none of them is used, since nobody can tell which was meant).
    Rejects have the columns ``reason``, ``line`` (only of malformed rows) and those of the spec.
    """
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    read = StructType([*kind.fields, StructField(_BAD, StringType())])
    rows = (spark.read.schema(read).option("header", True).option("escape", '"').option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", _BAD).csv(path))
    # All columns are read, for a parser that is asked for fewer looks at fewer cells.
    reason = F.when(F.col(_BAD).isNotNull(), F.lit("malformed"))
    for c in required:
        reason = reason.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), F.lit(f"missing {c}"))
    for name, holds in (checks or {}).items():
        reason = reason.when(~F.coalesce(holds, F.lit(False)), F.lit(name))
    judged = rows.withColumn("reason", reason)
    if key:
        same = Window.partitionBy(*key, F.col("reason").isNull())
        copies = F.when(F.col("reason").isNull() & (F.count(F.lit(1)).over(same) > 1), F.lit("duplicate"))
        judged = judged.withColumn("reason", F.coalesce("reason", copies))
    names = kind.fieldNames()
    return (judged.where(F.col("reason").isNull()).select(*names),
            judged.where(F.col("reason").isNotNull()).select("reason", F.col(_BAD).alias("line"), *names))
