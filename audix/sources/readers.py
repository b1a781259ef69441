"""Readers for tables, spec files and folders of parts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Parquet (or any format Spark knows) scan; filters and projections
    applied later are pushed into the scan by Catalyst."""
    return spark.read.format(fmt).load(path)


def read_catalog(spark: SparkSession, name: str) -> DataFrame:
    """A table of the session catalog (dimension or history tables)."""
    return spark.table(name)


def read_spec_csv(spark: SparkSession, path: str, schema: StructType | str,
                  json_arrays: Sequence[str] = ()) -> DataFrame:
    """A user spec in CSV with a header, read with an explicit schema.

    No type inference: inference would turn a key like "007" into 7 and
    costs an extra pass over the file. Columns in ``json_arrays`` hold a JSON
    list of strings (e.g. a group set ``["a","b"]``) and are parsed to
    ``array<string>``.
    """
    df = spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)
    for c in json_arrays:
        df = df.withColumn(c, F.from_json(F.col(c), "array<string>"))
    return df


def read_many(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None,
              fmt: str = "parquet") -> DataFrame:
    """Read several tables written with different column sets as one.

    ``paths`` is a folder of tables (optionally only those whose folder name
    matches ``glob``, e.g. ``"gr_nm_sales*"``) or a list of tables. One load
    with schemas merged by column name: columns missing in one table come back as nulls.
    """
    reader = spark.read.format(fmt).option("mergeSchema", True)
    if not isinstance(paths, str):
        return reader.load(list(paths))
    if glob:
        return reader.load(f"{paths.rstrip('/')}/{glob}")
    return reader.option("recursiveFileLookup", True).load(paths)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """n-ary union by column name, tolerant of missing columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def spec_frame(spark: SparkSession, rows: Sequence, schema: StructType | str) -> DataFrame:
    """A literal relation (a spec of a few rows) with an explicit schema.

    It is a local relation, whose size the planner knows: a join with a large side broadcasts it from
    the start, while rows handed over as an RDD count as huge and shuffle both sides first.
    """
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    table = pa.Table.from_pylist([dict(zip(kind.names, r)) for r in rows], schema=to_arrow_schema(kind))
    return spark.createDataFrame(table, kind)


def file_row_counts(df: DataFrame) -> DataFrame:
    """Rows per input file, in one scan."""
    return df.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))
