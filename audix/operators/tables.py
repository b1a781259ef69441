"""Operators on whole tables: set difference, reconciliation of two tables, pivot over data values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TAG = "_in_right"


def _comparable(col: Column, kind: T.DataType) -> Column:
    """``col`` in a form that rows can be grouped by: maps as entries sorted by key, at any depth."""
    if isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(col), lambda e: F.struct(e["key"].alias("key"), _comparable(e["value"], kind.valueType).alias("value")))
        return F.array_sort(entries)
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda x: _comparable(x, kind.elementType)) if _has_map(kind) else col
    if isinstance(kind, T.StructType) and _has_map(kind):
        fields = F.struct(*[_comparable(col[f.name], f.dataType).alias(f.name) for f in kind.fields])
        return F.when(col.isNotNull(), fields)
    return col


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, T.StructType) and any(_has_map(f.dataType) for f in kind.fields)


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """The distinct rows of ``left`` that are not rows of ``right`` (EXCEPT DISTINCT).

    Columns are matched by name. Nulls equal nulls, repeats count once, and columns may be arrays or maps (two maps are
    equal when they hold the same entries), which ``subtract`` refuses. Both sides are tagged, put together and
    reduced by one aggregate, map-side first, so a row repeated any number of times is one row per task in the shuffle.
    """
    names = left.columns
    both = left.withColumn(_TAG, F.lit(0)).unionByName(right.select(*[f"`{n}`" for n in names]).withColumn(_TAG, F.lit(1)))
    keys = [_comparable(F.col(f"`{f.name}`"), f.dataType).alias(f"_k{i}") for i, f in enumerate(both.schema.fields[:-1])]
    mapped = [f.name for f in both.schema.fields[:-1] if _has_map(f.dataType)]
    rows = both.select(*keys, *[F.col(f"`{n}`").alias(f"_v{names.index(n)}") for n in mapped], _TAG)
    found = rows.groupBy(*[f"_k{i}" for i in range(len(names))]).agg(
        F.max(_TAG).alias(_TAG), *[F.first(f"_v{names.index(n)}").alias(f"_v{names.index(n)}") for n in mapped])
    return found.where(F.col(_TAG) == 0).select(
        *[F.col(f"_v{i}" if n in mapped else f"_k{i}").alias(n) for i, n in enumerate(names)])


def reconcile(left: DataFrame, right: DataFrame, on: Sequence[str], source: str = "found_in") -> DataFrame:
    """Full outer join of two tables on ``on`` (nulls match nulls), with a column that says where a key was found:
    ``both``, ``left`` or ``right``. Other columns of the same name get the suffixes ``_left`` and ``_right``."""
    on = list(on)
    shared = (set(left.columns) & set(right.columns)) - set(on)

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[F.col(f"`{c}`").alias(f"_{name}_{c}") for c in on],
                         *[F.col(f"`{c}`").alias(f"{c}_{name}" if c in shared else c) for c in df.columns if c not in on],
                         F.lit(True).alias(f"_{name}"))

    a, b = side(left, "left"), side(right, "right")
    same = F.lit(True)
    for c in on:
        same = same & F.col(f"`_left_{c}`").eqNullSafe(F.col(f"`_right_{c}`"))
    out = a.join(b, same, "full_outer")
    where = F.when(F.col("_left") & F.col("_right"), "both").when(F.col("_left"), "left").otherwise("right")
    own = [c for df in (a, b) for c in df.columns if c not in ("_left", "_right") and c not in {f"_{s}_{k}" for s in ("left", "right") for k in on}]
    keys = [F.when(F.col("_left"), F.col(f"`_left_{c}`")).otherwise(F.col(f"`_right_{c}`")).alias(c) for c in on]
    return out.select(*keys, *[F.col(f"`{c}`") for c in own], where.alias(source))


def pivot_values(df: DataFrame, by: Sequence[str], pivot_col: str, value: Column, values: Sequence | None = None,
                 max_values: int = 100, prefix: str = "") -> DataFrame:
    """One row per ``by`` and one column per value of ``pivot_col``: the sum of ``value`` (null where there is none).

    Without ``values`` the values are found in the data, in order, and more than ``max_values`` are an error
    (a table has a bounded number of columns). Given values always have their column, whether they occur or not, and
    others are left out. Nulls have no column. Conditional sums in one aggregate, combined inside each task first.
    """
    if values is None:
        found = [r[0] for r in df.select(pivot_col).where(F.col(pivot_col).isNotNull()).distinct().limit(max_values + 1).collect()]
        if len(found) > max_values:
            raise ValueError(f"{pivot_col} has more than {max_values} values")
        values = sorted(found)
    sums = [F.sum(F.when(F.col(pivot_col) == F.lit(v), value)).alias(f"{prefix}{v}") for v in values]
    return df.groupBy(*by).agg(*sums) if sums else df.select(*by).distinct()
