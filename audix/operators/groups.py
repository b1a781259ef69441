"""Product groups: tables of (product, group)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audix import contracts as C


def groups_from_rules(prod_dim: DataFrame, rules: Mapping[str, Column],
                      group_col: str = C.GROUP) -> DataFrame:
    """Groups defined by predicates on the product dimension, in one scan:
    every product is tagged with each rule it satisfies."""
    tags = F.array(*[F.when(pred, F.lit(name)) for name, pred in rules.items()])
    return (prod_dim.select(C.PRODUCT, F.explode(F.filter(tags, lambda t: t.isNotNull())).alias(group_col))
            .dropDuplicates([C.PRODUCT, group_col]))


def product_groups(listed: DataFrame | None, prod_dim: DataFrame | None = None,
                   rules: Mapping[str, Column] | None = None, group_col: str = C.GROUP) -> DataFrame:
    """Listed (product, group) pairs, e.g. from a spec file, together with
    groups defined by department / section rules; unique pairs."""
    parts = []
    if listed is not None:
        parts.append(listed.select(C.PRODUCT, group_col))
    if rules:
        parts.append(groups_from_rules(prod_dim, rules, group_col))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.dropDuplicates([C.PRODUCT, group_col])


def group_summary(groups: DataFrame, group_col: str = C.GROUP) -> DataFrame:
    """Rows and distinct products per group (a spec check)."""
    return groups.groupBy(group_col).agg(F.count(F.lit(1)).alias("n_rows"),
                                         F.countDistinct(C.PRODUCT).alias("n_products"))


def regroup(groups: DataFrame, mapping: Mapping[str, str] | DataFrame, group_col: str = C.GROUP,
            out_col: str = C.GROUP) -> DataFrame:
    """Roll groups up into super-groups; groups without a super-group drop out."""
    if isinstance(mapping, DataFrame):
        m = mapping.toDF(group_col, "_super")
        out = groups.join(m, group_col)
    else:
        lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
        out = groups.withColumn("_super", lookup[F.col(group_col)]).where(F.col("_super").isNotNull())
    return out.select(C.PRODUCT, F.col("_super").alias(out_col)).dropDuplicates([C.PRODUCT, out_col])


def expand_to_class(prod_dim: DataFrame, products: DataFrame, class_col: str = "class_code") -> DataFrame:
    """All products of the classes that the given products belong to."""
    classes = prod_dim.join(products.select(C.PRODUCT), C.PRODUCT, "left_semi").select(class_col).distinct()
    return prod_dim.join(classes, class_col, "left_semi").select(C.PRODUCT).distinct()
