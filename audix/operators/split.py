"""Test / control split of audiences, summary, and hashed ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audix import contracts as C
from audix.functions.hashing import BUCKETS, unit_bucket


def _fraction_of(stratum, fractions: Mapping[str, float], default: float | None):
    if fractions:
        lookup = F.create_map(*[F.lit(x) for kv in fractions.items() for x in kv])[stratum]
    else:
        lookup = F.lit(None).cast("double")
    if default is not None:
        return F.coalesce(lookup, F.lit(float(default)))
    return F.when(lookup.isNull(), F.raise_error(F.concat(
        F.lit("no control fraction for stratum "), F.coalesce(stratum.cast("string"), F.lit("null"))))).otherwise(lookup)


def assign_arm(df: DataFrame, fractions: Mapping[str, float], *, salt: str, stratum_col: str = C.SEGMENT,
               group_col: str = C.GROUP, no_control: Sequence[str] = (), default_fraction: float | None = None,
               key_col: str = C.HOUSEHOLD, arm_col: str = C.ARM) -> DataFrame:
    """Add ``arm`` (test / ctrl) in one pass, stratified by audience x stratum.

    Each row goes to control with the fraction of its stratum, decided by a
    hash of its key and ``salt``, the campaign's name: the same rows are chosen whatever
    the partitioning, on a retry, and by any SQL engine with md5, and other ones
    in the next campaign. Rows without an audience (the state of an allocation has
    them) are left out. Audiences in ``no_control`` are all test. A stratum
    missing from ``fractions`` uses ``default_fraction``; without one the job fails.
    """
    if not salt:
        raise ValueError("salt must name the campaign")
    df = df.where(F.col(group_col).isNotNull())
    control = unit_bucket(F.col(key_col), salt) < _fraction_of(F.col(stratum_col), fractions, default_fraction) \
        * F.lit(float(BUCKETS))
    if no_control:
        control = F.when(F.col(group_col).isin(list(no_control)), F.lit(False)).otherwise(control)
    return df.withColumn(arm_col, F.when(control, F.lit(C.ARM_CONTROL)).otherwise(F.lit(C.ARM_TEST)))


def sample_by_arm(df: DataFrame, fractions: Mapping[str, float], stratum_col: str = C.SEGMENT,
                  key_col: str = C.HOUSEHOLD, seed: int = 0, arm_col: str = C.ARM) -> DataFrame:
    """The ``sampleBy`` form of the split: Bernoulli per stratum with a seed.
    Its result depends on the partition layout; prefer :func:`assign_arm`."""
    ctrl = df.sampleBy(stratum_col, fractions=dict(fractions), seed=seed).select(key_col).distinct()
    flagged = df.join(ctrl.withColumn("_ctrl", F.lit(True)), key_col, "left")
    return (flagged.withColumn(arm_col, F.when(F.col("_ctrl"), F.lit(C.ARM_CONTROL)).otherwise(F.lit(C.ARM_TEST)))
            .drop("_ctrl"))


def sampled_shares(split: DataFrame, fractions: Mapping[str, float], deviations: float = 5.0,
                   stratum_col: str = C.SEGMENT, arm_col: str = C.ARM, key_col: str = C.HOUSEHOLD) -> DataFrame:
    """Per stratum of a sampled split: rows, households, whether every row has
    one of the two arms, and whether the control share lies within
    ``deviations`` standard deviations of its fraction."""
    n, ctrl = F.count(F.lit(1)), F.sum(F.when(F.col(arm_col) == C.ARM_CONTROL, 1).otherwise(0))
    fraction = F.create_map(*[F.lit(x) for kv in fractions.items() for x in kv])[F.col(stratum_col)]
    spread = F.lit(deviations) * F.sqrt(F.col("n_rows") * fraction * (1 - fraction)) + 1
    return (split.groupBy(stratum_col)
            .agg(n.alias("n_rows"), F.countDistinct(key_col).alias("n_households"), ctrl.alias("_ctrl"),
                 F.min(F.col(arm_col).isin(C.ARM_TEST, C.ARM_CONTROL)).alias("in_one_arm"))
            .withColumn("share_in_bound", F.abs(F.col("_ctrl") - F.col("n_rows") * fraction) <= spread).drop("_ctrl"))


def split_summary(split: DataFrame, group_col: str = C.GROUP, arm_col: str = C.ARM) -> DataFrame:
    """n_test, n_ctrl and n_total per audience (audiences with an empty arm stay)."""
    is_test = F.when(F.col(arm_col) == C.ARM_TEST, 1).otherwise(0)
    is_ctrl = F.when(F.col(arm_col) == C.ARM_CONTROL, 1).otherwise(0)
    return split.groupBy(group_col).agg(F.sum(is_test).cast("long").alias("n_test"),
                                        F.sum(is_ctrl).cast("long").alias("n_ctrl"),
                                        F.count(F.lit(1)).alias("n_total"))


def attach_hashed_ids(df: DataFrame, customer_dim: DataFrame) -> DataFrame:
    """Attach the external hashed id of each household (left join)."""
    ids = customer_dim.select(C.HOUSEHOLD, C.HASHED_ID).dropDuplicates()
    return df.join(ids, C.HOUSEHOLD, "left")
