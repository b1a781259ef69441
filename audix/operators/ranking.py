"""Exact ranks inside groups that may be very large.

``row_number() OVER (PARTITION BY g ORDER BY ...)`` sends every row of a
group to one task; when one group holds a third of the data that task holds
a third of the data. ``rank_within`` gives the same numbers without that:

1. range-partition on (group, order keys) into N partitions (N fixed, so AQE
   leaves the layout alone); every partition holds a contiguous slice of the
   sorted key space, and a hot group is spread over many partitions;
2. sort inside each partition and number the rows (no shuffle);
3. write the numbered rows once to a staged table in the shared checkpoint
   folder: the range bounds come from a sample, and Spark re-samples with a
   seed tied to the RDD id, so two reads of an unstaged plan could place rows
   differently; the stored numbers are the same for every reader and survive
   a lost executor;
4. count rows per (group, partition) -- at most N + #groups - 1 runs, since
   each partition adds at most one run per group boundary it contains -- and
   turn the counts into offsets with a window over that small table;
5. broadcast the offsets back (size bounded as above) and add them.

The order keys must be a total order inside each group (end them with a
unique key, e.g. the household id), so the numbering is deterministic and a
retried task produces the same rows.

``pick_by_rank`` takes the best rows of a group from ranks that exist
already, without numbering them again: see there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from audix.sources.sinks import stage_table

_PART, _POS, _FIRST, _BEFORE, _N = "_rk_part", "_rk_pos", "_rk_first", "_rk_before", "_rk_n"
_LIMIT, _RANGE, _ROOM = "_rk_limit", "_rk_range", "_rk_room"
#: Ranks of a group that one task may sort.
RANGE_WIDTH = 10_000


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def rank_within(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = row_number() over (partition by ``by`` order by ``order``).

    For groups that may hold a large part of the rows (see module doc); for
    groups of a proven bound use :func:`row_number_small_groups`.
    """
    by = list(by)
    n = _partitions(df, num_partitions)
    keys = [F.col(c).asc_nulls_first() for c in by] + list(order)
    placed = (df.repartitionByRange(n, *keys)
              .sortWithinPartitions(*keys)
              .withColumn(_PART, F.spark_partition_id())
              .withColumn(_POS, F.monotonically_increasing_id()))
    placed = stage_table(placed, "rank")
    runs = (placed.groupBy(*by, _PART)
            .agg(F.min(_POS).alias(_FIRST), F.count(F.lit(1)).alias(_N)))
    earlier = Window.partitionBy(*by).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn(_BEFORE, F.coalesce(F.sum(_N).over(earlier), F.lit(0))).drop(_N)
    # N + #groups - 1 rows; AQE broadcasts them when their measured size allows.
    right = runs.select(*[F.col(c).alias(f"_rk_key{i}") for i, c in enumerate(by)],
                        F.col(_PART).alias("_rk_part_r"), _FIRST, _BEFORE)
    cond = F.col(_PART) == F.col("_rk_part_r")
    for i, c in enumerate(by):
        cond = cond & F.col(c).eqNullSafe(F.col(f"_rk_key{i}"))
    out = placed.join(right, cond, "inner")
    rank = (F.col(_BEFORE) + F.col(_POS) - F.col(_FIRST) + 1).cast("int")
    return out.select(*[F.col(c) for c in df.columns], rank.alias(name))


def pick_by_rank(df: DataFrame, by: Sequence[str], limit: Column | int, rank_col: str = "rank",
                 tie_cols: Sequence[str] = (), width: int = RANGE_WIDTH) -> DataFrame:
    """The ``limit`` best rows of each group by an existing rank.

    ``limit`` is a number or a column that is constant inside a group. Rows
    are counted per (group, range of ``width`` ranks); the counts before a
    range tell how many of its rows are still wanted, and rows are numbered
    inside their range only. As ranks are unique in the ranking they come
    from, a range holds at most ``width`` rows of it, so no task sorts a
    group, and ranges past the limit are never moved; ``tie_cols`` order rows of equal rank when several rankings meet.
    Rows without a rank are not picked.
    """
    by = list(by)
    given = df.columns
    ranged = (df.where(F.col(rank_col).isNotNull())
              .withColumn(_LIMIT, (limit if isinstance(limit, Column) else F.lit(limit)).cast("long"))
              .withColumn(_RANGE, F.floor(F.col(rank_col) / F.lit(width))))
    sizes = ranged.groupBy(*by, _RANGE).agg(F.count(F.lit(1)).alias(_N), F.first(_LIMIT).alias(_LIMIT))
    spec = Window.partitionBy(*[F.col(c) for c in by]) if by else Window.partitionBy(F.lit(0))
    before = F.coalesce(F.sum(_N).over(spec.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cuts = (sizes.withColumn(_BEFORE, before).where(F.col(_BEFORE) < F.col(_LIMIT))
            .select(*[F.col(c).alias(f"_rk_key{i}") for i, c in enumerate(by)], F.col(_RANGE).alias("_rk_range_r"),
                    (F.col(_LIMIT) - F.col(_BEFORE)).alias(_ROOM)))
    cond = F.col(_RANGE) == F.col("_rk_range_r")
    for i, c in enumerate(by):
        cond = cond & F.col(c).eqNullSafe(F.col(f"_rk_key{i}"))
    order = [F.col(rank_col).asc(), *(F.col(c).asc() for c in tie_cols)]
    inside = row_number_small_groups(ranged.join(cuts, cond), [*by, _RANGE], order, _POS)
    return inside.where(F.col(_POS) <= F.col(_ROOM)).select(*given)


def row_number_small_groups(df: DataFrame, by: Sequence[str], order: Sequence[Column],
                            name: str = "rank") -> DataFrame:
    """Plain window row_number, for groups whose size is bounded (e.g. the
    dates of one household)."""
    w = Window.partitionBy(*by).orderBy(*order) if by else Window.orderBy(*order)
    return df.withColumn(name, F.row_number().over(w))
