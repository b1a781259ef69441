"""Calendar lookups and the segment of each household as of a date.

The calendar answers are a handful of integers (a week's last day, a period id). ``segments_at`` and its
helpers keep them inside the plan as scalar subqueries; a history that is partitioned by
period is pruned by them when the plan runs. ``period_of`` and ``segment_as_of`` give the same
answers for a date that the caller holds, and return the period as a number.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audix import contracts as C


def _scalar(df: DataFrame):
    row = df.first()
    return None if row is None else row[0]


def last_date_of_week(date_dim: DataFrame, week_id: int) -> dt.date:
    """Last calendar day of a week."""
    return _scalar(date_dim.where(F.col(C.WEEK) == int(week_id)).agg(F.max(C.DATE)))


def period_of(date_dim: DataFrame, date: dt.date | str, back_days: int = 0) -> int:
    """Period id of ``date - back_days``."""
    d = dt.date.fromisoformat(date) if isinstance(date, str) else date
    target = d - dt.timedelta(days=back_days)
    found = _scalar(date_dim.where(F.col(C.DATE) == F.lit(target)).select(C.PERIOD).limit(1))
    if found is None:
        raise ValueError(f"the calendar has no period for {target}")
    return found


def segment_as_of(history: DataFrame, date_dim: DataFrame, end_date: dt.date | str,
                  back_days: int = C.SEGMENT_LOOKBACK_DAYS) -> tuple[DataFrame, int]:
    """Segment of every household as of ``end_date``.

    History rows from the period of ``end_date - back_days`` on are
    considered; the chosen period is the current one, or the latest
    published period when the current one is not published yet.
    Returns (household_id, seg_desc) at that period, and the period.
    """
    end = dt.date.fromisoformat(end_date) if isinstance(end_date, str) else end_date
    start = end - dt.timedelta(days=back_days)
    # Both calendar lookups in one read of the calendar.
    found = {r[0]: r[1] for r in date_dim.where(F.col(C.DATE).isin(start, end))
             .select(C.DATE, C.PERIOD).distinct().collect()}
    for day in (start, end):
        if found.get(day) is None:
            raise ValueError(f"the calendar has no period for {day}")
    back, current = found[start], found[end]
    recent = history.where(F.col(C.PERIOD) >= back)
    latest = _scalar(recent.agg(F.max(C.PERIOD)))
    chosen = current if latest is None else min(int(latest), int(current))
    seg = (recent.where(F.col(C.PERIOD) == chosen)
           .select(C.HOUSEHOLD, C.SEGMENT).dropDuplicates())
    return seg, chosen


def last_day(date_dim: DataFrame, week_id: int | None = None) -> Column:
    """Last calendar day of a week (of the calendar), as a scalar subquery."""
    days = date_dim if week_id is None else date_dim.where(F.col(C.WEEK) == int(week_id))
    return days.agg(F.max(C.DATE)).scalar()


def period_at(date_dim: DataFrame, date: Column, back_days: int = 0) -> Column:
    """Period of ``date - back_days`` as a scalar subquery; a day outside the calendar is an error at run time."""
    found = date_dim.where(F.col(C.DATE) == F.date_sub(date, back_days)).agg(F.min(C.PERIOD)).scalar()
    return F.coalesce(found, F.raise_error(F.lit(f"the calendar has no period {back_days} days before the date")).cast("int"))


def periods_back(date_dim: DataFrame, back_days: Sequence[int], week_id: int | None = None) -> DataFrame:
    """(back_days, period): the periods of the days so many days before the last day of a week (of the calendar)."""
    days = date_dim if week_id is None else date_dim.where(F.col(C.WEEK) == int(week_id))
    wanted = (days.agg(F.max(C.DATE).alias("_last"))
              .select("_last", F.explode(F.array(*[F.lit(int(b)) for b in back_days])).alias("back_days"))
              .select("back_days", F.date_sub("_last", F.col("back_days")).alias(C.DATE)))
    return wanted.join(date_dim.select(C.DATE, C.PERIOD).distinct(), C.DATE).select("back_days", C.PERIOD)


def segments_at(history: DataFrame, date_dim: DataFrame, week_id: int | None = None,
                back_days: int = C.SEGMENT_LOOKBACK_DAYS) -> DataFrame:
    """:func:`segment_as_of` the last day of a week (of the calendar), all inside one plan.

    (household_id, seg_desc, period_id). The calendar answers and the latest published period are scalar subqueries, so
    nothing is read before the plan runs; on a history partitioned by period the chosen period
    prunes the folders when the plan runs.
    """
    end = last_day(date_dim, week_id)
    back, current = period_at(date_dim, end, back_days), period_at(date_dim, end)
    latest = history.where(F.col(C.PERIOD) >= back).agg(F.max(C.PERIOD)).scalar()
    return (history.where(F.col(C.PERIOD) == F.least(latest, current))
            .select(C.HOUSEHOLD, C.SEGMENT, C.PERIOD).dropDuplicates())


def attach_segment(df: DataFrame, segments: DataFrame, how: str = "left",
                   fill: str | None = C.SEGMENT_FILL_LABEL) -> DataFrame:
    """Attach the segment of each household (left keeps everyone and fills
    the label, inner drops households without a segment)."""
    out = df.join(segments.select(C.HOUSEHOLD, C.SEGMENT), C.HOUSEHOLD, how)
    if fill is not None and how == "left":
        out = out.fillna(fill, subset=[C.SEGMENT])
    return out
