"""Quota allocation of households to audiences.

Spec: rows (gr_nm, ca_nm, n_ca) -- households of group ``gr_nm`` may go to
audience ``ca_nm``, which takes at most ``n_ca`` households in all.

``allocate`` runs passes over combination sizes n (households that bought
exactly n of the pooled groups). Before each pass the spec rows are put in order
(by the share of their audience's quota still open, descending, then
audience and group names). Within a pass the rows pick one after another: a row
takes the best ``n_ca - already allocated to its audience`` unallocated
households of size n that bought its group, by their rank in the group. Each
household ends in at most one audience, and an audience on several spec rows
never exceeds its quota.

What a pass decides is one number per spec row, its *cut-off*: the last rank it
takes. A household goes to the first row, in pass order, whose cut-off its rank
in the row's group reaches. The cut-offs are found by deferred acceptance: all rows
start open; rows that draw more households than the room left to their audience (earlier
rows of the audience come first) lower their cut-off to the last rank that fits, and the
households behind it show up at their next rows in the next round, until every row fits. A round is
one count of households per (row, range of ranks) over the staged pool, and one more for
each refinement of the ranges that hold a cut-off, whatever the number of
households; nothing but counts leaves the executors. Picks and state are a projection of
the pool by the cut-offs, without a join.

Ranks are unique inside a group and size, as a ranking makes them. The driver holds spec rows,
cut-offs and a bounded number of counts. With ``state_path`` every pass leaves its cut-offs there,
with a fingerprint of spec, pool and earlier picks; a later call goes on after the last finished pass, stops with an error
when the fingerprint is another, or starts over with ``reset``.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from audix import contracts as C
from audix.operators.pool import pool_long
from audix.operators.ranking import pick_by_rank
from audix.sources.readers import spec_frame
from audix.sources.sinks import stage_table, write_table

#: Counts that a job may send to the driver, and the fewest ranges of ranks per spec row.
COUNTS, LEAST_RANGES = 1 << 18, 256
PICKS_COLUMNS = [C.HOUSEHOLD, C.AUDIENCE, C.GROUP, C.GROUP_COUNT, "rank", "pass_n", "step"]
PICKS_SCHEMA = (f"{C.HOUSEHOLD} long, {C.AUDIENCE} string, {C.GROUP} string, {C.GROUP_COUNT} int, "
                "rank int, pass_n int, step int")


@dataclass
class Allocation:
    picks: DataFrame                 # household_id, ca_nm, gr_nm, n_gr, rank, pass_n, step
    state: DataFrame                 # pool columns + ca_nm (null = not allocated)
    log: list[dict] = field(default_factory=list)   # one entry per step (spec-size)


@dataclass
class _Step:
    """A spec row inside a pass: ranks up to ``cut`` are taken; ``(lo, hi]`` are the ranks that a count looks at."""
    turn: int
    pass_n: int
    step: int
    group: str
    audience: str
    to_alloc: int
    cut: int
    picked: int = 0
    lo: int = 0
    hi: int = 0
    width: int = 1

    def literal(self) -> str:
        text = {c: "null" if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
                for c, v in (("group", self.group), ("audience", self.audience))}
        return (f"named_struct('turn', {self.turn}, 'pass_n', {self.pass_n}, 'step', {self.step}, 'group', string({text['group']}), "
                f"'audience', string({text['audience']}), 'cut', {self.cut}, 'lo', {self.lo}, 'hi', {self.hi}, 'width', {self.width})")


def _placed(pool: DataFrame, steps: list[_Step], keep_all: bool = False) -> DataFrame:
    """The households that a step takes, with the first such step in order and the rank there; with
    ``keep_all`` the others too (nulls). The step is generated, not projected, so that it is evaluated once."""
    if not steps:
        steps = [_Step(0, -1, 0, None, None, 0, 0)]  # takes nobody
    array = F.expr(f"array({', '.join(s.literal() for s in steps)})")
    takes = F.filter(array, lambda s: (s["pass_n"] == F.col(C.GROUP_COUNT)) & (F.try_element_at(C.RANK_MAP, s["group"]) <= s["cut"]))
    first = F.slice(takes, 1, 1)
    out = pool.select("*", (F.explode_outer(first) if keep_all else F.explode(first)).alias("_s"))
    return out.withColumn("_rank", F.try_element_at(C.RANK_MAP, F.col("_s.group")))


def _counts(pool: DataFrame, steps: list[_Step], turn: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """step -> (ranges, households): the households at each step of this turn whose rank is in ``(lo, hi]``."""
    at = _placed(pool.where("_given IS NULL"), steps).where(f"_s.turn = {turn} AND _rank > _s.lo AND _rank <= _s.hi")
    found = (at.groupBy(F.col("_s.step").alias("step"), F.expr("(_rank - _s.lo - 1) div _s.width").alias("range"))
             .agg(F.count(F.lit(1)).alias("n")).toArrow().sort_by([("step", "ascending"), ("range", "ascending")]))
    step, ranges, n = (found.column(c).to_numpy() for c in ("step", "range", "n"))
    return {int(x): (ranges[step == x], n[step == x]) for x in np.unique(step)}


def _look_at(s: _Step, lo: int, hi: int, ranges: int) -> None:
    s.lo, s.hi, s.width = lo, hi, max(1, -(-(hi - lo) // ranges))


def _run_pass(pool: DataFrame, earlier: list[_Step], own: list[_Step], turn: int) -> None:
    """Find the cut-offs of ``own`` (in pass order); ``earlier`` are the steps of earlier turns."""
    ranges = max(LEAST_RANGES, COUNTS // max(1, len(own)))
    while True:
        for s in own:
            _look_at(s, 0, s.cut, ranges)
        found = _counts(pool, earlier + own, turn)
        used: Counter = Counter()  # of the rows so far, by audience
        pending: list[tuple[_Step, int]] = []
        for s in own:
            room = max(0, s.to_alloc - used[s.audience])
            s.picked = int(found[s.step][1].sum()) if s.step in found else 0
            if s.picked > room:
                pending.append((s, room))
            used[s.audience] += min(room, s.picked)
        if not pending:
            return
        cuts: dict[int, int] = {}
        while pending:
            finer = []
            for s, room in pending:
                at, n = found[s.step]
                total = np.cumsum(n)
                k = int(np.searchsorted(total, room))
                lo = s.lo + int(at[k]) * s.width
                if room == 0:
                    cuts[s.step] = 0
                elif s.width == 1:
                    cuts[s.step] = lo + 1
                else:
                    _look_at(s, lo, min(lo + s.width, s.hi), ranges)
                    finer.append((s, room - int(total[k] - n[k])))
            pending = finer
            if pending:
                wanted = {s.step for s, _ in pending}
                for s in own:
                    if s.step not in wanted:
                        s.lo = s.hi = 0
                found = _counts(pool, earlier + own, turn)
        for s in own:
            s.cut = cuts.get(s.step, s.cut)


def remaining_quota(spec: DataFrame, picks: DataFrame | None = None) -> DataFrame:
    """Spec rows with households allocated so far to their audience, the number
    still open, its share of the quota (null for a zero quota) and the row's
    ``position`` in the order of a pass (null for a zero quota)."""
    if picks is None:
        done = spec_frame(spec.sparkSession, [], f"{C.AUDIENCE} string, n_allctd long")
    else:
        done = picks.groupBy(C.AUDIENCE).agg(F.count(F.lit(1)).alias("n_allctd"))
    rows = (spec.join(done, C.AUDIENCE, "left").fillna(0, subset=["n_allctd"])
            .withColumn("to_alloc", F.greatest(F.lit(0), F.col(C.QUOTA) - F.col("n_allctd")))
            .withColumn("prop_to_alloc", F.try_divide(F.col("to_alloc").cast("double"),
                                                      F.col(C.QUOTA).cast("double"))))
    # Numbers the rows of the user's spec, not data.
    order = Window.orderBy(F.col("prop_to_alloc").desc_nulls_last(), C.AUDIENCE, C.GROUP)
    return rows.withColumn("position", F.when(F.col(C.QUOTA) > 0, F.row_number().over(order)))


def available_by_size(pool: DataFrame, picks: DataFrame | None = None) -> DataFrame:
    """Unallocated households per combination size."""
    free = pool if picks is None else pool.join(picks.select(C.HOUSEHOLD), C.HOUSEHOLD, "left_anti")
    return free.groupBy(C.GROUP_COUNT).agg(F.count(F.lit(1)).alias("n_available"))


def merge_picks(pool: DataFrame, picks: DataFrame) -> DataFrame:
    """Allocation state: every pool household with its audience or null."""
    return pool.join(picks.select(C.HOUSEHOLD, C.AUDIENCE), C.HOUSEHOLD, "left")


_CUTS_SCHEMA = f"step int, {C.GROUP} string, {C.AUDIENCE} string, to_alloc long, cut int, picked long, fingerprint string"


def _finished_pass(spark, path: str, fingerprint: str, own: list[_Step]) -> bool:
    """Take over the cut-offs that an earlier run left for a pass (False: not finished)."""
    try:
        spark.read.text(f"{path}/_SUCCESS")
    except AnalysisException:
        return False
    rows = {r["step"]: r for r in spark.read.schema(_CUTS_SCHEMA).parquet(path).collect()}
    if any(r["fingerprint"] != fingerprint for r in rows.values()) or set(rows) != {s.step for s in own}:
        raise ValueError(f"{path} belongs to another spec, pool or order of passes; pass reset=True to start over")
    for s in own:
        s.cut, s.picked = rows[s.step]["cut"], rows[s.step]["picked"]
    return True


def _pool_sum(pool: DataFrame) -> str:
    """Number of rows and an order-free hash sum of households, earlier picks and ranks."""
    entries = F.array_sort(F.map_entries(C.RANK_MAP))
    row = pool.agg(F.count(F.lit(1)), F.sum(F.xxhash64(C.HOUSEHOLD, C.GROUP_COUNT, "_given", entries).cast("decimal(38,0)"))).first()
    return f"{row[0]}:{row[1]}"


def _in_order(spec: list, done: Counter) -> list[dict]:
    """Spec rows with a quota in the order of a pass (see :func:`remaining_quota`)."""
    rows = [{**r.asDict(), "to_alloc": max(0, r[C.QUOTA] - done[r[C.AUDIENCE]])} for r in spec if (r[C.QUOTA] or 0) > 0]
    return sorted(rows, key=lambda r: (-(r["to_alloc"] / r[C.QUOTA]), r[C.AUDIENCE] is not None, r[C.AUDIENCE] or "",
                                       r[C.GROUP] is not None, r[C.GROUP] or ""))


def allocate(pool: DataFrame, spec: DataFrame, sizes: Sequence[int] = (1, 2, 3, 4),
             picks: DataFrame | None = None, state_path: str | None = None, reset: bool = False) -> Allocation:
    """Sequential quota allocation (see module doc).

    ``picks`` continues from earlier picks (same columns as the result).
    """
    spark = pool.sparkSession
    columns = pool.columns
    if picks is None:
        given = pool.withColumn("_given", F.lit(None).cast("string"))
        done: Counter = Counter()
    else:
        picks = picks.select(*PICKS_COLUMNS)
        given = pool.join(picks.select(C.HOUSEHOLD, F.col(C.AUDIENCE).alias("_given")), C.HOUSEHOLD, "left")
        done = Counter({r[0]: r[1] for r in picks.groupBy(C.AUDIENCE).count().collect()})
    # One folder per combination size: a pass reads only its size's folder.
    kind = pool.schema[C.GROUP_COUNT].dataType
    held = stage_table(given, "pool", partition_by=[C.GROUP_COUNT]).withColumn(C.GROUP_COUNT, F.col(C.GROUP_COUNT).cast(kind))
    top = held.agg(F.max(F.array_max(F.map_values(C.RANK_MAP)))).first()[0] or 0
    rows = spec.select(C.GROUP, C.AUDIENCE, C.QUOTA).collect()
    told = None if state_path is None else f"{sorted(map(str, rows))}|{_pool_sum(held)}"
    steps: list[_Step] = []
    log: list[dict] = []
    for turn, n in enumerate(sizes):
        own = [_Step(turn, n, k, r[C.GROUP], r[C.AUDIENCE], r["to_alloc"], int(top) if r["to_alloc"] else 0)
               for k, r in enumerate(_in_order(rows, done), 1)]
        path, fingerprint = f"{(state_path or '').rstrip('/')}/pass_{n}", None
        if state_path is not None:
            fingerprint = hashlib.sha256(f"{told}|{list(sizes[:turn + 1])}".encode()).hexdigest()
        if state_path is None or reset or not _finished_pass(spark, path, fingerprint, own):
            earlier = [s for s in steps if s.pass_n == n]
            _run_pass(held.where(F.col(C.GROUP_COUNT) == n), earlier, own, turn)
            if state_path is not None:
                cuts = [(s.step, s.group, s.audience, s.to_alloc, s.cut, s.picked, fingerprint) for s in own]
                write_table(spec_frame(spark, cuts, _CUTS_SCHEMA), path)
        for s in own:
            done[s.audience] += s.picked
            log.append({"pass_n": n, "step": s.step, C.GROUP: s.group, C.AUDIENCE: s.audience,
                        "to_alloc": s.to_alloc, "picked": s.picked})
        steps += own
    placed = _placed(held.where(F.col(C.GROUP_COUNT).isin(list(sizes)) & F.col("_given").isNull()), steps)
    new = placed.select(C.HOUSEHOLD, F.col("_s.audience").alias(C.AUDIENCE), F.col("_s.group").alias(C.GROUP),
                        F.col(C.GROUP_COUNT).cast("int").alias(C.GROUP_COUNT), F.col("_rank").cast("int").alias("rank"),
                        F.col("_s.pass_n").alias("pass_n"), F.col("_s.step").alias("step"))
    state = _placed(held, steps, keep_all=True).select(*columns, F.coalesce("_given", F.col("_s.audience")).alias(C.AUDIENCE))
    return Allocation(new if picks is None else picks.unionByName(new), state, log)


def preview_top_k(pool: DataFrame, spec: DataFrame, n: int) -> DataFrame:
    """Per spec row, its best ``n_ca`` households of size ``n`` on the pool as
    it is, without removing households picked by other rows (one job)."""
    long = pool_long(pool).where(F.col(C.GROUP_COUNT) == n)
    joined = long.join(spec.select(C.GROUP, C.AUDIENCE, C.QUOTA), C.GROUP)
    out = pick_by_rank(joined, [C.AUDIENCE, C.GROUP], F.col(C.QUOTA), "rank", [C.HOUSEHOLD])
    return out.select(C.HOUSEHOLD, C.AUDIENCE, C.GROUP, C.GROUP_COUNT, "rank")


def snapshot_conflicts(preview: DataFrame) -> DataFrame:
    """Households that more than one audience would pick from one snapshot."""
    return (preview.groupBy(C.HOUSEHOLD)
            .agg(F.count(F.lit(1)).alias("n_picks"),
                 F.array_join(F.sort_array(F.collect_list(C.AUDIENCE)), ",").alias("audiences"))
            .where(F.col("n_picks") > 1))


def overlap_candidates(pool: DataFrame, audience_sets: DataFrame, set_col: str = "ca_gr_set") -> DataFrame:
    """(household, audience) pairs where the household's groups overlap the
    audience's groups: both sides exploded to (key, group) and equi-joined --
    no nested-loop join; the audience side is spec-size."""
    hh = pool.select(C.HOUSEHOLD, C.GROUP_COUNT, F.explode(C.GROUP_LIST).alias(C.GROUP))
    aud = audience_sets.select(C.AUDIENCE, F.explode(set_col).alias(C.GROUP))
    return hh.join(aud, C.GROUP).select(C.HOUSEHOLD, C.AUDIENCE, C.GROUP_COUNT).distinct()
