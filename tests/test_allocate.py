"""The sequential allocation against a plain-Python model of its semantics."""

import random
from collections import Counter

import pytest

from audix import contracts as C
from audix.operators.allocate import (allocate, available_by_size, overlap_candidates, preview_top_k,
                                      remaining_quota, snapshot_conflicts)
from audix.operators.pool import allocation_pool
from tests.conftest import rows

SPEC = "gr_nm string, ca_nm string, n_ca long"


def model(pool, spec, sizes=(1, 2, 3, 4)):
    """pool: {household: {group: rank}}; spec: [(group, audience, quota)]."""
    taken, count, picks = set(), Counter(), []
    for n in sizes:
        live = [r for r in spec if r[2] > 0]
        order = sorted(live, key=lambda r: (-(max(0, r[2] - count[r[1]]) / r[2]), r[1], r[0]))
        for step, (g, ca, q) in enumerate(order, 1):
            room = max(0, q - count[ca])
            cands = sorted((ranks[g], hh) for hh, ranks in pool.items()
                           if hh not in taken and len(ranks) == n and g in ranks)
            for rank, hh in cands[:room]:
                taken.add(hh)
                count[ca] += 1
                picks.append((hh, ca, g, n, rank, n, step))
    return sorted(picks)


def random_pool(seed, n_hh=40, groups="abcd"):
    rnd = random.Random(seed)
    member = {hh: sorted(rnd.sample(groups, rnd.randint(1, len(groups)))) for hh in range(1, n_hh + 1)}
    pool = {hh: {} for hh in member}
    for g in groups:
        hhs = [hh for hh in member if g in member[hh]]
        rnd.shuffle(hhs)
        for r, hh in enumerate(hhs, 1):
            pool[hh][g] = r
    return pool


def spark_pool(spark, pool):
    data = [(hh, g, r) for hh, ranks in pool.items() for g, r in ranks.items()]
    return allocation_pool(spark.createDataFrame(data, "household_id long, gr_nm string, gr_sales_rank int"))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_allocation_matches_model(spark, seed):
    rnd = random.Random(100 + seed)
    pool = random_pool(seed)
    spec = [(g, f"ca_{g}", rnd.randint(2, 12)) for g in "abcd"]
    alloc = allocate(spark_pool(spark, pool), spark.createDataFrame(spec, SPEC))
    got = rows(alloc.picks, C.HOUSEHOLD, C.AUDIENCE, C.GROUP, C.GROUP_COUNT, "rank", "pass_n", "step")
    assert got == model(pool, spec)
    # every household at most once, no audience over quota
    hh = [p[0] for p in got]
    assert len(hh) == len(set(hh))
    quota = {ca: q for _, ca, q in spec}
    assert all(n <= quota[ca] for ca, n in Counter(p[1] for p in got).items())


def test_audience_on_two_rows_and_zero_quota(spark):
    pool = random_pool(5, n_hh=30)
    spec = [("a", "both", 6), ("b", "both", 6), ("c", "zero", 0), ("d", "dd", 4)]
    alloc = allocate(spark_pool(spark, pool), spark.createDataFrame(spec, SPEC))
    got = rows(alloc.picks, C.HOUSEHOLD, C.AUDIENCE, C.GROUP, C.GROUP_COUNT, "rank", "pass_n", "step")
    assert got == model(pool, spec)
    counts = Counter(p[1] for p in got)
    assert counts["both"] <= 6 and "zero" not in counts


def test_resume_and_reports(spark):
    pool = random_pool(9, n_hh=30)
    spec = [(g, f"ca_{g}", 5) for g in "abcd"]
    sp_pool, sp_spec = spark_pool(spark, pool), spark.createDataFrame(spec, SPEC)
    first = allocate(sp_pool, sp_spec, sizes=(1,))
    rest = allocate(sp_pool, sp_spec, sizes=(2, 3, 4), picks=first.picks)
    full = model(pool, spec)
    got = rows(rest.picks, C.HOUSEHOLD, C.AUDIENCE, C.GROUP, C.GROUP_COUNT, "rank", "pass_n", "step")
    assert got == full
    rq = {r[C.AUDIENCE]: (r["n_allctd"], r["to_alloc"]) for r in remaining_quota(sp_spec, first.picks).collect()}
    done = Counter(p[1] for p in full if p[5] == 1)
    assert rq == {f"ca_{g}": (done[f"ca_{g}"], 5 - done[f"ca_{g}"]) for g in "abcd"}
    free = {r[C.GROUP_COUNT]: r["n_available"] for r in available_by_size(sp_pool, first.picks).collect()}
    assert free.get(1, 0) == sum(1 for hh, rk in pool.items() if len(rk) == 1) - sum(done.values())
    state = {r[C.HOUSEHOLD]: r[C.AUDIENCE] for r in rest.state.collect()}
    assert state == {hh: next((p[1] for p in full if p[0] == hh), None) for hh in pool}


def test_stopped_run_goes_on_after_the_last_finished_pass(spark, tmp_path):
    pool = random_pool(11, n_hh=40)
    spec = [(g, f"ca_{g}{k}", 4) for g in "abcd" for k in (1, 2)]
    sp_pool, sp_spec = spark_pool(spark, pool), spark.createDataFrame(spec, SPEC)
    state = str(tmp_path / "state")
    allocate(sp_pool, sp_spec, sizes=(1, 2), state_path=state)
    held = sorted((tmp_path / "state").rglob("*.parquet"))
    before = [f.stat().st_mtime_ns for f in held]
    rest = allocate(sp_pool, sp_spec, state_path=state)
    assert [f.stat().st_mtime_ns for f in held] == before
    columns = (C.HOUSEHOLD, C.AUDIENCE, C.GROUP, C.GROUP_COUNT, "rank", "pass_n", "step")
    assert rows(rest.picks, *columns) == model(pool, spec)
    other = [(g, ca, 2) for g, ca, _ in spec]
    with pytest.raises(ValueError, match="another spec"):
        allocate(sp_pool, spark.createDataFrame(other, SPEC), state_path=state)
    again = allocate(sp_pool, spark.createDataFrame(other, SPEC), state_path=state, reset=True)
    assert rows(again.picks, *columns) == model(pool, other)


@pytest.mark.parametrize("seed", range(6))
def test_shared_quotas_and_refined_ranges_match_model(spark, seed, monkeypatch):
    """Audiences on two and three rows, several rows of a group, and counts so few that cut-offs are refined."""
    from audix.operators import allocate as module
    monkeypatch.setattr(module, "COUNTS", 1)
    monkeypatch.setattr(module, "LEAST_RANGES", 3)
    rnd = random.Random(seed)
    pool = random_pool(40 + seed, n_hh=60)
    quota = {ca: rnd.randint(0, 14) for ca in "UVWXYZ"}
    spec = sorted({(rnd.choice("abcd"), rnd.choice("UVWXYZ")) for _ in range(11)})
    spec = [(g, ca, quota[ca] + (rnd.randint(0, 3) if seed % 2 else 0)) for g, ca in spec]
    alloc = allocate(spark_pool(spark, pool), spark.createDataFrame(spec, SPEC))
    got = rows(alloc.picks, C.HOUSEHOLD, C.AUDIENCE, C.GROUP, C.GROUP_COUNT, "rank", "pass_n", "step")
    assert got == model(pool, spec)
    assert Counter(p[1] for p in got) == +Counter({ca: sum(r["picked"] for r in alloc.log if r[C.AUDIENCE] == ca) for ca in quota})


def test_preview_conflicts_and_overlap(spark):
    pool = {1: {"a": 1, "b": 2}, 2: {"a": 2, "b": 1}, 3: {"a": 3}}
    sp_pool = spark_pool(spark, pool)
    spec = spark.createDataFrame([("a", "A", 2), ("b", "B", 1)], SPEC)
    prev = preview_top_k(sp_pool, spec, n=2)
    assert rows(prev, C.HOUSEHOLD, C.AUDIENCE) == [(1, "A"), (2, "A"), (2, "B")]
    assert rows(snapshot_conflicts(prev), C.HOUSEHOLD, "n_picks", "audiences") == [(2, 2, "A,B")]
    aud = spark.createDataFrame([("X", ["b"]), ("Y", ["a", "z"])], "ca_nm string, ca_gr_set array<string>")
    assert rows(overlap_candidates(sp_pool, aud), C.HOUSEHOLD, C.AUDIENCE) == [
        (1, "X"), (1, "Y"), (2, "X"), (2, "Y"), (3, "Y")]


from hypothesis import HealthCheck, Phase, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=4, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000), quotas=st.lists(st.integers(0, 9), min_size=4, max_size=4),
       shared=st.booleans())
def test_allocation_property(spark, seed, quotas, shared):
    """Random pools and specs (zero quotas, an audience on two rows) against the model."""
    pool = random_pool(seed, n_hh=25)
    names = ["A", "A", "C", "D"] if shared else ["A", "B", "C", "D"]
    spec = [(g, ca, q) for g, ca, q in zip("abcd", names, quotas)]
    alloc = allocate(spark_pool(spark, pool), spark.createDataFrame(spec, SPEC))
    got = rows(alloc.picks, C.HOUSEHOLD, C.AUDIENCE, C.GROUP, C.GROUP_COUNT, "rank", "pass_n", "step")
    assert got == model(pool, spec)
