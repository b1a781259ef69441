"""Operators 3 and 9 against brute force."""

import random

import numpy as np

from audix.llm import ngram_join, substring_dedup
from audix.llm.components import components
from tests.llm.helpers import DOCS, frame, jaccard_components, without_repeats


def near_copies(seed=5):
    """Families of near copies around the threshold, and a passage in many documents."""
    rnd = random.Random(seed)
    word = lambda: f"t{rnd.randint(0, 400)}"
    passage = [word() for _ in range(60)]
    rows = []
    for family in range(12):
        base = [word() for _ in range(rnd.randint(4, 160))]
        for _ in range(rnd.randint(1, 14)):
            own = list(base)
            for _ in range(rnd.randint(0, max(1, len(own) // 18))):
                own[rnd.randrange(len(own))] = word()
            rows.append((len(rows), " ".join(own)))
    for _ in range(40):
        own = [word() for _ in range(rnd.randint(20, 90))]
        rows.append((len(rows), " ".join(own + passage)))
    return rows + DOCS


def joined(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngram_join.jaccard_join(df).collect())


def test_components_match_brute_force(spark):
    rows = near_copies()
    assert joined(frame(spark, rows)) == jaccard_components(rows)


def test_blocks_of_a_family_find_the_same(spark, monkeypatch):
    rows = near_copies(6)
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 3)
    assert joined(frame(spark, rows)) == jaccard_components(rows)


def test_empty_table(spark):
    assert ngram_join.jaccard_join(frame(spark, [])).collect() == []
    assert substring_dedup.remove_repeats(frame(spark, [])).collect() == []


def test_one_of_each_keeps_a_row_of_every_group(spark):
    rows = near_copies()
    kept = ngram_join.one_of_each(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    brute = jaccard_components([(k, t) for k, (_, t) in enumerate(rows)])
    assert kept.count() == len({r[2] for r in brute})
    ids = [r.doc_id for r in kept.collect() if r.doc_id is not None]
    want = jaccard_components(rows)
    assert set(map(str, ids)) >= {r[2] for r in want if r[0] == r[2]} - {"None"}


def test_products_are_overlaps():
    rnd = np.random.default_rng(1)
    sets = [np.unique(rnd.integers(0, 60, rnd.integers(1, 40))).astype(np.int64) for _ in range(30)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = ngram_join._multiply(sets)
    off = ~np.eye(len(sets), dtype=bool)
    assert (got[off] == np.array(want)[off]).all()


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (60, 50)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(30)) and got[60] == 50


def test_repeats_match_brute_force(spark):
    rows = near_copies() + [(500, " ".join(["go"] * 90))]
    out = substring_dedup.remove_repeats(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in out) == without_repeats(rows)
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in out)


def test_short_windows(spark):
    rows = near_copies()[:60] + DOCS
    out = substring_dedup.remove_repeats(frame(spark, rows), window=6, prefix=3).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in out) == without_repeats(rows, 6)
