"""Operators 11, 12 and 13 against brute force."""

import hashlib
import itertools
import math
import os
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from audix.llm import alignment, catalogue, collocations, nearest, oracle
from tests.llm.helpers import DOCS, UPPER, frame

SF = "/root/testdata/sf0.001"
FILES = alignment.read_files(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


# ---- 11 ----------------------------------------------------------------

def plain_collocations(rows, least, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    found = {}
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= least:
            cuts = [(1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if not any(len(q) > len(p) and other == lang and b >= least and 100 * b >= 50 * a and p in (q[:2], q[1:])
                       for (other, q), b in f.items()):
                found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i, p.decode(), -a, left, right, n[lang], -score) for lang, rows in found.items()
                  for i, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1))


def prose(seed):
    rnd = random.Random(seed)
    words = ["the", "of", "A", "a", "New", "york", "É", "x.y", "b,c", "d!", "\t", "  ", "\n", "z\x0bz", "tail;", "\x00", "日本", "w1", "w2", "w3", "w4"]
    rows = [(rnd.choice(["en", "de", None, "und", ""]), " ".join(rnd.choices(words, weights=range(len(words), 0, -1), k=rnd.randint(0, 60))))
            for _ in range(150)]
    return rows + [("en", None), ("en", ""), (None, None), ("en", "hot pair hot pair " * 300)] + [("en", "same text here again")] * 30


def table11(spark, rows):
    df = spark.createDataFrame(rows, "lang string, text string")
    for name in ("key", "n", "word", "route", "rank", "f", "doc_id"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.mark.parametrize("heavy,small,held", [(1 << 17, 1 << 16, 1 << 21), (30, 4, 50)])
def test_collocations_match_brute_force(spark, monkeypatch, heavy, small, held):
    """Also with frequent leading words routed by all words, parts split by the quicksort and small merges."""
    for name, value in (("HEAVY", heavy), ("SMALL", small), ("HELD", held), ("WORDS_HELD", held)):
        monkeypatch.setattr(collocations, name, value)
    rows = prose(1)
    got = sorted(tuple(r) for r in collocations.collocations(table11(spark, rows), least=4, top=40).collect())
    want = plain_collocations(rows, 4, 40)
    assert got == want and len(got) > 60


def test_quicksort_counts_and_abandons():
    rnd = np.random.default_rng(3)
    keys = [rnd.integers(0, 9, 4000).astype(np.uint64) ** 2 for _ in range(3)]
    weight = rnd.integers(1, 5, 4000)
    for small, least in ((1 << 16, 1), (7, 1), (7, 60), (300, 200)):
        collocations.SMALL, before = small, collocations.SMALL
        try:
            got = Counter()
            for depth, own, bounds in collocations.partitions(keys, weight, least):
                for lo, hi in zip(bounds, bounds[1:]):
                    if weight[own[lo:hi]].sum() >= least:
                        got[tuple(int(keys[d][own[lo]]) for d in range(depth + 1))] += int(weight[own[lo:hi]].sum())
        finally:
            collocations.SMALL = before
        want = Counter()
        for *k, w in zip(*keys, weight):
            for d in range(3):
                want[tuple(map(int, k[:d + 1]))] += int(w)
        assert got == {k: v for k, v in want.items() if v >= least}


def most_held(run):
    tracemalloc.start()
    try:
        found = run()
        return found, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_a_task_holds_one_route_and_few_suffixes():
    """A route of average size, and the suffixes that a task merges before it hands them on."""
    rnd, size = np.random.default_rng(5), collocations.ROUTE
    keys = [rnd.integers(1, 1 << 63, size, dtype=np.uint64) for _ in range(3)]
    weight = np.where(np.arange(size) % 4096, 1, 10).astype(np.int32)
    packed = [pa.py_buffer(b"".join(x[at::8].tobytes() for x in (*keys, weight))) for at in range(8)]
    found, held = most_held(lambda: list(collocations._count_route(packed, 10)))
    assert sum(b.num_rows for b in found) == 2 * -(-size // 4096) and held < 40

    class Heavy:
        value = np.zeros(1 << 10, np.int64)

    words = rnd.integers(0, 1 << 40, 1_100_000)
    texts = [" ".join(map("{:x}".format, words[at:at + 200])) for at in range(0, len(words), 200)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array(texts)], ["lang", "text"])
    rows, held = most_held(lambda: sum(len(x) for b in collocations._route_suffixes(Heavy, 7)(iter([batch])) for x in b.column(1).to_pylist()))
    assert rows == 28 * (len(words) - len(texts)) and held < 90


def test_collocations_of_empty_tables(spark):
    assert collocations.collocations(table11(spark, [])).collect() == []
    assert collocations.collocations(table11(spark, [("en", None), (None, " . , ")])).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_collocations_match_the_sql_twin(spark):
    from tools.compare import duck
    want = duck(SF).execute(oracle.OP11).fetchall()
    assert sorted(tuple(r) for r in catalogue.op11_collocations(spark, SF).collect()) == sorted(want)


# ---- 12 ----------------------------------------------------------------

def plain_alignment(texts):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    a, b = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model"))
    a.encode_special_tokens = True
    letters = {v: k for k, v in alignment.byte_alphabet().items()}
    assert sorted(letters) == list(range(256))
    of_letter = alignment.byte_alphabet()
    docs, count = [], Counter()
    for text in texts:
        x = a.encode(" " + text, add_special_tokens=False) if text else None
        ids = [(x.ids if x else []), b.encode(text) if text else []]
        raw = [[bytes(of_letter[c] for c in t) for t in (x.tokens if x else [])],
               [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in map(b.id_to_piece, ids[1])]]
        if not text or any(b"".join(r) != (" " + text).encode() for r in raw):
            ids = raw = [[], []]
        ends = [list(itertools.accumulate(map(len, r))) for r in raw]
        common = sorted(set(ends[0]) & set(ends[1]))
        links = [(ids[0][ends[0].index(e)], ids[1][ends[1].index(e)]) for e in common]
        groups = ";".join("|".join(",".join(str(i) for i, e in zip(ids[s], ends[s]) if lo < e <= hi) for s in range(2))
                          for lo, hi in zip([0, *common], common))
        docs.append((len(ids[0]), len(ids[1]), links, groups))
        count.update(links)
    best = Counter()
    for (_, j), k in count.items():
        best[j] = max(best[j], k)
    return [(n_a, n_b, len(x), len(x), sum(count[p] == best[p[1]] for p in x), sum(count[p] for p in x),
             hashlib.sha256(g.encode()).hexdigest() if n_a else "") for n_a, n_b, x, g in docs]


ODD = ["  lead and  double ", "tab\there\nline\r\n\r\n", "a ▁ b", "▁", "<|endoftext|> <s> </s> <unk> [PAD]", "日本語 テキスト 🎉🎉 x", "x\x1cy \x85 z\x00q",
       "it's  'LL  we're", "9 99 999 1234567", " ", "\n", "e\u0301 é ﬁ", "a b\u3000c\u200bd \ufeff"]


@pytest.mark.parametrize("heavy_pairs", [1 << 20, 12, 0])
def test_alignment_matches_brute_force(spark, heavy_pairs):
    """Also when most pairs of ids, or all, go through the join instead of the broadcast."""
    rows = DOCS + [(200 + i, t) for i, t in enumerate(ODD)]
    got = alignment.align_corpus(frame(spark, rows), FILES, heavy_pairs=heavy_pairs)
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = [(k, *w) for (k, _), w in zip(rows, plain_alignment([t or "" for _, t in rows]))]
    assert sorted(map(str, ((r.doc_id, *(r[c] for c in columns)) for r in got.collect()))) == sorted(map(str, want))


def test_alignment_forgets_and_cuts_nothing_wrong(monkeypatch):
    texts = [t or "" for _, t in DOCS] + ODD
    whole = alignment.Aligner(*FILES)
    whole.cuts = False
    small = alignment.Aligner(*FILES)
    monkeypatch.setattr(alignment, "REMEMBERED", 20)
    monkeypatch.setattr(alignment, "TOGETHER", 3)
    a, b = whole.align(texts), {k: [] for k in ("n_a", "n_b", "n_links", "groups_sha256")}
    for t in texts:
        for k, v in b.items():
            v += list(small.align([t])[k])
    assert all(list(a[k]) == v for k, v in b.items())


def test_alignment_of_an_empty_table(spark):
    assert alignment.align_corpus(frame(spark, []), FILES).collect() == []
    assert [tuple(r) for r in alignment.align_corpus(frame(spark, [(1, None)]), FILES).select("n_a", "n_links", "groups_sha256").collect()] == [(0, 0, "")]


# ---- 13 ----------------------------------------------------------------

def plain_nearest(rows, every, k):
    good = [(i, np.array(v, np.float64)) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in good:
        if i % every == 0:
            scores = {}
            for j, c in good:
                if j != i and len(c) == len(q):
                    s = float((q * c).sum() / (np.sqrt((q * q).sum()) * np.sqrt((c * c).sum())))
                    scores[j] = max(s, scores.get(j, -9))
            out[i] = sorted(((-round(s, 12), j) for j, s in scores.items()))[:k]
    return out


def vectors(seed, n=900, d=24):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(6, d))
    x = np.concatenate([rnd.normal(size=(n // 3, d)), centres[rnd.integers(0, 6, n - n // 3)] + 0.03 * rnd.normal(size=(n - n // 3, d))])
    x[-40:] = x[-1]  # a vector that many rows share
    x[-60:-40] = 2 * x[-1]
    rows = [(int(i), [float(np.float32(y)) for y in v]) for i, v in zip(rnd.permutation(n), x)]
    return rows + [(n, None), (n + 1, []), (n + 2, [0.0] * d), (n + 3, [float("nan")] * d), (n + 4, [None] * d), (None, rows[0][1]),
                   (n + 5, [1.0, 2.0]), (n + 10, [1.0, 2.1]), (n + 15, [float("inf")] * d), rows[3], rows[3]]


@pytest.mark.parametrize("block,scanned", [(1 << 14, 1 << 14), (16, 7)])
def test_nearest_reach_brute_force(spark, monkeypatch, block, scanned):
    monkeypatch.setattr(nearest, "BLOCK", block)
    monkeypatch.setattr(nearest, "SCANNED", scanned)
    rows = vectors(4)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for name in ("v", "key", "rank", "score", "bucket", "parts", "dim"):
        df = df.withColumn(name, F.lit("clash"))
    got = {}
    for r in nearest.nearest(df, F.col("vec_id") % 5 == 0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    want = plain_nearest(rows, 5, 5)
    want = {q: w for q, w in want.items() if w}
    assert set(got) == set(want)
    hit = total = 0
    for q, w in want.items():
        assert sorted(got[q]) == list(range(1, len(w) + 1))
        order = [(-s, i) for _, (i, s) in sorted(got[q].items())]
        assert order == sorted(order) and len({i for _, i in order}) == len(order)
        assert all(abs(dict((j, s) for s, j in w).get(i, s) - s) < 1e-9 for s, i in order)
        hit += len({i for _, i in order} & {j for _, j in w})
        total += len(w)
    assert hit / total >= 0.95


def test_probing_finds_every_code_within_the_radius(spark):
    rnd = np.random.default_rng(5)
    base = rnd.normal(size=32)
    rows = [(i, [float(y) for y in base + 0.05 * rnd.normal(size=32)]) for i in range(300)]
    kept = nearest.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    coded = nearest.with_codes(kept, nearest.fit(kept, [32], 64)).cache()
    codes = {r.vec_id: r.parts for r in coded.collect()}
    queries = coded.where("vec_id % 10 = 0").withColumn("key", F.col("vec_id"))
    got = {(r.key, r.vec_id) for r in nearest._probe(queries, coded, 64, 300, 7).collect()}
    far = lambda a, b: sum(bin(x ^ y).count("1") for x, y in zip(codes[a], codes[b]))
    assert got == {(q, c) for q in range(0, 300, 10) for c in range(300) if q != c and far(q, c) <= 7} and got


def test_nearest_of_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert nearest.nearest(spark.createDataFrame([], schema), F.lit(True)).collect() == []
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0])], schema)
    got = [tuple(r) for r in nearest.nearest(few, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 2, 1.0), (0, 2, 1, 0.0)]
