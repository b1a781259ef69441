"""Operators 2, 5, 6 and 7."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from audix.llm import catalogue, decontaminate, pii, toxicity, url_filter
from tests.llm.helpers import DOCS, base_spans, frame

URLS = ["http://example.com/en/x", "http://www.example.com/en/x", "https://a.www.EXAMPLE.com/en/", "ftp://example.com",
        "http://example.com/EN/", "http://x.net/es/1?q=/fr/", "http://net/fr/", "http://xnet/fr/", "no scheme", "", None,
        "http://spam-farm.org/a", "http://spamfarm.org/a", "http://casino.net/es/", "http://h.org/shop/cart", "a://b://c.com/",
        "http://c.com?x=/", "http://c.com#/", "http://www.example.com/en", "http://c.com/"]


def plain_judgement(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = rest[:cut].lower(), rest[cut:]
        path = rest[:min([rest.index(c) for c in "?#" if c in rest] or [len(rest)])]
    hits = []
    for name, verdict in catalogue.URL_RULES:
        h, _, p = name.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            hits.append((len(name), name, verdict))
    return host, path, *(max(hits)[1:] if hits else (None, None))


def test_listed_rules_decide_first_and_longest(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS * 2)], "page_id long, url string")
    pages = pages.withColumn("_rule", F.lit("clash")).withColumn("host", F.lit(1))
    rules = [url_filter.host_rule(*r) for r in catalogue.URL_RULES] + list(url_filter.PATTERNS)
    got = {r.page_id: r for r in url_filter.filter_urls(pages, rules).collect()}
    assert len(got) == 2 * len(URLS)
    for i, url in enumerate(URLS * 2):
        host, path, rule, verdict = plain_judgement(url)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert verdict is None or got[i].verdict == verdict
    by_url = dict(zip(URLS, range(len(URLS))))
    assert got[by_url["http://spam-farm.org/a"]].verdict == "block"
    assert got[by_url["http://spamfarm.org/a"]].verdict == "allow"
    assert got[by_url["http://casino.net/es/"]].rule == "net/es/"
    assert got[by_url["http://h.org/shop/cart"]].pattern == "path:session"


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.b/")], "page_id long, url string")
    assert [r.verdict for r in url_filter.filter_urls(pages, []).collect()] == ["allow"]
    rules = [url_filter.host_rule("com/", "allow")]
    assert url_filter.filter_urls(pages.limit(0), rules).collect() == []


PRIVATE = ["a@b.c%d@e.f x@y.zz. 1.2.3.4.5.6.7.8 300.1.1.1 001.0002.3.4 +1 (234) 555-6789 call (234) 555-6789 now",
           "é😀 foo@bar.com é +49 30 1234567- 4111 1111 1111 1111 4111-1111-1111-1112 mail joe [at] site [dot] org",
           "a.a." * 800 + "@x.y" + " 1" * 3000 + "b" * 20000 + "@c.d" + ".e" * 3000,
           "+12345678 +123456789 ++1-2-3-4-5-6-7-8-9-1-2-3-4-5-6 " + "1" * 20 + " " + "4" * 13 + " 4012888888881881",
           "@a.b c@ @ a@b a@b.c.d-e..f 1.1.1 9.9.9.9.9 ٣.1.1.1.1 foo@bar.com", "+1 (2) 3.4-5 6 7 8 9) +1 2-"]


def test_base_spans_stay(spark):
    rows = [(100 + i, t) for i, t in enumerate(PRIVATE)] + DOCS
    got = pii.digest(pii.find(frame(spark, rows))).collect()
    assert len(got) == len(rows)
    want = sorted((str(k), hashlib.sha256(base_spans(t).encode()).hexdigest()) for k, t in rows)
    assert sorted((str(r.doc_id), r.base_sha256) for r in got) == want
    for r in got:
        text = dict(rows)[r.doc_id] if r.doc_id and r.doc_id >= 100 else ""
        assert set(filter(None, base_spans(text).split(","))) <= set(r.spans.split(","))
    by_id = {r.doc_id: r for r in got}
    assert "email:78:101" in by_id[101].spans.split(",")
    assert pii.digest(pii.find(frame(spark, []))).collect() == []


def test_redaction_cuts_overlapping_spans_of_all_kinds_whole(spark):
    long = "".join(f"{i}\U0001F600 a{i}@x{i}.org, " for i in range(300)) + "end"
    texts = ["call +33.1.42.68.53.00 now", "+4222222222222.12", "1.2.3.4@mail.com!", "a@b.org+33.1.42.68.53.00x@y.de",
             "host 10.0.0.1 and +4222222222222.12 \U0001F600 a@b.org", "1:2:3:4:5:6:7:8.1.2.3", "", None, "nothing", long]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    spans = {r.doc_id: r.spans for r in pii.find(df).collect()}
    got = {r.doc_id: r.text for r in pii.redact(df).collect()}
    for i, text in enumerate(texts):
        want, done = "", 0
        for s in sorted(spans[i], key=lambda s: (s.start, -s.end, s.kind)):
            if s.start >= done:
                want += text[done:s.start] + f"[{pii.KINDS[s.kind].name.upper()}]"
            done = max(done, s.end)
        assert got[i] == (None if text is None else want + text[done:])
    assert got[0] == "call [PHONE] now" and got[1] == "[PHONE]" and got[2] == "[EMAIL]!"
    opened = spark.createDataFrame([(0, "4222222222222.1.2.3.4"), (1, "+(123456789).4222222222222 c@d.e")], "doc_id int, text string")
    assert all(base_spans(r.text) == "" for r in pii.redact(opened).collect())
    assert got[9] == "".join(f"{i}\U0001F600 [EMAIL], " for i in range(300)) + "end"


def test_redaction_leaves_no_base_span(spark):
    rows = [(100 + i, t) for i, t in enumerate(PRIVATE)] + DOCS
    df = frame(spark, rows)
    out = pii.redact(df)
    assert out.columns == df.columns
    got = out.collect()
    assert len(got) == len(rows)
    assert all(base_spans(r.text) == "" for r in got)
    kept = {t for k, t in DOCS}
    assert kept <= {r.text for r in got}


def test_em_finds_the_unreliable_labeler():
    rnd = random.Random(2)
    counts = {}
    for _ in range(4000):
        y = rnd.random() < 0.6
        vote = lambda right: int(y if rnd.random() < right else not y)
        p = (0, vote(0.95), vote(0.9), vote(0.5), vote(0.9), vote(0.85), 1)
        counts[p] = counts.get(p, 0) + 1
    says = pii.train(counts).reliability[0]["says"]
    assert says["strict", 1, 1] > 0.9 and says["strict", 0, 0] > 0.9
    assert abs(says["context", 1, 1] - says["context", 0, 1]) < 0.1


def plain_distance(p, t):
    row = list(range(len(p) + 1))
    best = row[-1]
    for c in t:
        left, row = row, [0]
        for i, x in enumerate(p, 1):
            row.append(min(left[i] + 1, row[-1] + 1, left[i - 1] + (x != c)))
        best = min(best, row[-1])
    return best


def test_myers_is_edit_distance():
    rnd = random.Random(3)
    for _ in range(300):
        p = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 90)))
        t = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 120)))
        assert decontaminate.myers(p, t)[0] == plain_distance(p, t)


@pytest.mark.parametrize("block_bytes", [1 << 20, 150])
def test_leaks_with_edits_are_found(spark, block_bytes):
    rnd = random.Random(4)
    words = [f"{rnd.choice('abcdefgh')}{rnd.choice('xyz')}{rnd.randint(10, 99)}" for _ in range(400)]
    item = lambda: " ".join(rnd.choice(words) for _ in range(30))
    items = [(i, item()) for i in range(6)] + [(6, None), (7, ""), (8, "too short"), (9, None)]
    items.append((10, items[0][1]))
    docs, want = [], set()
    for d in range(100, 160):
        text = " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 80)))
        if d % 2:
            k = rnd.randrange(6)
            leak = list(items[k][1])
            for _ in range(rnd.choice([0, 3, 8, 30])):
                leak[rnd.randrange(len(leak))] = "#"
            text = f"{text} {''.join(leak).upper()}  {text}"
        docs.append((d, text))
    for d, text in docs:
        for k, t in items:
            if t:
                p = decontaminate.normalise(t)
                if plain_distance(p, decontaminate.normalise(text)) <= int(len(p) * decontaminate.ERROR_RATE):
                    want.add((d, k))
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = frame(spark, docs + DOCS)
    leaks = decontaminate.find_leaks(df, bench, block_bytes=block_bytes).collect()
    assert {(r.doc_id, r.item_id) for r in leaks} == want and want
    for r in leaks:
        stretch = decontaminate.normalise(dict(docs)[r.doc_id])[r.start:r.end]
        assert plain_distance(decontaminate.normalise(dict(items)[r.item_id]), stretch) <= r.distance
    clean = decontaminate.keep_clean(df, bench, block_bytes=block_bytes)
    assert clean.columns == df.columns
    assert {r.doc_id for r in clean.collect()} == {k for k, _ in docs + DOCS} - {d for d, _ in want}
    assert decontaminate.keep_clean(df, bench.limit(0)).count() == df.count()


def test_marginals_match_enumeration():
    from itertools import product
    from audix.llm import textvec
    rnd = np.random.default_rng(1)
    texts = [b"a b c d e", b"", b"f", b"a a b", b"g h " * 3]
    c = toxicity.Chains(textvec.together(texts, textvec.ALPHANUMERIC, True, toxicity.STEM))
    m = toxicity.Model(*(rnd.normal(size=toxicity.BUCKETS) for _ in range(4)), 0.3, rnd.normal(size=(2, 2)), np.zeros(4))
    got, moves = c.marginals(m, pairs=True)
    e = c.potentials(m)
    at, total_moves = 0, np.zeros((2, 2))
    for n in c.lengths:
        z, p, mv = 0.0, np.zeros(n), np.zeros((2, 2))
        for states in product((0, 1), repeat=n):
            path = [(a, b) for a, b in zip((0, *states), states)]
            w = np.exp(sum(m.moves[x] for x in path) + sum(e[at + i] for i, s in enumerate(states) if s))
            z += w
            p += w * np.array(states)
            for x in path:
                mv[x] += w
        assert np.allclose(got[at:at + n], p / z if n else [])
        total_moves += mv / z
        at += n
    assert np.allclose(moves, total_moves)


def test_long_chains_cross_segments():
    from audix.llm import textvec
    text = b" ".join(b"w%d" % (i % 7) for i in range(500))
    m = toxicity.Model(*(np.random.default_rng(2).normal(size=toxicity.BUCKETS) for _ in range(4)), 0.1,
                       np.array([[0, -1.0], [0.5, 1.0]]), np.zeros(4))
    c = toxicity.Chains(textvec.together([text], textvec.ALPHANUMERIC, True, toxicity.STEM))
    e, a = np.exp(c.potentials(m)), np.exp(m.moves)
    f, x = [], np.array([1.0, 0.0])
    for t in range(500):
        x = (x @ a) * [1, e[t]]
        x /= x.sum()
        f.append(x)
    x, want = np.ones(2), np.zeros(500)
    for t in range(499, -1, -1):
        p = f[t] * x
        want[t] = p[1] / p.sum()
        x = a @ (x * [1, e[t]])
        x /= x.sum()
    assert np.allclose(c.marginals(m), want)


def toxic_rows(n=400):
    rnd = random.Random(7)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{rnd.randint(0, 300)}" for _ in range(rnd.randint(5, 60))]
        bad = rnd.random() < 0.3
        for _ in range(rnd.randint(2, 4) if bad else 0):
            words.insert(rnd.randrange(len(words)), rnd.choice(["Vile", "grim,", "foul"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_held_out_accuracy_and_spans(spark):
    rows, labels = toxic_rows()
    marks = spark.createDataFrame(labels + [(3, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    df = frame(spark, rows + [(None, "foul foul"), (1000, None), (1001, ""), (1002, "foul " * 5000)])
    got = toxicity.toxicity(df, marks).collect()
    assert len(got) == len(rows) + 4
    truth = {k: t for k, _, t in labels}
    judged = [r.predicted == truth[r.doc_id] for r in got if r.held_out and r.doc_id in truth]
    assert len(judged) > 40 and sum(judged) / len(judged) > 0.95
    by_id = {r.doc_id: r for r in got}
    assert by_id[1000].score == by_id[1001].score < 0.5 and by_id[1002].predicted == 1
    texts = dict(rows)
    found = [texts[r.doc_id][s.start:s.end].lower() for r in got if r.doc_id in texts for s in r.spans]
    assert found and sum(any(b in f for b in ("vile", "grim", "foul")) for f in found) > 0.9 * len(found)
    kept = toxicity.keep_clean(df, marks)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if not r.predicted}


def ranks_above(scores, toxic):
    """Share of the pairs of a toxic and a clean document whose toxic one scores higher; ties count half."""
    gaps = np.subtract.outer(scores[toxic > 0], scores[toxic == 0])
    return ((gaps > 0) + 0.5 * (gaps == 0)).mean()


SUFFIXES = "pa le on vi ch an ou ment er ie pf st au ein tz".split()


@pytest.mark.parametrize("bad, clean", [("vile grim foul nasty rotten mean cruel dumb".split(), []),
                                        ([f"lousybad{e}" for e in SUFFIXES], [f"lous{e}" for e in SUFFIXES])])
def test_few_labels_rank_held_out_documents(spark, bad, clean):
    """45 labelled documents; a telling word is in few of them, or shares more than four bytes with others only."""
    rnd = random.Random(4)
    rows, truth = [], {}
    folds = sorted(range(500), key=lambda i: zlib.crc32(str(i).encode()) % 5 == 0)
    for i in folds[:45] + folds[-80:]:
        words = [f"{rnd.choice('abcdefgh')}{rnd.choice('xyz')}{rnd.randint(0, 40)}" for _ in range(rnd.randint(5, 200))]
        truth[i] = int(rnd.random() < 0.25)
        for _ in range(6):
            words.insert(rnd.randrange(len(words)), rnd.choice(bad if truth[i] else clean or words))
        rows.append((i, " ".join(words)))
    marks = spark.createDataFrame(list(truth.items()), "doc_id long, toxic int")
    got = [r for r in toxicity.toxicity(frame(spark, rows), marks).collect() if r.held_out]
    assert len(got) == 80
    assert ranks_above(np.array([r.score for r in got]), np.array([truth[r.doc_id] for r in got])) > 0.9


def test_score_does_not_fall_with_the_features():
    rnd = np.random.default_rng(3)
    x = np.column_stack([np.ones(60), rnd.normal(size=(60, 3))])
    for y in ((rnd.random(60) < 0.5) * 1.0, (x[:, 1] < 0) * 1.0, (x[:, 2] > 0) * 1.0):
        assert np.isfinite(b := toxicity.document_weights(x, y)).all() and (b[1:] >= 0).all()


def test_without_labels_nothing_is_toxic(spark):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.predicted for r in toxicity.toxicity(frame(spark, DOCS), marks).collect()] == [0] * len(DOCS)
    assert toxicity.toxicity(frame(spark, []), marks).collect() == []


def test_toxicity_trains_on_documents_up_to_32_kb(spark):
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5][:3]
    docs = spark.createDataFrame(list(zip(ids, ["x" * n for n in (100, 1 << 15, (1 << 15) + 1)])), "doc_id long, text string")
    marks = spark.createDataFrame([(i, 1) for i in ids], "doc_id long, toxic int")
    assert sorted(len(r._text) for r in toxicity.sample_labelled(docs, marks).collect()) == [100, 1 << 15]


def test_short_items(spark):
    """Items too short for an edit as whole words; from 13 characters on with their edits, against plain distance."""
    rnd = random.Random(12)
    items = [(1, "What is the capital of France?"), (2, "a b"), (3, " "), (4, "x" * 12)]
    items += [(10 + n, "".join(rnd.choice("abcdefgh ") for _ in range(n)).strip() + "." * 3) for n in range(10, 29)]
    texts = ["Q: what is  the CAPITAL of france? Paris", "What is the capitol of France?", "What is a capitel of Frence?", "a b", "ca b, a bc; a b.",
             "xa b a bx", "x" * 13, "-" + "x" * 12 + "-"]
    for _, t in items[4:]:
        for edits in range(4):
            leak = list(t)
            for _ in range(edits):
                at = rnd.randrange(len(leak))
                leak[at:at + rnd.randint(0, 1)] = rnd.choice(["#", "", "##"])
            texts.append("zz " + "".join(leak) + " zz")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for d, text in enumerate(texts):
        n = decontaminate.normalise(text)
        for k, t in items:
            p = decontaminate.normalise(t)
            budget = int(len(p) * decontaminate.ERROR_RATE)
            if p and budget and plain_distance(p, n) <= budget:
                want.add((d, k))
            elif p and not budget and any(n.startswith(p, i) and decontaminate.whole_words(n, i, i + len(p)) for i in range(len(n))):
                want.add((d, k))
    got = decontaminate.find_leaks(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(want) > 40
    assert {(0, 1), (1, 1), (3, 2), (4, 2), (7, 4)} <= want and not {(5, 2), (6, 4)} & want
    for r in got:
        p, n = decontaminate.normalise(dict(items)[r.item_id]), decontaminate.normalise(texts[r.doc_id])
        assert plain_distance(p, n[r.start:r.end]) <= r.distance == plain_distance(p, n)


def test_item_ids_keep_their_types_and_long_items_are_quick(spark):
    rnd = random.Random(2)
    long_item = "".join(rnd.choice("abcd ") for _ in range(20_000))
    matcher = decontaminate.Matcher([("k", long_item)], decontaminate.ERROR_RATE)
    t0 = time.process_time()
    (found,) = matcher.matches("pre " + long_item.replace("ab", "a#") + " post")
    assert found[0] == "k" and time.process_time() - t0 < 5
    docs = frame(spark, [(1, "the quick brown fox jumps over it"), (2, None)])
    for kind, key in (("string", "k"), ("int", 3), ("decimal(5,1)", None)):
        bench = spark.createDataFrame([(key, "the quick brown fox jumps")], f"item_id {kind}, text string")
        leaks = decontaminate.find_leaks(docs, bench)
        assert [(r.doc_id, r.item_id) for r in leaks.collect()] == [(1, key)] and leaks.schema["item_id"].dataType == bench.schema["item_id"].dataType


def test_anchored_myers_is_distance_to_a_prefix():
    rnd = random.Random(6)
    for _ in range(200):
        p = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 70)))
        t = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 90)))
        row = list(range(len(p) + 1))
        best = (row[-1], 0)
        for j, c in enumerate(t, 1):
            left, row = row, [j]
            for i, x in enumerate(p, 1):
                row.append(min(left[i] + 1, row[-1] + 1, left[i - 1] + (x != c)))
            best = min(best, (row[-1], j))
        assert decontaminate.myers(p, t, anchored=True) == best
