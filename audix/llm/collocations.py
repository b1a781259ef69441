"""Phrase collocation mining by multikey quicksort of suffix pointers (operator 11).

1. *Words.* Texts are cut into pieces and words; word counts per language are summed inside a task, then by one
   grouped sum. A word's key is a 64-bit hash of language and word; two frequent words with one key are an error.
2. *Routing.* Every word starts a suffix of up to three words of its piece. Equal suffixes of a task are merged first, with
   their number, then suffixes are routed by their leading word, so a route holds all suffixes of its words. A heavy leading word
   (its bit is set in a table of fixed size) is routed by two words for the counts of pairs and by three words for those of
   triples, so a frequent word or pair is spread, and after merging a phrase has one row per task at most.
3. *Quicksort.* A route's suffix pointers are partitioned three ways by the word at the present depth: smaller, equal,
   larger; the equal part goes on one word deeper, to depth three. Its size is the phrase's count. A part
   whose suffixes are fewer than the least count is abandoned: what it holds is complete, so no phrase in it is frequent.
   Parts of up to ``SMALL`` pointers are ordered at once by all words left.
4. *Scores* come from joins of the frequent phrases with each other and with the frequent words; products are
   decimals of 38 digits.

Defined cases: null and empty texts have no words; a null language is ``und``; phrases never cross a piece or a text; rows that
repeat an id count as often as they stand; a language without candidates gives no rows; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from audix.llm import textvec
from audix.llm.bits import bit_table, is_set
from audix.llm.common import join_counted, releasing, staged

#: Suffixes of a route, on average, and the count from which a leading word is heavy.
ROUTE, HEAVY = 1 << 18, 1 << 17
ROUTES = 64
#: Suffixes merged together in a task; words counted in a task before they are handed on.
HELD, WORDS_HELD = 1 << 18, 1 << 17
#: Largest part that is ordered at once.
SMALL = 1 << 16
#: Unknown-language label of null.
NO_LANG = "und"
PHRASES = pa.schema([(name, pa.int64()) for name in ("k1", "k2", "k3", "f")])

_bytes = np.arange(256)
#: Bytes that end a piece: . , ; : ! ? and line breaks.
ENDS_PIECE = np.isin(_bytes, list(b".,;:!?")) | ((_bytes >= 10) & (_bytes <= 13))
IN_WORD = ~(ENDS_PIECE | (_bytes == 32) | (_bytes == 9))
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _blocks(batches):
    """Block by block: the words, their keys, and the language (number and names) of each."""
    for batch in textvec.small_batches(batches):
        langs, texts = batch.column(0).to_pylist(), textvec.raw_texts(batch.column(1))
        names, number = np.unique(np.array(langs, object), return_inverse=True) if langs else ([], np.empty(0, np.int64))
        seed = np.array([xxhash.xxh64_intdigest(x.encode()) for x in names], np.uint64)
        for w in textvec.blocks(texts, IN_WORD, fold=True):
            lang = number[w.first + w.doc]
            key = textvec.mix(w.hashes ^ seed[lang])
            yield w, np.where(key == 0, np.uint64(1), key), lang, names


def _merged(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """(key, lang, word, n) rows with each key and language once."""
    key, lang, word, n = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((word, lang, key))
    key, lang, word, n = key[order], lang[order], word[order], n[order]
    first = np.ones(len(key), bool)
    first[1:] = (key[1:] != key[:-1]) | (word[1:] != word[:-1]) | (lang[1:] != lang[:-1])
    return key[first], lang[first], word[first], np.add.reduceat(n, np.flatnonzero(first))


@releasing
def _count_words(batches):
    held, size = [], 0

    def rows(x):
        return pa.RecordBatch.from_arrays([pa.array(x[0].view(np.int64)), pa.array(x[1], pa.string()), pa.array(x[2], pa.string()),
                                           pa.array(x[3])], ["key", "lang", "word", "n"])

    for w, key, lang, names in _blocks(batches):
        _, first, n = np.unique(key, return_index=True, return_counts=True)
        text = w.buffer.tobytes()
        word = np.array([text[a:b].lower().decode() for a, b in zip(w.starts[first].tolist(), w.ends[first].tolist())], object)
        held.append((key[first], np.array(names, object)[lang[first]] if len(first) else np.empty(0, object), word, n))
        size += len(first)
        if size > WORDS_HELD:
            held = [_merged(held)]
            size = len(held[0][0])
            if 2 * size > WORDS_HELD:
                yield rows(held[0])
                held, size = [], 0
    if size:
        yield rows(_merged(held))


def partitions(keys: list[np.ndarray], weight: np.ndarray, least: int):
    """Multikey three-way quicksort of pointers into ``keys`` (one array per depth).

    Yields (depth, pointers, bounds): stretches of pointers, each of which is one equal part at ``depth``. Parts whose
    weight is below ``least`` are abandoned.
    """
    p, top = np.arange(len(weight)), len(keys) - 1
    todo = [(0, len(p), 0)]
    while todo:
        lo, hi, d = todo.pop()
        own = p[lo:hi]
        if not len(own) or weight[own].sum() < least:
            continue
        if len(own) <= SMALL:
            own = own[np.lexsort([k[own] for k in keys[:d - 1 if d else None:-1]])]
            new = np.zeros(len(own), bool)
            for depth in range(d, top + 1):
                x = keys[depth][own]
                new[1:] |= x[1:] != x[:-1]
                new[0] = True
                yield depth, own, np.append(np.flatnonzero(new), len(own))
            continue
        x = keys[d][own]
        some = x[::max(1, len(x) // 999)]
        pivot = np.partition(some, len(some) // 2)[len(some) // 2]
        below, equal = x < pivot, x == pivot
        parts = own[below], own[equal], own[~(below | equal)]
        p[lo:hi] = np.concatenate(parts)
        a, b = lo + len(parts[0]), lo + len(parts[0]) + len(parts[1])
        yield d, parts[1], np.array([0, len(parts[1])])
        todo += [(lo, a, d), (b, hi, d)] + ([(a, b, d + 1)] if d < top else [])


def _merge_suffixes(keys: list[np.ndarray], weight: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal suffixes as one, with the sum of their weights, in order."""
    at, total = [], []
    for depth, own, bounds in partitions(keys, weight, 1):
        if depth == len(keys) - 1:
            at.append(own[bounds[:-1]])
            total.append(np.add.reduceat(weight[own], bounds[:-1]))
    at, total = np.concatenate(at), np.concatenate(total)
    order = np.lexsort([k[at] for k in keys[::-1]])
    return [k[at[order]] for k in keys], total[order]


def _route_suffixes(heavy, routes: int):
    """Packed suffixes (three keys, 0 where the piece ends, and a number) by route; a negative number
    marks a suffix that counts at depth three only."""
    def packed(held):
        keys, n = _merge_suffixes([np.concatenate(x) for x in zip(*held)], np.ones(sum(len(h[0]) for h in held), np.int64))
        hot = is_set(heavy.value, keys[0].view(np.int64))
        start = [i for i, k in enumerate(keys) if i < 2]
        # Heavy leading words: one row per pair, and one per triple that counts at depth three only.
        pairs, pair_n = _merge_suffixes([keys[i][hot] for i in start], n[hot]) if hot.any() else ([k[:0] for k in keys[:2]], n[:0])
        deep = hot & (keys[2] != 0)
        k1, k2, k3 = (np.concatenate([a[~hot], b, a[deep]]) for a, b in zip(keys, [*pairs, np.zeros(len(pair_n), np.uint64)]))
        n = np.concatenate([n[~hot], pair_n, -n[deep]])
        lead = k1.copy()
        at = slice(int((~hot).sum()), len(lead))
        lead[at] = textvec.mix(k1[at] * _A + k2[at])
        at = slice(at.start + len(pair_n), len(lead))
        lead[at] = textvec.mix(lead[at] * _B + k3[at])
        route = (textvec.mix(lead) % np.uint64(routes)).astype(np.int64)
        order = np.argsort(route, kind="stable")
        cuts = np.searchsorted(route[order], np.arange(routes + 1))
        for r in np.flatnonzero(np.diff(cuts)):
            own = order[cuts[r]:cuts[r + 1]]
            yield int(r), b"".join([k1[own].tobytes(), k2[own].tobytes(), k3[own].tobytes(), n[own].astype(np.int32).tobytes()])

    def rows(held):
        found = list(packed(held))
        return pa.RecordBatch.from_arrays([pa.array([r for r, _ in found], pa.int64()), pa.array([b for _, b in found], pa.binary())],
                                          ["route", "packed"])

    @releasing
    def run(batches):
        held, size = [], 0
        for w, key, _, _ in _blocks(batches):
            place = np.cumsum(ENDS_PIECE[w.buffer], dtype=np.int64)[w.starts] + w.doc
            second, third = np.zeros((2, len(key)), np.uint64)
            same = place[1:] == place[:-1]
            second[:-1][same] = key[1:][same]
            same = place[2:] == place[:-2]
            third[:-2][same] = key[2:][same]
            keep = second != 0
            held.append((key[keep], second[keep], third[keep]))
            size += int(keep.sum())
            if size > HELD:
                yield rows(held)
                held, size = [], 0
        if size:
            yield rows(held)
    return run


def _unpack(data: list[pa.Buffer]) -> tuple[list[np.ndarray], np.ndarray]:
    keys, n = ([], [], []), []
    for b in data:
        m = len(b) // 28
        for i in range(3):
            keys[i].append(np.frombuffer(b, np.uint64, m, 8 * m * i))
        n.append(np.frombuffer(b, np.int32, m, 24 * m))
    return [np.concatenate(k) for k in keys], np.concatenate(n).astype(np.int64)


def _count_route(data: list[pa.Buffer], least: int):
    """k1, k2, k3 (0: a pair) and f of the frequent phrases of a route."""
    keys, n = _unpack(data)
    weight = np.abs(n)
    at_depth = {1: np.where(n > 0, weight, 0), 2: np.where(keys[2] != 0, weight, 0)}
    for depth, own, bounds in partitions(keys, weight, least):
        if depth:
            f = np.add.reduceat(at_depth[depth][own], bounds[:-1])
            at = own[bounds[:-1]][f >= least]
            if len(at):
                third = keys[2][at] if depth == 2 else np.zeros(len(at), np.uint64)
                yield pa.RecordBatch.from_arrays([*(pa.array(x.view(np.int64)) for x in (keys[0][at], keys[1][at], third)),
                                                  pa.array(f[f >= least])], schema=PHRASES)


def _count_routes(least: int):
    """A route's frequent phrases; a group goes to a worker by itself, so that no more than a route is held there or on its way."""
    def run(route: pa.Table) -> pa.Table:
        found = list(_count_route([x.as_buffer() for x in route.column("packed")], least))
        pa.default_memory_pool().release_unused()
        return pa.Table.from_batches(found, PHRASES)
    return run


def phrase_counts(docs: DataFrame, least: int, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words (key, lang, word, n), word totals (lang, n) and frequent phrases (k1, k2, k3, f; k3 is 0 for pairs)."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit(NO_LANG)).alias("lang"), F.col(text_col).alias("text"))
    words = staged(spark, rows.mapInArrow(_count_words, "key bigint, lang string, word string, n bigint")
                   .groupBy("key", "lang", "word").agg(F.sum("n").alias("n")), "words")
    clash = words.groupBy("key").agg(F.count("*").alias("c"), F.sum("n").alias("n")).where((F.col("c") > 1) & (F.col("n") >= least))
    if not clash.isEmpty():
        raise ValueError("two words share a hash")
    total = words.agg(F.sum("n")).first()[0] or 0
    routes = max(ROUTES, math.ceil(total / ROUTE))
    heavy = spark.sparkContext.broadcast(bit_table(words.where(F.col("n") >= HEAVY).select("key")))
    routed = rows.mapInArrow(_route_suffixes(heavy, routes), "route bigint, packed binary")
    phrases = routed.groupBy("route").applyInArrow(_count_routes(least), "k1 bigint, k2 bigint, k3 bigint, f bigint")
    return words, words.groupBy("lang").agg(F.sum("n").alias("n")), staged(spark, phrases, "phrases")


def _score(a: str, left: str, right: str) -> Column:
    wide = [f"cast({c} AS decimal(38,0))" for c in (a, left, right)]
    return F.expr(f"cast(1000000 AS decimal(38,0)) * {wide[0]} * {wide[0]} div ({wide[1]} * {wide[2]})")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases of two and three words."""
    words, totals, phrases = phrase_counts(docs, least, text_col, lang_col)
    frequent = words.where(F.col("n") >= least)

    def word(i: int) -> DataFrame:
        langs = [F.col("lang")] if i == 1 else []
        return frequent.select(F.col("key").alias(f"k{i}"), F.col("word").alias(f"w{i}"), F.col("n").alias(f"f{i}"), *langs)

    pairs = phrases.where("k3 = 0").drop("k3")
    triples = phrases.where("k3 <> 0")
    inside = triples.select("k1", "k2", "f").union(triples.select("k2", "k3", "f")).groupBy("k1", "k2").agg(F.max("f").alias("longer"))
    two = (pairs.join(inside, ["k1", "k2"], "left").where(F.coalesce(100 * F.col("longer") < 50 * F.col("f"), F.lit(True)))
           .join(word(1), "k1").join(word(2), "k2")
           .select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("f").alias("a"), F.col("f1").alias("l"),
                   F.col("f2").alias("r"), _score("f", "f1", "f2").alias("score")))
    three = (triples.join(pairs.select("k1", "k2", F.col("f").alias("f12")), ["k1", "k2"])
             .join(pairs.select(F.col("k1").alias("k2"), F.col("k2").alias("k3"), F.col("f").alias("f23")), ["k2", "k3"])
             .join(word(1), "k1").join(word(2), "k2").join(word(3), "k3")
             .withColumn("s1", _score("f", "f1", "f23")).withColumn("s2", _score("f", "f12", "f3")))
    first = F.col("s1") <= F.col("s2")
    three = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("f").alias("a"),
                         F.when(first, F.col("f1")).otherwise(F.col("f12")).alias("l"),
                         F.when(first, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = (two.union(three).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .withColumn("rank", F.col("rank").cast("bigint")))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
