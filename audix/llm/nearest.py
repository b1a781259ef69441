"""Approximate nearest neighbours by multi-index hashing (operator 13).

1. *Codes.* A rotation per vector length is learned on a bounded sample (``SAMPLE`` vectors of least hash, ``SAMPLE_CELLS`` components in all):
   principal directions, then alternately signs and the orthogonal matrix nearest to them. A vector's
   code is the signs of its rotated components, ``SUBSTRINGS`` substrings of ``log2(rows)`` bits, 16 at least.
2. *Index.* Every row stands in one bucket per substring. A query probes, per substring, the buckets whose value
   differs from its own in at most ``RADIUS // SUBSTRINGS`` bits; by the pigeonhole principle these hold every code
   within Hamming distance ``RADIUS``. Rows and queries meet bucket by bucket; a bucket is cut into
   blocks of ``BLOCK`` rows, each of which meets the bucket's queries by itself and hands on its best ``k`` only.
   Codes beyond the radius are dropped, the others reranked by the cosine of the vectors themselves.
3. *Stop rule.* A neighbour at angle t differs from the query in about Binomial(bits, t / pi) bits. A query is done when
   a neighbour as near as its k-th would lie within the radius but for a probability of ``MISS``.
4. *The rest.* Queries that would need a wider radius (neighbours so far away that most buckets would be
   probed) are compared with every row, in blocks of ``SCANNED`` queries sent to a map over the rows, which keeps the
   best ``k`` of each query per task. So their result is exact; nothing is capped.

Of rows with one and the same vector only the ``k + 1`` of least id can be among the nearest of a query; the others are queries, but no
candidates. They are cut off inside each task before the shuffle.

Defined cases: null ids take no part, neither do vectors that are null, empty or zero or hold a null or
non-finite component; vectors of different lengths never meet; a query is a distinct pair of id and vector and
its own rows are those with its id; of rows that repeat id and vector one is a candidate, rows that repeat an id with another
vector are candidates of their own; equal scores go to the smaller id; with fewer than ``k`` candidates all are
returned; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from audix.llm.bits import bit_table, with_bit
from audix.llm.common import join_counted, staged

SUBSTRINGS = 4
RADIUS = 7
#: Chance that a neighbour as near as the k-th lies outside the radius.
MISS = 0.02
#: Vectors of one length that a rotation is learned on, and the components that all of them may have.
SAMPLE, SAMPLE_CELLS = 10_000, 1 << 22
#: Rows of a block of a bucket; queries of a pass over all rows.
BLOCK, SCANNED = 1 << 14, 1 << 14
#: Scores held at a time.
CELLS = 1 << 21
#: Scores nearer than this to the k-th best are computed again, the same way for every pair.
SLACK = 1e-9
#: Vector lengths of one table; more are an error.
LENGTHS = 64

_HITS = "key bigint, vec_id bigint, score double"


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, v and dim of the rows that take part."""
    v = F.col("v")
    return (rows.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("v"))
            .where(F.col("vec_id").isNotNull() & v.isNotNull())
            .where(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
            .withColumn("dim", F.size("v")))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of one length, as doubles scaled by powers of two (cosines stay the same to the bit)."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def learn_rotation(x: np.ndarray, bits: int, rounds: int = 25) -> np.ndarray:
    """``bits`` directions: rotations of the principal directions that bring the signs near the components."""
    x = x / _norms(x)[:, None]
    principal = np.linalg.svd(x.T @ x)[0][:, :bits]
    out, y = [], x @ principal
    for turn in range(math.ceil(bits / principal.shape[1])):
        r = np.linalg.qr(np.random.default_rng(turn).normal(size=(y.shape[1],) * 2))[0]
        for _ in range(rounds):
            u, _, vt = np.linalg.svd(y.T @ np.where(y @ r >= 0, 1.0, -1.0))
            r = u @ vt
        out.append(principal @ r)
    return np.concatenate(out, axis=1)[:, :bits]


def fit(rows: DataFrame, dims: list[int], bits: int) -> dict[int, np.ndarray]:
    """The directions of every vector length, from its vectors of least hash (a bounded number)."""
    model = {}
    for d in dims:
        most = max(1, min(SAMPLE, SAMPLE_CELLS // d))
        least = rows.where(F.col("dim") == d).orderBy(F.xxhash64("v", "vec_id")).limit(most).select("v")
        model[d] = learn_rotation(_matrix(least.toArrow().column(0).combine_chunks()), bits)
    return model


def with_codes(rows: DataFrame, model: dict[int, np.ndarray]) -> DataFrame:
    """``rows`` (vec_id, v, dim) and ``parts``, the substrings of the code as integers."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for d in np.unique(dims):
                own = batch.filter(pa.array(dims == d))
                sign = _matrix(own.column(1)) @ sent.value[int(d)] >= 0
                width = sign.shape[1] // SUBSTRINGS
                parts = sign.reshape(-1, width) @ (1 << np.arange(width))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.ListArray.from_arrays(pa.array(np.arange(0, len(parts) + 1, SUBSTRINGS), pa.int32()),
                                                            pa.array(parts.astype(np.int32)))], [*own.schema.names, "parts"])

    kind = rows.schema["v"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id bigint, v {kind}, dim int, parts array<int>")


def _best(key: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best of each key, ties to the smaller id; a candidate found twice counts once."""
    order = np.lexsort((ids, -score, key))
    key, ids, score = key[order], ids[order], score[order]
    once = np.ones(len(key), bool)
    once[1:] = (key[1:] != key[:-1]) | (ids[1:] != ids[:-1]) | (score[1:] != score[:-1])
    order, key = order[once], key[once]
    first = np.flatnonzero(np.diff(key, prepend=key[:1] - 1))
    return order[np.arange(len(key)) - np.repeat(first, np.diff(np.append(first, len(key)))) < k]


def _rerank(q: np.ndarray, c: np.ndarray, near: np.ndarray, k: int, floor: np.ndarray | None = None):
    """(query, candidate, cosine) of every near pair that can be among a query's ``k`` best."""
    qn, cn = _norms(q), _norms(c)
    score = np.where(near, (q / qn[:, None]) @ (c / cn[:, None]).T, -np.inf)
    at = max(score.shape[1] - k, 0)
    least = np.partition(score, at, axis=1)[:, at]
    if floor is not None:
        least = np.maximum(least, floor)
    i, j = np.nonzero(near & (score >= least[:, None] - SLACK))
    exact = np.empty(len(i))
    for lo in range(0, len(i), 1 << 14):
        a, b = i[lo:lo + (1 << 14)], j[lo:lo + (1 << 14)]
        exact[lo:lo + (1 << 14)] = (q[a] * c[b]).sum(axis=1) / (qn[a] * cn[b])
    return i, j, exact


def _hits(key, ids, score) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(ids), pa.array(score)], ["key", "vec_id", "score"])


def _meet(k: int, radius: int):
    """Rows sorted by (bucket, block, dim, side): candidates of a block, then its queries in stretches."""
    def run(batches):
        group, held = None, []
        for batch in batches:
            bucket, block, dim, side = (batch.column(c).to_numpy() for c in range(4))
            turn = np.ones(batch.num_rows, bool)
            for x in (bucket, block, dim, side):
                turn[1:] &= x[1:] == x[:-1]
            turn[1:] = ~turn[1:]
            starts = np.flatnonzero(turn)
            for lo, hi in zip(starts, np.append(starts[1:], batch.num_rows)):
                here = bucket[lo], block[lo], dim[lo]
                if here != group:
                    group, held = here, []
                own = batch.slice(lo, hi - lo)
                ids, v, parts = own.column(5).to_numpy(), own.column(6), own.column(7)
                if side[lo] == 0:
                    held.append((ids, _matrix(v), parts.flatten().to_numpy().reshape(hi - lo, -1)))
                    continue
                if not held:
                    continue
                if len(held) > 1:
                    held = [tuple(np.concatenate(x) for x in zip(*held))]
                found, c, code = held[0]
                key, q, own_code = own.column(4).to_numpy(), _matrix(v), parts.flatten().to_numpy().reshape(hi - lo, -1)
                step = max(1, CELLS // len(found))
                for at in range(0, hi - lo, step):
                    part = slice(at, at + step)
                    apart = sum(np.bitwise_count(own_code[part, None, j] ^ code[None, :, j]).astype(np.int16) for j in range(code.shape[1]))
                    i, j, score = _rerank(q[part], c, (apart <= radius) & (ids[part, None] != found[None, :]), k)
                    if len(i):
                        keep = _best(key[part][i], found[j], score, k)
                        yield _hits(key[part][i][keep], found[j][keep], score[keep])
    return run


def _scan(queries: dict[int, tuple], k: int):
    """The best ``k`` rows of a task for each of the sent queries."""
    def run(batches):
        tops = {d: [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.full(len(q[0]), -np.inf)]
                for d, q in queries.value.items()}
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                dims = batch.column(2).to_numpy()
                for d in np.unique(dims):
                    if d not in tops:
                        continue
                    own = batch.filter(pa.array(dims == d))
                    ids, c = own.column(0).to_numpy(), _matrix(own.column(1))
                    _, vec, q = queries.value[d]
                    row, found, score, floor = tops[d]
                    step = max(1, CELLS // len(ids))
                    new = []
                    for lo in range(0, len(vec), step):
                        part = slice(lo, lo + step)
                        i, j, exact = _rerank(q[part], c, vec[part, None] != ids[None, :], k, floor[part])
                        new.append((i + lo, ids[j], exact))
                    row, found, score = (np.concatenate([a, *b]) for a, b in zip((row, found, score), zip(*new)))
                    keep = _best(row, found, score, k)
                    row, found, score = row[keep], found[keep], score[keep]
                    last = np.append(row[1:] != row[:-1], True)[:len(row)]
                    full = np.bincount(row, minlength=len(vec)) == k
                    floor = np.full(len(vec), -np.inf)
                    floor[row[last]] = score[last]
                    tops[d] = [row, found, score, np.where(full, floor, -np.inf)]
        for d, (row, found, score, _) in tops.items():
            yield _hits(queries.value[d][0][row], found, score)
    return run


def sure_cosine(bits: int, radius: int, miss: float = MISS) -> float:
    """Least cosine at which a code differs in more than ``radius`` of ``bits`` bits with a chance of at most ``miss``."""
    lo, hi = 0.0, 1.0
    for _ in range(50):
        p = (lo + hi) / 2
        beyond = 1 - sum(math.comb(bits, x) * p ** x * (1 - p) ** (bits - x) for x in range(radius + 1))
        lo, hi = (p, hi) if beyond <= miss else (lo, p)
    return math.cos(math.pi * lo)


def _top(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    return hits.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _probe(queries: DataFrame, candidates: DataFrame, bits: int, k: int, radius: int) -> DataFrame:
    """key, vec_id, score of the best of each query among the codes within the radius."""
    spark = queries.sparkSession
    width = bits // SUBSTRINGS
    masks = [sum(1 << b for b in flip) for n in range(radius // SUBSTRINGS + 1) for flip in combinations(range(width), n)]
    spread = queries.select("key", "vec_id", "v", "dim", "parts", F.posexplode("parts").alias("j", "value"))
    probes = spread.withColumn("mask", F.explode(F.array(*[F.lit(m) for m in masks])))
    bucket = F.xxhash64("dim", "j", F.col("value").bitwiseXOR(F.col("mask"))).alias("bucket")
    probes = probes.select(bucket, "key", "vec_id", "v", "dim", "parts")
    asked = bit_table(probes.select("bucket"))
    entries = (candidates.select("vec_id", "v", "dim", "parts", F.posexplode("parts").alias("j", "value"))
               .select(F.xxhash64("dim", "j", "value").alias("bucket"), F.lit(0).cast("bigint").alias("key"), "vec_id", "v", "dim", "parts"))
    entries = with_bit(entries.withColumn("_hash", F.col("bucket")), asked, True).drop("_hash")

    wide = entries.groupBy("bucket").count().where(F.col("count") > BLOCK)
    wide = staged(spark, wide.select("bucket", F.ceil(F.col("count") / BLOCK).alias("blocks")), "wide-buckets")
    bits_of = bit_table(wide.select("bucket"))

    def blocks(rows: DataFrame, blocks_of: Column) -> DataFrame:
        """Rows and their block; only rows of a wide bucket (or of its bit) meet the table of wide buckets."""
        hashed = rows.withColumn("_hash", F.col("bucket"))
        some = join_counted(with_bit(hashed, bits_of, True), wide, "bucket", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("bigint")))
        return (with_bit(hashed, bits_of, False).withColumn("block", F.lit(0).cast("bigint"))
                .unionByName(some.withColumn("block", blocks_of).drop("blocks")).drop("_hash"))

    columns = ["bucket", "block", "dim", "side", "key", "vec_id", "v", "parts"]
    left = blocks(entries, F.pmod(F.xxhash64("vec_id", "v"), F.col("blocks"))).withColumn("side", F.lit(0))
    right = blocks(probes, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))).withColumn("side", F.lit(1))
    work = (left.select(columns).union(right.select(columns)).repartition("bucket", "block")
            .sortWithinPartitions("bucket", "block", "dim", "side"))
    return work.mapInArrow(_meet(k, radius), _HITS)


def _compare_all(queries: DataFrame, candidates: DataFrame, k: int) -> list[DataFrame]:
    """The best ``k`` of every task for each query, block of queries by block."""
    spark, out = queries.sparkSession, []
    blocks = math.ceil(queries.count() / SCANNED)
    for b in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b).select("key", "vec_id", "v", "dim").toArrow()
        dims = block.column("dim").to_numpy()
        parts = {}
        for d in np.unique(dims):
            own = block.filter(pa.array(dims == d))
            parts[int(d)] = (own.column("key").to_numpy(), own.column("vec_id").to_numpy(), _matrix(own.column("v").combine_chunks()))
        sent = spark.sparkContext.broadcast(parts)
        out.append(staged(spark, candidates.select("vec_id", "v", "dim").mapInArrow(_scan(sent, k), _HITS), "scanned"))
        sent.unpersist()
    return out


def nearest(rows: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
            radius: int = RADIUS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows of largest cosine of each query.

    ``is_query`` is a condition on ``vec_id``; every row is indexed.
    """
    spark = rows.sparkSession
    kept = usable(rows, id_col, vector_col)
    sizes = kept.groupBy("dim").count().limit(LENGTHS + 1).collect()
    if len(sizes) > LENGTHS:
        raise ValueError(f"vectors of more than {LENGTHS} lengths")
    bits = SUBSTRINGS * min(30, max(16, math.ceil(math.log2(max([1, *(r["count"] for r in sizes)])))))
    coded = staged(spark, with_codes(kept, fit(kept, [r["dim"] for r in sizes], bits)), "codes")
    same = Window.partitionBy(F.xxhash64("v"), "v").orderBy("vec_id")
    candidates = staged(spark, coded.dropDuplicates(["vec_id", "v"]).withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1).drop("n"), "candidates")
    queries = staged(spark, coded.where(is_query).dropDuplicates(["vec_id", "v"])
                     .withColumn("key", F.monotonically_increasing_id()), "queries")

    found = staged(spark, _top(_probe(queries, candidates, bits, k, radius), k), "probed")
    done = found.where((F.col("rank") == k) & (F.col("score") >= sure_cosine(bits, radius))).select("key")
    parts = [found.join(done, "key", "left_semi").drop("rank"),
             *_compare_all(staged(spark, queries.join(done, "key", "left_anti"), "left"), candidates, k)]
    hits = parts[0].select("key", "vec_id", "score")
    for p in parts[1:]:
        hits = hits.union(p)
    return (_top(hits, k).join(queries.select("key", F.col("vec_id").alias("query_id")), "key")
            .select("query_id", "rank", "vec_id", "score"))
