"""Toxic spans and document scores from a linear-chain CRF (operator 7).

Tokens are runs of letters and digits, lower-cased. The chain has the states
clean and toxic. A token's potential sums weights of itself, its first bytes (each length of ``STEM``), its left
and its right neighbour (hashed into ``BUCKETS``); transitions have a weight each.

Training takes a bounded sample of the labelled rows (``sample`` documents of at
most ``sample_bytes`` each, the first in hash order), without those that mostly
repeat an earlier one of the sample. Labelled tokens come from
labelled documents: a token of a toxic document is toxic if documents with its
type, or one of its stems, are toxic significantly more often than others. What is significant depends on the
sample: the lowest cut of ``CUTS`` above which labels dealt at random put at most a hundredth of the types found (more, if
none is found so; then the most significant). Weights follow the gradient of the
log-likelihood, with expectations from the forward-backward recursion. A small
logistic model then turns a document's marginals (their sum, largest value and
mean) into the score, which never falls as these grow.

Scoring is a map over all rows and whole texts: forward-backward marginals per
token; runs of tokens above one half are the offending spans. Chains are
cut into segments whose 2x2 products are chained per document, so that many documents move in step
and the recursion stays exact.

Defined cases: a null text scores as an empty one, an empty one by its (zero)
features; rows with equal texts score alike; null ids score, and never train;
labels that are null are ignored, of several labels of an id the
largest counts; without labels of both kinds every score is the smoothed share of toxic labels.
Other columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audix.llm import textvec
from audix.llm.common import releasing

BUCKETS = 1 << 18
SEGMENT = 64
STEM = (4, 6, 8)
#: Documents that the model is fitted on, and the longest of them in bytes.
SAMPLE, SAMPLE_BYTES = 3000, 1 << 15
#: Significances, the share of them that chance may explain (the first that finds any), and the random dealings of labels.
CUTS, CHANCE, DEALS = np.arange(5, 1.9, -0.25), (0.01, 0.1, 0.3, 1.0), 10
ROUNDS, STEP, RIDGE = 25, 0.5, 0.1
#: Weights of the document features that the logistic model departs from.
PRIOR = np.array([0.0, 1.0, 1.0, 0.0])
SPANS = "array<struct<start:bigint,end:bigint>>"


@dataclass
class Model:
    token: np.ndarray
    stem: np.ndarray
    left: np.ndarray
    right: np.ndarray
    bias: float
    moves: np.ndarray  # log-weights of the moves [from, to]
    score: np.ndarray  # intercept and weights of the document features

    def slim(self) -> "Model":
        return Model(*(x.astype(np.float32) for x in (self.token, self.stem, self.left, self.right)), self.bias, self.moves, self.score)


def held_out(id_col: Column) -> Column:
    """True where crc32 of the id as text leaves no remainder by 5 (null id: false)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


class Chains:
    """Token chains of a block of texts, cut into segments of equal length."""

    def __init__(self, words: textvec.Words):
        self.bounds = words.bounds
        n = np.diff(self.bounds)
        segments = -(-n // SEGMENT)
        first = np.concatenate([[0], np.cumsum(segments)])
        self.first, self.segments, self.lengths = first[:-1], segments, n
        inside = np.arange(len(words.doc)) - self.bounds[:-1][words.doc]
        #: Cell of each token in the (segments, SEGMENT) grid.
        self.cell = (self.first[words.doc] * SEGMENT + inside).astype(np.int32)
        self.shape = (int(first[-1]), SEGMENT)
        self.live = np.zeros(self.shape, bool)
        self.live.reshape(-1)[self.cell] = True
        self.type = (words.hashes & np.uint64(BUCKETS - 1)).astype(np.int32)
        own = np.arange(1, len(STEM) + 1, dtype=np.uint64)[:, None]  # lengths share the buckets, words of all of them differ
        self.stem = ((words.prefixes ^ own) & np.uint64(BUCKETS - 1)).astype(np.int32)
        self.doc = words.doc.astype(np.int32)
        self.texts = range(words.first, words.first + words.count)
        starts, ends = np.zeros(len(inside), bool), np.zeros(len(inside), bool)
        some = n > 0
        starts[self.bounds[:-1][some]] = True
        ends[self.bounds[1:][some] - 1] = True
        self.has_left, self.has_right = ~starts, ~ends
        self.left, self.right = np.roll(self.type, 1), np.roll(self.type, -1)

    def potentials(self, m: Model) -> np.ndarray:
        return (m.bias + m.token[self.type] + sum(m.stem[s] for s in self.stem)
                + m.left[self.left] * self.has_left + m.right[self.right] * self.has_right)

    def marginals(self, m: Model, pairs: bool = False):
        """P(toxic) of each token; with ``pairs`` also the expected counts of the moves."""
        e = np.zeros(self.shape)
        e.reshape(-1)[self.cell] = np.exp(np.clip(self.potentials(m), -30, 30))
        a = np.exp(m.moves)
        rows = self.shape[0]
        # Product of each segment's move matrices, scaled; cells without a token are the identity.
        p = np.zeros((4, rows))
        p[0] = p[3] = 1
        for t in range(SEGMENT):
            w, live = e[:, t], self.live[:, t]
            q = np.stack([p[0] * a[0, 0] + p[1] * a[1, 0], (p[0] * a[0, 1] + p[1] * a[1, 1]) * w,
                          p[2] * a[0, 0] + p[3] * a[1, 0], (p[2] * a[0, 1] + p[3] * a[1, 1]) * w])
            q /= q.max(axis=0)
            p = np.where(live, q, p)
        # Messages into the segments, documents in step; a chain starts as after a clean token.
        into, out_of = np.zeros((2, rows)), np.ones((2, rows))
        into[0] = 1
        for k in range(1, int(self.segments.max(initial=0))):
            s = self.first[self.segments > k] + k
            x = into[:, s - 1]
            y = np.stack([x[0] * p[0, s - 1] + x[1] * p[2, s - 1], x[0] * p[1, s - 1] + x[1] * p[3, s - 1]])
            into[:, s] = y / y.max(axis=0)
        for k in range(int(self.segments.max(initial=0)) - 2, -1, -1):
            s = self.first[self.segments > k + 1] + k
            x = out_of[:, s + 1]
            y = np.stack([p[0, s + 1] * x[0] + p[1, s + 1] * x[1], p[2, s + 1] * x[0] + p[3, s + 1] * x[1]])
            out_of[:, s] = y / y.max(axis=0)
        forward = np.empty((SEGMENT, 2, rows))
        x = into
        for t in range(SEGMENT):
            y = np.stack([x[0] * a[0, 0] + x[1] * a[1, 0], (x[0] * a[0, 1] + x[1] * a[1, 1]) * e[:, t]])
            x = np.where(self.live[:, t], y / y.max(axis=0).clip(1e-300), x)
            forward[t] = x
        toxic = np.empty(self.shape)
        moves = np.zeros((2, 2))
        x = out_of
        for t in range(SEGMENT - 1, -1, -1):
            live = self.live[:, t]
            clean, bad = forward[t] * x
            toxic[:, t] = bad / (clean + bad)
            y = np.stack([a[0, 0] * x[0] + a[0, 1] * e[:, t] * x[1], a[1, 0] * x[0] + a[1, 1] * e[:, t] * x[1]])
            if pairs:
                came = forward[t - 1] if t else into
                joint = [[came[i] * a[i, j] * (e[:, t] if j else 1) * x[j] for j in (0, 1)] for i in (0, 1)]
                total = joint[0][0] + joint[0][1] + joint[1][0] + joint[1][1]
                moves += [[(joint[i][j] / total)[live].sum() for j in (0, 1)] for i in (0, 1)]
            x = np.where(live, y / y.max(axis=0), x)
        got = toxic.reshape(-1)[self.cell]
        return (got, moves) if pairs else got

    def features(self, marginal: np.ndarray) -> np.ndarray:
        """Per document: 1, log of the expected toxic tokens, largest marginal, mean marginal."""
        total = np.bincount(self.doc, marginal, len(self.lengths))
        largest = np.zeros(len(self.lengths))
        np.maximum.at(largest, self.doc, marginal)
        return np.stack([np.ones(len(total)), np.log1p(total), largest, 10 * total / np.maximum(self.lengths, 10)], axis=1)


def excess(chains: list[Chains], labels: np.ndarray) -> Iterator[np.ndarray]:
    """For types, then for stems of each length: per labelling (row) and bucket, by how many deviations toxic documents exceed their share."""
    share = labels[0].mean()
    for name in range(1 + len(STEM)):
        n, k = np.zeros(BUCKETS), np.zeros((len(labels), BUCKETS))
        for c in chains:
            pair = np.unique(c.doc.astype(np.int64) * BUCKETS + (c.stem[name - 1] if name else c.type))
            bucket, doc = pair % BUCKETS, c.texts.start + pair // BUCKETS
            n += np.bincount(bucket, minlength=BUCKETS)
            for i, row in enumerate(labels):
                k[i] += np.bincount(bucket, row[doc], BUCKETS)
        yield (k - n * share) / np.sqrt(n * share * (1 - share) + 1)


def label_tokens(chains: list[Chains], toxic: np.ndarray) -> list[np.ndarray]:
    """Per block: 1 for tokens of toxic documents whose type or stem is significantly frequent in them."""
    deal = np.random.default_rng(0).permutation
    scores, counts = [], []
    for z in excess(chains, np.stack([toxic] + [deal(toxic) for _ in range(DEALS)])):
        scores.append(z[0])
        counts.append([((z[0] > t).sum(), (z[1:] > t).sum() / DEALS) for t in CUTS])
    for part in CHANCE:
        cuts = [min((t for t, (n, by_chance) in zip(CUTS, c) if n and by_chance <= part * n), default=np.inf) for c in counts]
        if min(cuts) < np.inf:
            break
    else:
        cuts = [z.max() - 1e-9 for z in scores]
    found = [np.zeros(len(c.doc), bool) for c in chains]
    for name, (z, cut) in enumerate(zip(scores, cuts)):
        often = z > cut
        found = [f | often[c.stem[name - 1] if name else c.type] for f, c in zip(found, chains)]
    return [(f & (toxic[c.texts.start + c.doc] > 0)).astype(float) for f, c in zip(found, chains)]


def document_weights(x: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Ridge logistic weights of the document features around ``PRIOR``; none but the intercept is negative."""
    live = np.ones(len(PRIOR), bool)
    while True:
        z, mid = x[:, live], PRIOR[live].copy()
        mid[0] = np.log((toxic.sum() + 0.5) / (len(toxic) - toxic.sum() + 0.5))
        pull = np.where(np.arange(len(mid)) > 0, 1.0, 1e-3)

        def loss(b):
            return np.logaddexp(0, z @ b).sum() - toxic @ (z @ b) + 0.5 * (pull * (b - mid) ** 2).sum()

        b = mid
        for _ in range(50):  # Newton steps, halved while they overshoot
            q = probability(z @ b)
            step = np.linalg.solve((z * (q * (1 - q))[:, None]).T @ z + np.diag(pull), z.T @ (toxic - q) - pull * (b - mid))
            while loss(b + step) > loss(b) and abs(step).max() > 1e-9:
                step = step / 2
            b = b + step
            if abs(step).max() < 1e-8:
                break
        out = np.zeros(len(PRIOR))
        out[live] = b
        if out[1:].min() >= 0:
            return out
        live &= (out >= 0) | (np.arange(len(PRIOR)) == 0)


def probability(s: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(s, -500, 500)))


def unrepeated(texts: list[bytes]) -> np.ndarray:
    """Documents at most half of whose five-word runs occur in an earlier one."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for w in textvec.blocks(texts, textvec.ALPHANUMERIC, True):
        runs = textvec.gram_hashes(w.hashes, 5)
        doc = w.doc[:len(runs)]
        inside = np.arange(len(runs)) + 5 <= w.bounds[1:][doc]
        found.append((runs[inside], (w.first + doc[inside]).astype(np.int32)))
    runs, doc = map(np.concatenate, zip(*found))
    _, first, kind = np.unique(runs, return_index=True, return_inverse=True)
    known = np.bincount(doc[doc[first][kind] < doc], minlength=len(texts))
    return 2 * known <= np.bincount(doc, minlength=len(texts))


def fit(texts: list[bytes], toxic: np.ndarray) -> Model:
    """Weights from labelled documents, which are worked on block by block."""
    zero = lambda: np.zeros(BUCKETS)
    base = np.array([np.log((toxic.sum() + 0.5) / (len(toxic) - toxic.sum() + 1.5)), 0, 0, 0])
    model = Model(zero(), zero(), zero(), zero(), -3.0, np.zeros((2, 2)), base)
    if not 0 < toxic.sum() < len(toxic):
        return model
    keep = unrepeated(texts)
    texts, toxic = [t for t, k in zip(texts, keep) if k], toxic[keep]
    if not 0 < toxic.sum() < len(toxic):
        return model
    chains = [Chains(w) for w in textvec.blocks(texts, textvec.ALPHANUMERIC, True, STEM)]
    marks = label_tokens(chains, toxic)
    seen = np.zeros((2, 2))
    for c, y in zip(chains, marks):
        before = np.where(c.has_left, np.roll(y, 1), 0).astype(int)
        seen += np.bincount(before * 2 + y.astype(int), minlength=4).reshape(2, 2)
    weights = [model.token, model.stem, model.left, model.right]
    first, second = [[0.0] * 6 for _ in range(2)]
    for k in range(1, ROUNDS + 1):
        slopes = [-RIDGE * w for w in weights] + [-RIDGE * model.bias, seen - RIDGE * model.moves]
        for c, y in zip(chains, marks):
            p, moves = c.marginals(model, pairs=True)
            gap = y - p
            for i, kind, live in (0, c.type, 1), *((1, s, 1) for s in c.stem), (2, c.left, c.has_left), (3, c.right, c.has_right):
                slopes[i] += np.bincount(kind, gap * live, BUCKETS)
            slopes[4] += gap.sum()
            slopes[5] = slopes[5] - moves
        for i, g in enumerate(slopes):  # Adam
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.99 * second[i] + 0.01 * g * g
            step = STEP * (first[i] / (1 - 0.9 ** k)) / (np.sqrt(second[i] / (1 - 0.99 ** k)) + 1e-3)
            if i < 4:
                weights[i] += step
            elif i == 4:
                model.bias += float(step)
            else:
                step[0, 0] = 0
                model.moves += step
    model = model.slim()
    model.score = document_weights(np.concatenate([c.features(c.marginals(model)) for c in chains]), toxic)
    return model


def sample_labelled(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                    sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """The bounded training sample (_text, _toxic): labelled rows outside the held-out fold, in one partition."""
    marks = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * sample))
    return (docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
            .where(F.octet_length("_text") <= sample_bytes)
            .join(F.broadcast(marks), "doc_id").groupBy("doc_id", "_toxic").agg(F.min("_text").alias("_text"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("_text", F.col("_toxic").cast("double").alias("_toxic")))


def train(sample: DataFrame) -> Model:
    """Fit on a bounded sample inside one task; the driver receives the weights only."""
    @releasing
    def run(batches):
        texts, toxic = [], []
        for batch in batches:
            texts += textvec.raw_texts(batch.column(0))
            toxic += batch.column(1).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(texts, (np.array(toxic) > 0).astype(float)))], pa.binary())], ["model"])

    # A sample that is known to be empty has no partition and so no task.
    row = sample.mapInArrow(run, "model binary").first()
    return fit([], np.empty(0)) if row is None else pickle.loads(row["model"])


def score_texts(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, score, predicted and spans (code points, end exclusive) of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in textvec.small_batches(batches):
            scores, spans = [], []
            for w in textvec.blocks(textvec.raw_texts(batch.column(1)), textvec.ALPHANUMERIC, fold=True, prefix=STEM):
                c = Chains(w)
                p = c.marginals(m)
                scores.append(probability(c.features(p) @ m.score))
                spans += _spans(w, p)
            score = np.concatenate(scores) if scores else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32)),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                ["doc_id", "score", "predicted", "spans"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double, predicted int, spans {SPANS}")


def scores(texts: list[bytes], m: Model) -> np.ndarray:
    """Scores of texts."""
    found = [np.empty(0)]
    for w in textvec.blocks(texts, textvec.ALPHANUMERIC, fold=True, prefix=STEM):
        c = Chains(w)
        found.append(probability(c.features(c.marginals(m)) @ m.score))
    return np.concatenate(found)


def keep_clean(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, all columns, that score below one half."""
    shared = docs.sparkSession.sparkContext.broadcast(train(sample_labelled(docs, labels, text_col, id_col)))
    at = docs.columns.index(text_col)

    @releasing
    def run(batches):
        for batch in textvec.small_batches(batches):
            keep = scores(textvec.raw_texts(batch.column(at)), shared.value) < 0.5
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def _spans(w: textvec.Words, p: np.ndarray) -> list[list[dict]]:
    """Runs of consecutive toxic tokens of each text."""
    out: list[list[dict]] = [[] for _ in range(w.count)]
    hit = np.flatnonzero(p > 0.5)
    if len(hit):
        breaks = (np.diff(hit) != 1) | (np.diff(w.doc[hit]) != 0)
        opens, closes = hit[np.concatenate([[True], breaks])], hit[np.concatenate([breaks, [True]])]
        doc = w.doc[opens]
        start, end = w.code_points(w.starts[opens], doc), w.code_points(w.ends[closes], doc)
        for d, a, b in zip(doc.tolist(), start.tolist(), end.tolist()):
            out[d].append({"start": a, "end": b})
    return out


def toxicity(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Train on the labels and score every row: doc_id, held_out, score, predicted, spans."""
    model = train(sample_labelled(docs, labels, text_col, id_col))
    scored = score_texts(docs, model, text_col, id_col)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "spans")
