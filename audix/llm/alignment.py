"""Alignment of two tokenizers over the same texts (operator 12).

Tokenizer A is a byte-level BPE file (read by ``tokenizers``), B a piece model (read by
``sentencepiece``). A encodes a space and the text, B the text, to which it adds that space. Both
token sequences cover the same bytes.

*Per batch* of a bounded number of text bytes, two ``pandas.merge_asof`` calls keyed by document
find for every token start the token of the other side that covers it. The union of both directions
is the set of overlapping pairs; those with equal ends are the links and close a group.

*Encoding.* A text is cut at single spaces between two characters that are not white space. Both
tokenizers end a token there (A's split pattern always does, B's vocabulary is checked to hold no piece that
goes on after a word; otherwise texts stay whole), so equal words of a batch are encoded once and
the result is the whole text's.

*Counts over the corpus.* Pairs of ids are counted inside a task first, then by one grouped sum. The
most frequent pairs, at most ``heavy_pairs`` of them whatever the corpus, are broadcast to a map over the
documents; every other pair goes through a shuffle join, so no pair is left out.

Defined cases: null and empty texts, and texts whose joined tokens differ from a space and the text on either side
(such as texts that hold U+2581), have no tokens: zeros and an empty digest. Strings of special tokens are plain text.
Null and repeated ids and rows pass through; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audix.llm.common import join_counted, staged

#: Bytes of text aligned together; a longer text is aligned alone.
BLOCK = 1 << 21
#: Aligned stretches that a Python worker keeps.
REMEMBERED = 1 << 18
#: Stretches encoded as one text.
TOGETHER = 256
#: Pairs counted in a task before they are handed on.
PAIRS_HELD = 1 << 21
#: Pairs of ids that may be broadcast (17 bytes each).
HEAVY_PAIRS = 1 << 20

_cut = re.compile(r"(?<=\S) (?=\S)")


def byte_alphabet() -> dict[str, int]:
    """The printable character of each byte in a byte-level vocabulary: printable Latin-1 bytes
    stand for themselves, the others for the characters from U+0100 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Side:
    """One tokenizer: its encoder for many texts and the bytes of each id."""
    encode: Callable[[list[str]], list[list[int]]]
    token_bytes: list[bytes]

    def __post_init__(self):
        self.lengths = np.array([len(t) for t in self.token_bytes], np.int64)

    def printed(self, mark: str) -> np.ndarray:
        return np.array([f"{i}{mark}" for i in range(len(self.token_bytes))], object)

    def covers(self, ids: list[int], text: str) -> bool:
        return b"".join([self.token_bytes[i] for i in ids]) == b" " + text.encode()


def byte_level(tokenizer_json: str) -> Side:
    """Side A: a ``tokenizers`` file with a byte-level vocabulary."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(tokenizer_json)
    tok.encode_special_tokens = True
    alphabet, vocab = byte_alphabet(), tok.get_vocab(with_added_tokens=True)
    table = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        if all(c in alphabet for c in token):
            table[i] = bytes(alphabet[c] for c in token)

    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tok.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

    return Side(encode, table)


def piece_level(model: bytes) -> tuple[Side, bool]:
    """Side B: a ``sentencepiece`` model, and whether no piece goes on after a word's end."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    table, cuts = [], True
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            table.append(bytes([int(piece[3:5], 16)]))
        else:
            table.append(piece.replace("\u2581", " ").encode())
            cuts &= "\u2581" not in piece.lstrip("\u2581")
    return Side(lambda texts: sp.encode(texts, num_threads=1), table), cuts


def _take(flat: np.ndarray, bounds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists of ``rows`` one after the other, and their sizes."""
    size = np.diff(bounds)[rows]
    ends = np.cumsum(size)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(bounds[rows] - ends + size, size)], size


class Aligner:
    """Both sides, and the aligned stretches met last."""

    def __init__(self, tokenizer_json: str, model: bytes):
        a = byte_level(tokenizer_json)
        b, self.cuts = piece_level(model)
        self.sides = a, b
        self.marks = [(a.printed(","), a.printed("|")), (b.printed(","), b.printed(";"))]
        self.wide = len(a.token_bytes), len(b.token_bytes)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.good = np.empty(0, bool)
        self.counts = np.empty((0, 2), np.int64)
        self.strings = np.empty(0, object)
        self.bounds, self.links = np.zeros(1, np.int64), np.empty(0, np.int64)

    def _encode(self, side: Side, stretches: list[str], plain: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all stretches, how many each has, and whether they join to it. The first ``plain``
        neither begin nor end with white space and are encoded ``TOGETHER`` at a time, as one text."""
        flat, sizes, good = [], [], []
        chunks = [stretches[k:min(k + TOGETHER, plain)] for k in range(0, plain, TOGETHER)]
        joined = [" ".join(c) for c in chunks]
        alone = [[s] for s in stretches[plain:]]
        for chunk, text, ids in zip(chunks + alone, joined + stretches[plain:], side.encode(joined + stretches[plain:])):
            if side.covers(ids, text):
                ends = np.cumsum(side.lengths[ids])
                cuts = np.searchsorted(ends, np.cumsum([len(s.encode()) + 1 for s in chunk])) + 1
                flat.append(ids), sizes.append(np.diff(cuts, prepend=0)), good.append([True] * len(chunk))
            else:
                each = side.encode(chunk)
                flat += each
                sizes.append([len(x) for x in each])
                good.append([side.covers(x, s) for x, s in zip(each, chunk)])
        return tuple(np.concatenate([np.empty(0, kind), *x]).astype(kind)
                     for x, kind in ((flat, np.int64), (sizes, np.int64), (good, bool)))

    def _learn(self, stretches: list[str], doc: np.ndarray) -> None:
        """Align stretches; ``doc`` is the text of the batch that each is first met in, the key of the merges."""
        if not stretches:
            return
        rough = np.array([s[0].isspace() or s[-1].isspace() or not self.cuts for s in stretches], bool)
        order = np.argsort(rough, kind="stable")
        stretches, doc = [stretches[k] for k in order], doc[order]
        got = [self._encode(side, stretches, int((~rough).sum())) for side in self.sides]
        good = got[0][2] & got[1][2]
        ids = [flat[np.repeat(good, size)] for flat, size, _ in got]
        counts = np.stack([np.where(good, size, 0) for _, size, _ in got], axis=1)
        owner = [np.repeat(np.arange(len(good)), counts[:, s]) for s in range(2)]
        length = [side.lengths[x] for side, x in zip(self.sides, ids)]
        end = [np.cumsum(x) for x in length]  # both sides of a stretch cover as many bytes, so one offset serves
        start = [e - x for e, x in zip(end, length)]
        frames = [pd.DataFrame({"doc": doc[owner[s]], "at": start[s], "token": np.arange(len(ids[s]))}) for s in range(2)]
        cover = [pd.merge_asof(frames[s], frames[1 - s], on="at", by="doc", suffixes=("", "_other"))["token_other"]
                 .to_numpy(np.int64) for s in range(2)]
        other = np.flatnonzero(start[0][cover[1]] != start[1])  # equal starts are overlaps of the first direction already
        i = np.concatenate([np.arange(len(ids[0])), cover[1][other]])
        j = np.concatenate([cover[0], other])
        linked = end[0][i] == end[1][j]
        i, j = np.sort(i[linked]), np.sort(j[linked])  # ends rise from token to token, so sorting keeps the pairs

        size_a, size_b = np.diff(i, prepend=-1), np.diff(j, prepend=-1)
        at = [np.arange(len(ids[0])) + np.repeat(j + 1 - size_b, size_a), np.arange(len(ids[1])) + np.repeat(i + 1, size_b)]
        parts = np.empty(len(ids[0]) + len(ids[1]), object)
        for s, last in enumerate((i, j)):
            inner, closing = self.marks[s]
            parts[at[s]] = inner[ids[s]]
            parts[at[s][last]] = closing[ids[s][last]]
        parts, ends = parts.tolist(), np.cumsum(counts.sum(axis=1)).tolist()
        strings = np.empty(len(good), object)
        strings[:] = ["".join(parts[lo:hi]) for lo, hi in zip([0, *ends], ends)]

        self.known.update(zip(stretches, range(len(self.good), len(self.good) + len(good))))
        self.good = np.concatenate([self.good, good])
        self.counts = np.concatenate([self.counts, counts])
        self.strings = np.concatenate([self.strings, strings])
        self.links = np.concatenate([self.links, ids[1][j] * self.wide[0] + ids[0][i]])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(np.bincount(owner[0][i], minlength=len(good)))])

    def _rows(self, split: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The known stretches of all texts in order, and the text of each."""
        doc = np.repeat(np.arange(len(split)), [len(s) for s in split])
        code, unique = pd.factorize(np.array([u for s in split for u in s], object))
        if len(self.known) + len(unique) > REMEMBERED:
            self.forget()
        new = np.array([u not in self.known for u in unique], bool)
        if new.any():
            first = np.empty(len(unique), np.int64)
            first[code[::-1]] = doc[::-1]
            self._learn([u for u, n in zip(unique, new) if n], first[new])
        return np.array([self.known[u] for u in unique], np.int64)[code], doc

    def align(self, texts: list[str]) -> dict[str, object]:
        """Counts and digest of every text, and its links as distinct id pairs with how often each occurs."""
        n = len(texts)
        rows, doc = self._rows([(_cut.split(t) if self.cuts else [t]) if t else [] for t in texts])
        odd = np.zeros(n, bool)
        odd[doc[~self.good[rows]]] = True
        if odd.any():  # a stretch that its tokens do not cover: the whole text decides
            at = np.flatnonzero(odd)
            new = {texts[d]: d for d in at if texts[d] not in self.known}
            self._learn(list(new), np.array(list(new.values()), np.int64))
            even = ~odd[doc]
            rows = np.concatenate([rows[even], np.array([self.known[texts[d]] for d in at], np.int64)])
            doc = np.concatenate([doc[even], at])
            keep = self.good[rows]
            order = np.argsort(doc[keep], kind="stable")
            rows, doc = rows[keep][order], doc[keep][order]
        counts = [np.bincount(doc, self.counts[rows, s], n).astype(np.int64) for s in range(2)]
        links, size = _take(self.links, self.bounds, rows)
        of = np.repeat(doc, size)
        area = self.wide[0] * self.wide[1]
        keys, times = np.unique(of * area + links, return_counts=True)
        cuts = np.searchsorted(doc, np.arange(n + 1)).tolist()
        strings = self.strings[rows].tolist()
        digests = [hashlib.sha256("".join(strings[lo:hi])[:-1].encode()).hexdigest() if hi > lo else ""
                   for lo, hi in zip(cuts, cuts[1:])]
        return {"n_a": counts[0], "n_b": counts[1], "n_links": np.bincount(of, minlength=n), "groups_sha256": digests,
                "bounds": np.searchsorted(keys, np.arange(n + 1) * area),
                "a": keys % self.wide[0], "b": keys // self.wide[0] % self.wide[1], "times": times}


_aligners: dict[bytes, Aligner] = {}


def aligner(tokenizer_json: str, model: bytes) -> Aligner:
    """The aligner of two files, built once per Python worker."""
    key = hashlib.sha256(tokenizer_json.encode() + model).digest()
    if key not in _aligners:
        _aligners[key] = Aligner(tokenizer_json, model)
    return _aligners[key]


def read_files(json_path: str, model_path: str) -> tuple[str, bytes]:
    """Both vocabulary files, read where the query is written and sent to the tasks."""
    with open(json_path, encoding="utf-8") as f, open(model_path, "rb") as g:
        return json.dumps(json.load(f)), g.read()


def _blocks(texts: list[str]):
    first, size = 0, 0
    for k, t in enumerate(texts):
        if size and size + len(t) > BLOCK:
            yield first, k
            first, size = k, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, len(texts)


def _lists(bounds: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def align_texts(docs: DataFrame, files: tuple[str, bytes], text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, groups_sha256 and the links as parallel
    lists ``a``, ``b`` (ids) and ``times`` (occurrences in the text), each id pair once."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(files)

    def run(batches):
        pair = aligner(*sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                ids, texts = batch.column(0).slice(at, 1024), [t or "" for t in batch.column(1).slice(at, 1024).to_pylist()]
                for lo, hi in _blocks(texts):
                    x = pair.align(texts[lo:hi])
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(lo, hi - lo), *(pa.array(x[c], pa.int64()) for c in ("n_a", "n_b", "n_links", "n_links")),
                         pa.array(x["groups_sha256"], pa.string()),
                         *(_lists(x["bounds"], x[c], pa.int32()) for c in ("a", "b", "times"))],
                        ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "times"])
        pair.forget()  # an idle worker holds on to the vocabularies only

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                                "groups_sha256 string, a array<int>, b array<int>, times array<int>")


def _flat(batch: pa.RecordBatch, *names: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """Bounds of the rows' lists and the values of each list column."""
    lists = [batch.column(batch.schema.get_field_index(c)) for c in names]
    bounds = lists[0].offsets.to_numpy()
    return bounds - bounds[0], [x.flatten().to_numpy().astype(np.int64) for x in lists]


def _count_pairs(batches):
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def merged():
        keys = np.concatenate([k for k, _ in held])
        unique, at = np.unique(keys, return_inverse=True)
        return unique, np.bincount(at, np.concatenate([t for _, t in held])).astype(np.int64)

    for batch in batches:
        _, (a, b, times) = _flat(batch, "a", "b", "times")
        held.append((b << 32 | a, times))
        size += len(a)
        if size > PAIRS_HELD:
            held = [merged()]
            size = len(held[0][0])
            if 2 * size > PAIRS_HELD:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], ["pair", "n"])
                held, size = [], 0
    if size:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged()], ["pair", "n"])


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair`` (B id times 2**32 plus A id), ``n`` links of the corpus, ``best``: no pair of that B id has more."""
    counts = staged(aligned.sparkSession, aligned.select("a", "b", "times").mapInArrow(_count_pairs, "pair bigint, n bigint")
                    .groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    by_b = counts.withColumn("b", F.shiftright("pair", 32))
    most = by_b.groupBy("b").agg(F.max("n").alias("most"))
    return join_counted(by_b, most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _heavy(counts: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The pairs of highest counts, at most ``most`` of them, and the others; equal ranges of counts stay together."""
    ranged = counts.withColumn("range", F.floor(4 * F.log2("n")))
    sizes = sorted(ranged.groupBy("range").count().collect(), reverse=True)
    total, least = 0, None
    for r in sizes:
        total += r["count"]
        if total > most:
            break
        least = r["range"]
    heavy = F.lit(False) if least is None else F.col("range") >= least
    return ranged.where(heavy).drop("range"), ranged.where(~heavy).drop("range")


def align_corpus(docs: DataFrame, files: tuple[str, bytes], text_col: str = "text", id_col: str = "doc_id",
                 heavy_pairs: int = HEAVY_PAIRS) -> DataFrame:
    """:func:`align_texts` without the lists, and per row ``n_best`` (links whose count is the highest of
    their B id) and ``count_sum`` (of the links' counts), counts taken over the whole table."""
    spark = docs.sparkSession
    aligned = staged(spark, align_texts(docs, files, text_col, id_col).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = staged(spark, pair_counts(aligned), "pair-counts")
    heavy, light = _heavy(counts, heavy_pairs)
    known = heavy.toArrow().sort_by("pair")
    sent = spark.sparkContext.broadcast(tuple(known.column(c).to_numpy() for c in ("pair", "n", "best")))
    kept = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def run(batches):
        pair, n, best = sent.value
        for batch in batches:
            bounds, (a, b, times) = _flat(batch, "a", "b", "times")
            key = b << 32 | a
            at = np.minimum(np.searchsorted(pair, key), max(len(pair) - 1, 0))
            found = pair[at] == key if len(pair) else np.zeros(len(key), bool)
            sums = [np.concatenate([[0], np.cumsum(x)]) for x in (
                (times * np.where(found, best[at], 0), times * np.where(found, n[at], 0)) if len(pair) else (np.zeros(len(key), np.int64),) * 2)]
            rest = np.concatenate([[0], np.cumsum(~found)])[bounds]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *(pa.array((s[bounds[1:]] - s[bounds[:-1]]).astype(np.int64)) for s in sums),
                 _lists(rest, key[~found], pa.int64()), _lists(rest, times[~found], pa.int64())],
                [*kept, "n_best", "count_sum", "pairs", "times"])

    kind = aligned.schema["doc_id"].dataType.simpleString()
    scored = staged(spark, aligned.mapInArrow(
        run, f"row bigint, doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
             "n_best bigint, count_sum bigint, pairs array<bigint>, times array<bigint>"), "scored")
    rare = scored.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    rare = (join_counted(rare, light, "pair").groupBy("row")
            .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("rare_best"),
                 F.sum(F.col("times") * F.col("n")).alias("rare_sum")))
    return (scored.drop("pairs", "times").join(rare, "row", "left")
            .withColumn("n_best", F.col("n_best") + F.coalesce("rare_best", F.lit(0)))
            .withColumn("count_sum", F.col("count_sum") + F.coalesce("rare_sum", F.lit(0)))
            .drop("row", "rare_best", "rare_sum"))
