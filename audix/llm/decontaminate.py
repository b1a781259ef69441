"""Benchmark decontamination by pigeonhole edit matching (operator 6).

Texts and items are compared in lower case with every run of white space as one
blank. An item of ``n`` characters has an error budget of
``k = floor(n * error_rate)`` edits and is split into ``k + 1`` pieces: whoever
holds the item with at most ``k`` edits holds one piece unchanged. An
Aho-Corasick automaton over all pieces finds these in one pass over a text; each hit places
the item on a stretch of ``n + 2k`` characters, overlapping stretches of an item
are joined, and Myers' bit-parallel distance (the item's columns in one
integer) decides about them. Run backwards from the end it finds, anchored there, the same recurrence gives the start.

The test items are the given query set. They are sent to the executors in blocks of
at most about ``BLOCK_BYTES`` of item text, one pass over the documents for
each block, so what is broadcast stays bounded whatever the size of the set. The documents are
mapped, never shuffled.

An item too short for an edit (fewer than 1 / ``error_rate`` characters) is searched for as whole words: no letter
or digit may go on where it begins or ends with one.

Defined cases: null and empty texts hold nothing; null and empty items (or of white space only) are
not searched for; items with equal texts are all reported; repeated rows and ids are each judged; null ids
stay null; documents' other columns are kept by :func:`keep_clean`, not read by
:func:`find_leaks`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from audix.llm import textvec
from audix.llm.common import releasing, staged

ERROR_RATE = 0.08
#: Item text that is sent to the executors at a time.
BLOCK_BYTES = 4 << 20


def normalise(text: str) -> str:
    return " ".join(text.lower().split())


def myers(pattern: str, text: str, anchored: bool = False) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to any stretch of ``text``, and the first end of such a stretch;
    ``anchored``: to any stretch that begins where ``text`` does."""
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | (1 << i)
    pv, mv, score = full, 0, m
    best, end = m, 0
    get = peq.get
    carry = 1 if anchored else 0  # characters before a stretch cost nothing, unless it is anchored
    for at, c in enumerate(text, 1):
        eq = get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score < best:
                best, end = score, at
        ph = ((ph << 1) | carry) & full
        mh = (mh << 1) & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
    return best, end


def whole_words(text: str, start: int, end: int) -> bool:
    """Whether no word of ``text`` goes on across the ends of the stretch."""
    return not (start and text[start - 1].isalnum() and text[start].isalnum()
                or end < len(text) and text[end - 1].isalnum() and text[end].isalnum())


class Matcher:
    """Automaton over the pieces of a block of items."""

    def __init__(self, items: list[tuple[object, str]], error_rate: float):
        by_text: dict[str, list[int]] = {}
        for key, text in items:
            if t := normalise(text or ""):
                by_text.setdefault(t, []).append(key)
        self.items = [(t, int(len(t) * error_rate), keys) for t, keys in by_text.items()]
        self.automaton = ahocorasick.Automaton()
        places: dict[str, list[tuple[int, int]]] = {}
        for i, (t, k, _) in enumerate(self.items):
            cuts = [p * len(t) // (k + 1) for p in range(k + 2)]
            for a, b in zip(cuts, cuts[1:]):
                places.setdefault(t[a:b], []).append((i, b))
        for piece, where in places.items():
            self.automaton.add_word(piece, where)
        if self.items:
            self.automaton.make_automaton()

    def stretches(self, text: str) -> dict[int, list[list[int]]]:
        """Joined stretches [start, end) of ``text`` where an item may be, by item."""
        found: dict[int, list[list[int]]] = {}
        items = self.items
        for last, where in self.automaton.iter(text) if items else ():
            for i, b in where:
                t, k, _ = items[i]
                start = last + 1 - b - k
                end = start + len(t) + 2 * k
                if k == 0 and not whole_words(text, start, end):
                    continue
                if (own := found.get(i)) is None:
                    found[i] = [[start, end]]
                elif start <= own[-1][1] and end >= own[-1][0]:
                    own[-1] = [min(start, own[-1][0]), max(end, own[-1][1])]
                else:
                    own.append([start, end])
        return found

    def matches(self, raw: str) -> Iterator[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) of each item that ``raw`` holds, at its best stretch."""
        text = normalise(raw)
        for i, stretches in self.stretches(text).items():
            t, k, keys = self.items[i]
            best = (k + 1, 0)
            for start, end in stretches:
                start = max(0, start)
                distance, stop = myers(t, text[start:end])
                if distance < best[0]:
                    best = (distance, start + stop)
            if best[0] <= k:
                distance, end = best
                back = text[max(0, end - len(t) - k):end][::-1]
                begin = end - myers(t[::-1], back, anchored=True)[1]
                for key in keys:
                    yield key, distance, begin, end

    def holds_any(self, raw: str) -> bool:
        return next(self.matches(raw), None) is not None


_matchers: dict[bytes, Matcher] = {}


def _matcher(items: list[tuple[object, str]], error_rate: float) -> Matcher:
    """The automaton of a block, built once per Python worker."""
    key = hashlib.sha256(repr((items, error_rate)).encode()).digest()
    if key not in _matchers:
        _matchers.clear()
        _matchers[key] = Matcher(items, error_rate)
    return _matchers[key]


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The test items in blocks of about ``block_bytes``; at least one block."""
    rows = (items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
            .where(F.length("text") > 0))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for b in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b)
        yield sorted(((r["item_id"], r["text"]) for r in own.collect()), key=repr)


def find_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", id_col: str = "doc_id",
               error_rate: float = ERROR_RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, distance, start and end for each item that a document holds.

    ``start`` and ``end`` count characters of the normalised text. Ids keep their types.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    item_type = items.schema["item_id"].dataType
    arrow_type = to_arrow_type(item_type)
    doc_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_type}, item_id {item_type.simpleString()}, distance int, start bigint, end bigint"
    out = None
    for block in item_blocks(items, block_bytes=block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            matcher = _matcher(shared.value, error_rate)
            for batch in textvec.small_batches(batches):
                at, found = [], []
                for i, text in enumerate(batch.column(1).to_pylist()):
                    for m in matcher.matches(text or ""):
                        at.append(i)
                        found.append(m)
                item, distance, start, end = zip(*found) if found else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at, pa.int64())), pa.array(item, arrow_type),
                     pa.array(distance, pa.int32()), pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                    ["doc_id", "item_id", "distance", "start", "end"])

        got = staged(docs.sparkSession, rows.mapInArrow(run, schema), "leaks")
        shared.destroy()
        out = got if out is None else out.unionByName(got)
    return out


def keep_clean(docs: DataFrame, items: DataFrame, text_col: str = "text", error_rate: float = ERROR_RATE,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, that hold none of the items."""
    at = docs.columns.index(text_col)
    before = None
    for block in item_blocks(items, block_bytes=block_bytes):
        if before is not None:  # more than one block: what the one before has kept is written, its items go
            docs = staged(docs.sparkSession, docs, "clean")
            before.destroy()
        before = shared = docs.sparkSession.sparkContext.broadcast(block)

        @releasing
        def run(batches, shared=shared):
            matcher = _matcher(shared.value, error_rate)
            for batch in textvec.small_batches(batches):
                keep = [not matcher.holds_any(t or "") for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
