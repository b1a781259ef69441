"""Byte-level BPE encoding and decoding over segment trees (operator 4).

Every match of the split pattern is encoded by itself. A match that is a
token is that token. Otherwise its bytes are the leaves of a segment tree: the
leaf at byte ``j`` holds the rank of the pair that starts at live position
``j`` (together with ``j``, so that equal ranks go left first), inner nodes
the minimum of their children. The root names the next merge; a merge changes
three leaves (the merged position, its swallowed right neighbour, its left
neighbour), each a walk of logarithmic length up the tree, until the root is
empty.

Matches of up to ``WIDE`` bytes are merged many at a time, one tree per row of
a matrix; longer ones one by one. Encoded matches are remembered per Python
worker up to ``REMEMBERED`` of them. Texts are cut into stretches at places where the pattern
always ends a match (before white space that follows something else), so the memory of a task
does not grow with the longest text.

The work is a map over rows, without a shuffle. Defined cases: a null text counts as an empty
one (no ids); null and repeated ids and rows pass through; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from operator import methodcaller

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audix.llm.common import releasing

NONE = np.int64(1) << 62
#: Longest match, in bytes, that is merged together with others.
WIDE = 64
#: Cells of the tree matrix.
CELLS = 1 << 19
#: Encoded matches that a Python worker keeps.
REMEMBERED = 200_000
#: Characters of a text that are split at a time.
STRETCH = 1 << 18
#: Characters whose matches are encoded together.
TOGETHER = 1 << 18

_cut = regex.compile(r"(?<=\S)\s")


class SegmentBPE:
    """Encoder and decoder of one rank file (lines of base64 token and rank)."""

    def __init__(self, rank_file: bytes, pattern: str):
        self.ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in rank_file.splitlines() if line)}
        self.vocabulary = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.vocabulary[rank] = token
        self.split = regex.compile(pattern).findall
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        get = self.ranks.get
        self.pairs = {(a << 32) | b: r for t, r in self.ranks.items() for i in range(1, len(t))
                      if (a := get(t[:i])) is not None and (b := get(t[i:])) is not None}
        self._keys = np.array(sorted(self.pairs), dtype=np.int64)
        self._values = np.array([self.pairs[k] for k in self._keys.tolist()], dtype=np.int64)
        self.known: dict[str, bytes] = {}

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._values[at], -1)

    def merge_one(self, piece: bytes) -> list[int]:
        """Ids of one piece, over a segment tree of its own."""
        n = len(piece)
        width = 1 << max(1, (n - 1).bit_length())
        token = self.of_byte[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        none, pairs = int(NONE), self.pairs.get
        tree = [none] * (2 * width)
        for j in range(n - 1):
            if (r := pairs((token[j] << 32) | token[j + 1])) is not None:
                tree[width + j] = r * width + j
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(j: int, value: int) -> None:
            node = width + j
            tree[node] = value
            node >>= 1
            while node:
                a, b = tree[2 * node], tree[2 * node + 1]
                low = a if a < b else b
                if tree[node] == low:
                    return
                tree[node] = low
                node >>= 1

        while (low := tree[1]) != none:
            rank, j = divmod(low, width)
            gone = after[j]
            token[j], token[gone] = rank, -1
            right = after[j] = after[gone]
            put(gone, none)
            r = None
            if right < n:
                before[right] = j
                r = pairs((rank << 32) | token[right])
            put(j, none if r is None else r * width + j)
            if (left := before[j]) >= 0:
                r = pairs((token[left] << 32) | rank)
                put(left, none if r is None else r * width + left)
        return [t for t in token if t >= 0]

    def merge_many(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Packed ids of pieces of at most ``width`` (a power of two) bytes, all trees in step."""
        count = len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, count)
        filled = np.frombuffer(b"".join(map(methodcaller("ljust", width, b"\0"), pieces)), np.uint8)
        column = np.arange(width)
        token = np.where(column < lengths[:, None], self.of_byte[filled.reshape(count, width)], -1)
        after = np.broadcast_to(column + 1, (count, width)).copy()
        before = np.broadcast_to(column - 1, (count, width)).copy()
        tree = np.full((count, 2 * width), NONE)
        rank = self._rank_of(token[:, :-1], np.maximum(token[:, 1:], 0))
        tree[:, width:-1] = np.where((rank >= 0) & (column[1:] < lengths[:, None]), rank * width + column[:-1], NONE)
        for node in range(width - 1, 0, -1):
            np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])
        flat_tree, flat_token = tree.reshape(-1), token.reshape(-1)
        flat_after, flat_before = after.reshape(-1), before.reshape(-1)

        def put(row: np.ndarray, j: np.ndarray, value: np.ndarray) -> None:
            base, node = row * (2 * width), width + j
            flat_tree[base + node] = value
            for _ in range(width.bit_length() - 1):
                node = node >> 1
                at = base + 2 * node
                flat_tree[base + node] = np.minimum(flat_tree[at], flat_tree[at + 1])

        row = np.flatnonzero(tree[:, 1] < NONE)
        while len(row):
            low = flat_tree[row * (2 * width) + 1]
            j, rank, base = low % width, low // width, row * width
            gone = flat_after[base + j]
            right = flat_after[base + gone]
            flat_token[base + j], flat_token[base + gone] = rank, -1
            flat_after[base + j] = right
            put(row, gone, NONE)
            inside = right < lengths[row]
            r = self._rank_of(rank, flat_token[base + np.where(inside, right, j)])
            put(row, j, np.where(inside & (r >= 0), r * width + j, NONE))
            flat_before[(base + right)[inside]] = j[inside]
            left = flat_before[base + j]
            some = left >= 0
            row2, left = row[some], left[some]
            r = self._rank_of(flat_token[row2 * width + left], rank[some])
            put(row2, left, np.where(r >= 0, r * width + left, NONE))
            row = row[flat_tree[row * (2 * width) + 1] < NONE]
        live = token >= 0
        packed = token[live].astype("<u4").tobytes()
        ends = (np.cumsum(live.sum(axis=1)) * 4).tolist()
        return [packed[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def _learn(self, pieces: set[str]) -> None:
        """Add the packed ids of ``pieces`` to ``known``."""
        known, rank_of, by_width = self.known, self.ranks.get, {}
        for piece in pieces:
            raw = piece.encode()
            if (rank := rank_of(raw)) is not None:
                known[piece] = rank.to_bytes(4, "little")
            elif len(raw) > WIDE:
                known[piece] = np.array(self.merge_one(raw), "<u4").tobytes()
            elif (width := 1 << max(2, (len(raw) - 1).bit_length())) in by_width:
                by_width[width].append(piece)
            else:
                by_width[width] = [piece]
        for width, names in by_width.items():
            step = max(1, CELLS // width)
            for at in range(0, len(names), step):
                some = names[at:at + step]
                known.update(zip(some, self.merge_many([p.encode() for p in some], width)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, packed as little-endian unsigned 32-bit integers."""
        out = []
        stretches = ((i, s) for i, t in enumerate(texts) for s in stretches_of(t))
        ids: dict[int, list[bytes]] = {}
        size, held = 0, []
        for i, s in stretches:
            held.append((i, self.split(s)))
            size += len(s)
            if size >= TOGETHER:
                self._flush(held, ids)
                size, held = 0, []
        self._flush(held, ids)
        for i in range(len(texts)):
            out.append(b"".join(ids.get(i, ())))
        return out

    def _flush(self, held: list[tuple[int, list[str]]], ids: dict[int, list[bytes]]) -> None:
        pieces = set().union(*(p for _, p in held))
        if len(self.known) > REMEMBERED:
            self.known = {}
        self._learn(pieces.difference(self.known))
        known = self.known
        for i, pieces in held:
            ids.setdefault(i, []).append(b"".join([known[p] for p in pieces]))

    def decode(self, packed: bytes) -> bytes:
        """Bytes of packed ids."""
        ids = np.frombuffer(packed, "<u4")
        vocabulary, parts = self.vocabulary, []
        for at in range(0, len(ids), STRETCH):
            parts.append(b"".join([vocabulary[i] for i in ids[at:at + STRETCH].tolist()]))
        return b"".join(parts)


def stretches_of(text: str) -> Iterator[str]:
    """The text in pieces that are split by the pattern as the whole is."""
    at = 0
    while len(text) - at > STRETCH:
        if (m := _cut.search(text, at + STRETCH)) is None:
            break
        yield text[at:m.start()]
        at = m.start()
    if at < len(text):
        yield text[at:] if at else text


_coders: dict[tuple[bytes, str], SegmentBPE] = {}


def coder(rank_file: bytes, pattern: str) -> SegmentBPE:
    """The coder of a rank file, built once per Python worker."""
    key = (hashlib.sha256(rank_file).digest(), pattern)
    if key not in _coders:
        _coders[key] = SegmentBPE(rank_file, pattern)
    return _coders[key]


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _rows_at_a_time(batch: pa.RecordBatch, most: int = 1024) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, most):
        yield batch.slice(at, most)


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def encode_texts(docs: DataFrame, rank_file: bytes, pattern: str, text_col: str = "text",
                 id_col: str = "doc_id", decode: bool = False) -> DataFrame:
    """doc_id and ``ids`` (packed little-endian unsigned 32-bit integers) of every row.

    With ``decode`` also ``decoded``, the bytes that the ids stand for, in the same
    Python worker, so that a task needs one coder.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    @releasing
    def run(batches):
        bpe = coder(rank_file, pattern)
        for batch in batches:
            for part in _rows_at_a_time(batch):
                ids = bpe.encode(_texts(part.column(1)))
                columns = [part.column(0), pa.array(ids, pa.binary())]
                if decode:
                    columns.append(pa.array([bpe.decode(x) for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][:len(columns)])
        bpe.known = {}  # an idle worker holds on to the vocabulary only

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids binary" + ", decoded binary" * decode)


def decode_ids(encoded: DataFrame, rank_file: bytes, pattern: str) -> DataFrame:
    """All columns of ``encoded`` and ``decoded``, the bytes that its ``ids`` stand for."""
    names = [c for c in encoded.columns if c != "decoded"]
    rows = encoded.select(*names)

    def run(batches):
        bpe = coder(rank_file, pattern)
        for batch in batches:
            for part in _rows_at_a_time(batch):
                got = [bpe.decode(x or b"") for x in part.column(names.index("ids")).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(got, pa.binary())], [*names, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{schema}, decoded binary")


def round_trip(docs: DataFrame, rank_file: bytes, pattern: str, text_col: str = "text",
               id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the bytes decoded from them."""
    coded = encode_texts(docs, rank_file, pattern, text_col, id_col, decode=True)
    return coded.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
