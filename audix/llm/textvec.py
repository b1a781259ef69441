"""Words of many texts as numpy arrays.

A block of texts is one byte buffer. Word boundaries come from a 256-entry
class table, word hashes from one cumulative sum over the block
(``sum of value[byte] * M**position`` modulo 2**64, shifted back to the word's start), so no
Python object is made per word. Blocks hold about ``BLOCK`` bytes, more only when a
single text does.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
_M = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_M, -1, 1 << 64)

_bytes = np.arange(256)
#: Bytes of words between blanks, tabs to carriage returns.
NOT_SPACE = ~(((_bytes >= 9) & (_bytes <= 13)) | (_bytes == 32))
#: Bytes of letters and digits; any byte of a longer UTF-8 sequence counts as a letter.
ALPHANUMERIC = (((_bytes | 32) >= 97) & ((_bytes | 32) <= 122)) | ((_bytes >= 48) & (_bytes <= 57)) | (_bytes >= 128)
_EXACT = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _EXACT[np.where((_bytes >= 65) & (_bytes <= 90), _bytes + 32, _bytes)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.ones(n, dtype=np.uint64)
    done, step = 1, base
    while done < n:
        take = min(done, n - done)
        out[done:done + take] = out[:take] * np.uint64(step)
        step = (step * step) & ((1 << 64) - 1)
        done += take
    return out


_tables: dict[str, np.ndarray] = {}


def _table(name: str, base: int, n: int) -> np.ndarray:
    if name not in _tables or len(_tables[name]) < n:
        size = max(n, BLOCK + (1 << 18))
        if size > 8 * BLOCK:
            return powers(base, n)
        _tables[name] = powers(base, size)
    return _tables[name][:n]


@dataclass
class Words:
    """Words of the texts ``first`` .. ``first + count - 1``; ``doc`` counts from ``first``."""
    first: int
    count: int
    buffer: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    hashes: np.ndarray
    prefixes: np.ndarray | None = None  # a row for each length

    @property
    def bounds(self) -> np.ndarray:
        """Word i of text d has bounds[d] <= i < bounds[d + 1]."""
        return np.searchsorted(self.doc, np.arange(self.count + 1))

    def code_points(self, at: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Offsets in code points, from the text's start, of byte positions of the buffer."""
        before = np.concatenate([[0], np.cumsum((self.buffer & 0xC0) != 0x80)])
        return before[at] - before[self.offsets[doc]]


def _words(first: int, texts: list[bytes], kind: np.ndarray, fold: bool, prefix: tuple[int, ...] = ()) -> Words:
    buffer = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    offsets = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    inside = kind[buffer]
    turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(buffer) and inside[0]:
        turns = np.concatenate([[0], turns])
    starts, ends = turns[::2], turns[1::2]
    total = np.empty(len(buffer) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum((_FOLDED if fold else _EXACT)[buffer] * _table("powers", _M, len(buffer)), out=total[1:])
    back = _table("inverse", _INVERSE, len(buffer))[starts]
    hashes = mix((total[ends] - total[starts]) * back)
    heads = np.stack([mix((total[np.minimum(starts + n, ends)] - total[starts]) * back) for n in prefix]) if prefix else None
    doc = np.searchsorted(offsets, starts, side="right") - 1
    return Words(first, len(texts), buffer, offsets, starts, ends, doc, hashes, heads)


def blocks(texts: list[bytes], kind: np.ndarray = NOT_SPACE, fold: bool = False, prefix: tuple[int, ...] = ()) -> Iterator[Words]:
    """Words of ``texts``, block by block; ``fold`` hashes A-Z as a-z, ``prefix`` also hashes so many first bytes, each."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BLOCK:
            yield _words(first, texts[first:i], kind, fold, prefix)
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield _words(first, texts[first:], kind, fold, prefix)


def together(texts: list[bytes], kind: np.ndarray = NOT_SPACE, fold: bool = False, prefix: tuple[int, ...] = ()) -> Words:
    """Words of all ``texts`` as one block (for lists that are known to be small)."""
    return _words(0, texts, kind, fold, prefix)


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that Python objects are made for few texts at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes (len(hashes) - n + 1 of them)."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    size = len(hashes) - n + 1
    out = hashes[:size].copy()
    for k in range(1, n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[k:k + size]
    return mix(out)
